"""Column helpers shared by the operators: word splitting, row keys, hashes.

All of them are built-in Spark functions, so they stay in the JVM. ``null`` text
counts as empty everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What separates words. ALNUM_GAP expects text whose A-Z are already lower-cased;
# ANY_GAP leaves the same words in either case. Java tests a class of ranges several
# times faster than its complement, so words are counted by splitting, too.
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change accented letters)."""
    return F.translate(text, _UPPER, _UPPER.lower())


def alnum_words(text: Column) -> Column:
    """Lower-cased alphanumeric words. Splitting on the gaps and dropping the empty
    ends costs a fraction of extracting every match."""
    return F.array_remove(F.split(ascii_lower(whole(text)), ALNUM_GAP), "")


def count_alnum_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(whole(text), ANY_GAP), "")).cast("bigint")


def count_space_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(SPACE_WORD)).cast("bigint")


def bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a short lineage that
    survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """Key of a whole text: 128 bits, so equal keys mean equal texts."""
    return F.md5(whole(text))


def positions(n: Column, width: Column | int = 1) -> Column:
    """0 .. n - width, or an empty array when there are fewer than ``width`` items."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def gram_hash(words: Column, at: Column, size: int) -> Column:
    """64-bit hash of the ``size`` words from index ``at`` (from 0)."""
    if size <= 3:
        return F.xxhash64(*(F.get(words, at + j) for j in range(size)))
    return F.xxhash64(F.slice(words, at + 1, size))


def words_hash(words: Column, size: int) -> Column:
    """The hash that :func:`gram_hash` gives for an array of exactly ``size`` words."""
    return gram_hash(words, F.lit(0), size)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names close to ``wanted`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    names = []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        names.append(w)
    return names
