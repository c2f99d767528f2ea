"""Word count over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.functions.text import words


def word_counts(texts: DataFrame, col: str = "value") -> DataFrame:
    """A3: lower-case, split on whitespace, drop empty tokens, count per word.

    ``explode`` stays inside the scan stage and the count is a partial + final
    aggregation, so very frequent words are pre-counted on every mapper and only
    one row per (mapper, word) is shuffled.
    """
    w = texts.select(F.explode(words(col)).alias("mot")).where(F.col("mot") != "")
    return w.groupBy("mot").agg(F.count(F.lit(1)).alias("n"))


def top_words(texts: DataFrame, k: int = 15, col: str = "value") -> DataFrame:
    """The ``k`` most frequent words (ties by word)."""
    return word_counts(texts, col).orderBy(F.col("n").desc(), F.col("mot")).limit(k)
