"""Benchmark decontamination: test windows as a broadcast hash set.

A window is ``size`` consecutive words of a benchmark item (the whole item when it
has fewer words). While the benchmark has at most ``MAX_BROADCAST`` windows, the
hashes of the first ``ANCHOR`` words of its windows go to the tasks as a hash set and
every position of a document is tested against it inside the row, so that only
positions where a window may begin are exploded. Those are joined to the windows by
hash (broadcast behind the same check, shuffled beyond it) and verified word by word:
a hash collision is never a hit. A larger benchmark explodes every position and
joins by shuffle, with the same result.

Hits are kept per distinct text (128-bit key), so copies cost one group. Only the
keys of texts with hits are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm._text import (ANY_GAP, alnum_words, count_alnum_words, fresh, gram_hash, materialized,
                              positions, text_key, whole, words_hash)

SIZE = 13
ANCHOR = 3
MAX_BROADCAST = 50_000
SHARE = 20  # contaminated: one word in SHARE or more is hit


def item_windows(benchmark: DataFrame, size: int, item_id: str, text: str) -> DataFrame:
    """(window, items): every distinct window with the ids of the items that hold it.
    Items with equal words are windowed once; those without an id are one, with a null id."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), alnum_words(F.col(text)).alias("words"))
    texts = (items.where(F.size("words") > 0)
             .groupBy("words").agg(F.transform(F.collect_set(F.struct("item")), lambda s: s["item"]).alias("items")))
    width = F.least(F.lit(size), F.size("words"))
    return (texts.select("words", "items", F.explode(positions(F.size("words"), width)).alias("at"))
            .groupBy(F.slice("words", F.col("at") + 1, width).alias("window"))
            .agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))


def _by_length(column: Column, lengths: list[int], value) -> Column:
    """``value(n)`` for the length ``n`` of ``column`` (one of ``lengths``)."""
    return F.coalesce(*[F.when(F.size(column) == n, value(n)) for n in lengths])


def _spots(words: Column, lengths: list[int], anchors: dict[int, list[int]] | None) -> Column:
    """(h, at, n) of the windows of ``words`` to look up: every one, or those whose
    first words are in ``anchors`` (hashes by number of words)."""
    def known(a: int):
        return lambda at: gram_hash(words, at, a).isin(anchors[a])

    def fits(n: int):
        return lambda at: at <= F.size(words) - n

    def spot(n: int):
        return lambda at: F.struct(gram_hash(words, at, n).alias("h"), at.alias("at"), F.lit(n).alias("n"))

    spots = F.array().cast("array<struct<h:bigint,at:int,n:int>>")
    starts = {a: F.filter(positions(F.size(words), a), known(a)) for a in anchors or ()}
    for n in lengths:
        at = positions(F.size(words), n) if anchors is None else F.filter(starts[min(n, ANCHOR)], fits(n))
        spots = F.concat(spots, F.transform(at, spot(n)))
    return spots


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int, text: str, item_id: str, item_text: str,
              max_broadcast: int) -> DataFrame:
    """One row per distinct text with a hit: key, n_hit, items, hits (at, n)."""
    windows = item_windows(benchmark, size, item_id, item_text)
    stats = windows.groupBy(F.size("window").alias("n")).count().collect()  # one row per length
    lengths = sorted(r["n"] for r in stats)
    small = sum(r["count"] for r in stats) <= max_broadcast
    anchors = None
    if small:
        rows = windows.select(F.least(F.lit(ANCHOR), F.size("window")).alias("a"), "window").select("a", _by_length(
            F.slice("window", 1, F.col("a")), [1, 2, 3], lambda a: words_hash(F.col("window"), a)).alias("h"))
        anchors = {}
        for r in rows.distinct().collect():  # at most max_broadcast numbers
            anchors.setdefault(r["a"], []).append(r["h"])
    words = docs.select(text_key(F.col(text)).alias("key"), alnum_words(F.col(text)).alias("words"))
    seen = (words.select("key", "words", F.explode(_spots(F.col("words"), lengths, anchors)).alias("s"))
            .select("key", "s.h", "s.at", "s.n", F.slice("words", F.col("s.at") + 1, F.col("s.n")).alias("window")))
    hashed = windows.withColumn("h", _by_length(F.col("window"), lengths or [1],
                                                lambda n: words_hash(F.col("window"), n)))
    found = (seen.join(F.broadcast(hashed) if small else hashed, ["h", "window"])
             .groupBy("key", "at").agg(F.max("n").alias("n"), F.collect_set("items").alias("items")))
    order = W.partitionBy("key").orderBy("at")  # a partition holds the hits of one text
    end = F.coalesce(F.max(F.col("at") + F.col("n")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(F.lit(0), F.col("at") + F.col("n") - F.greatest(F.col("at"), end))
    return (found.withColumn("new", new).groupBy("key").agg(
        F.sum("new").cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("items"))))).alias("items"),
        F.array_sort(F.collect_list(F.struct("at", "n"))).alias("hits")))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with columns n_words, n_hit, items (sorted ids as strings), hits (first
    word, number of words) and contaminated.

    Null text has no words and is never contaminated; a text of any length is searched
    whole. Items without words give no window; those without an id are one item, a null
    at the end of ``items``; an empty benchmark hits nothing; repeated documents are
    judged alike, a repeated item id is listed once; ties don't arise. Names that
    clash get an underscore.
    """
    n_words, n_hit, items, hits, contaminated, key = fresh(
        docs, "n_words", "n_hit", "items", "hits", "contaminated", "text_key")
    # Written, so that its size is known: the hits are broadcast to the texts while they
    # are small, and the shuffled join can be split where they aren't.
    found = materialized(find_hits(docs, benchmark, size, text, item_id, item_text, max_broadcast), "benchmark_hits")
    found = found.toDF(key, n_hit, items, hits)
    # The key is a column before the join, so that texts nobody asks for aren't shuffled.
    own = fresh(docs, "own_key")[0]
    rows = docs.withColumns({n_words: count_alnum_words(F.col(text)), own: text_key(F.col(text))})
    rows = rows.join(found, F.col(own) == F.col(key), "left").drop(own, key)
    rows = (rows.withColumn(n_hit, F.coalesce(n_hit, F.lit(0).cast("bigint")))
            .withColumn(items, F.coalesce(items, F.array().cast("array<string>")))
            .withColumn(hits, F.coalesce(hits, F.array().cast("array<struct<at:int,n:int>>"))))
    return rows.withColumn(contaminated, (F.col(n_hit) > 0) & (SHARE * F.col(n_hit) >= F.col(n_words)))


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents."""
    flag = fresh(docs, "contaminated")[0]
    return scan(docs, benchmark, **options).where(~F.col(flag)).select(*(f"`{c}`" for c in docs.columns))


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every hit word, and the gap before it, cut from ``text``."""
    hits = fresh(docs, "hits")[0]
    rows = scan(docs, benchmark, text=text, **options)
    words, gaps, gone = fresh(rows, "words", "gaps", "gone")
    # Words and gaps in turn, in the text's own letters; gap 0 stands before word 0.
    word = ANY_GAP.replace("[", "[^")
    rows = (rows.withColumn(words, F.array_remove(F.split(whole(F.col(text)), ANY_GAP), ""))
            .withColumn(gaps, F.when(F.size(hits) > 0, F.split(whole(F.col(text)), word, -1)))
            .withColumn(gone, F.array_distinct(F.flatten(F.transform(
                F.col(hits), lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1))))))
    stay = F.array_except(positions(F.size(words)), F.col(gone))
    cut = F.concat(F.array_join(F.transform(stay, lambda i: F.concat(F.get(gaps, i), F.get(words, i))), ""),
                   F.element_at(gaps, -1))
    return (rows.withColumn(text, F.when(F.size(hits) > 0, cut).otherwise(F.col(text)))
            .select(*(f"`{c}`" for c in docs.columns)))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    return scan(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
