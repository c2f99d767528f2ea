"""License scan by diagonal voting.

Documents and templates are cut into rolling k-grams of words (a template shorter
than k is one gram). Document grams are joined to template positions by hash and
verified word by word; each match votes for the diagonal document position minus
template position. Diagonals of one template at most ``drift`` of its length apart
are merged (words were added or left out between them) into one run. Phrases of the
template that stand elsewhere can stretch a run, so a span is a stretch of it not much
longer than the template, and it stands when the matched grams inside cover at least
``threshold`` of the template's words; of stretches that overlap, the one that covers
most, the first of equal ones.

The templates are a fixed list of at most ``MAX_TEMPLATE_WORDS`` words (checked), so
their grams are broadcast. Before the join, words that begin no template gram are
passed over inside the row. Matches are kept per distinct text (128-bit key).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm._text import (alnum_words, bound, count_alnum_words, fresh, gram_hash, materialized, positions, text_key,
                              words_hash)
from baobab.llm.license_templates import templates as default_templates

K = 3
THRESHOLD = 0.8
DRIFT = 0.1
MAX_TEMPLATE_WORDS = 20_000


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]], k: int) -> DataFrame:
    """(template, label, base, length, k, at, gram, h) of every template position."""
    # One literal in the JVM: the list is fixed and short.
    listed = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(base).alias("base"))
                       for i, (label, text, base) in enumerate(templates)))
    rows = spark.range(1).select(F.inline(listed))
    words = F.col("words")
    rows = rows.select("template", "label", "base", alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    width = F.least(F.lit(k), F.size(words))
    grams = rows.select("template", "label", "base", F.size(words).alias("length"), width.alias("k"), "words",
                        F.explode(positions(F.size(words), width)).alias("at"))
    grams = grams.select("template", "label", "base", "length", "k", "at",
                         F.slice("words", F.col("at") + 1, F.col("k")).alias("gram"))
    h = F.coalesce(*[F.when(F.col("k") == n, words_hash(F.col("gram"), n)) for n in range(1, k + 1)])
    return grams.withColumn("h", h)


def _candidates(words: Column, first_words: list[str], sizes: list[int]) -> Column:
    """(k, at, h, gram) of the grams of ``words`` that begin with one of ``first_words``."""
    def gram(n: int):
        return lambda i: F.struct(F.lit(n).alias("k"), i.alias("at"), gram_hash(words, i, n).alias("h"),
                                  F.slice(words, i + 1, F.lit(n)).alias("gram"))

    def fits(n: int):
        return lambda i: i <= F.size(words) - n

    starts = F.filter(positions(F.size(words)), lambda i: F.get(words, i).isin(first_words))
    return F.concat(F.array().cast("array<struct<k:int,at:int,h:bigint,gram:array<string>>>"),
                    *[F.transform(F.filter(starts, fits(n)), gram(n)) for n in sizes])


def find_spans(docs: DataFrame, text: str, templates: list[tuple[str, str, bool]], k: int = K,
               threshold: float = THRESHOLD, drift: float = DRIFT) -> DataFrame:
    """(key, template, label, base, first, last, coverage): verified spans of each distinct
    text, ``first`` and ``last`` being word positions."""
    grams = template_grams(docs.sparkSession, templates, k)
    heads = grams.select(F.get("gram", F.lit(0)).alias("w"), "k").distinct().collect()  # of the fixed list
    if sum(len(t[1].split()) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words are no fixed list")
    spots = bound(alnum_words(F.col(text)), lambda w: _candidates(w, sorted({r["w"] for r in heads}), sorted({r["k"] for r in heads})))
    # Each spot has its own words, so that the text's don't go with every one of them. (The
    # outer form: for explode, Spark would filter by the array's size and so make it twice.)
    seen = (docs.select(text_key(F.col(text)).alias("key"), spots.alias("spots")).select("key", F.explode_outer("spots").alias("s"))
            .where("s is not null").select("key", "s.k", "s.h", F.col("s.at").alias("pos"), "s.gram"))
    hits = (seen.join(F.broadcast(grams), ["k", "h", "gram"])
            .groupBy("key", "template", (F.col("pos") - F.col("at")).alias("diagonal"), "pos", "at")
            .agg(F.first("label").alias("label"), F.first("base").alias("base"), F.first("length").alias("length"),
                 F.first("k").alias("k")))
    votes = (hits.groupBy("key", "template", "diagonal", "label", "base", "length", "k")
             .agg(F.collect_list(F.struct("pos", "at")).alias("hits")))
    # Neighbouring diagonals; a template of one gram is found as it stands, place by place.
    order = W.partitionBy("key", "template").orderBy("diagonal")
    apart = F.when(F.col("length") <= F.col("k"), F.lit(0)).otherwise(F.ceil(F.lit(drift) * F.col("length")))
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    votes = votes.withColumn("new", F.when(step <= apart, 0).otherwise(1))
    votes = votes.withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    places = votes.select("key", "template", "run", "label", "base", "length", "k", F.explode("hits").alias("hit")).select("*", "hit.*")
    # Every hit begins a stretch; the frame is that of the longest template.
    reach = F.ceil((1 + 2 * F.lit(drift)) * F.col("length"))
    longest = math.ceil((1 + 2 * drift) * max((len(t[1].split()) for t in templates), default=1))
    run = W.partitionBy("key", "template", "run")
    stretch = F.filter(F.collect_list("hit").over(run.orderBy("pos").rangeBetween(0, longest)),
                       lambda h: h["pos"] + F.col("k") <= F.col("pos") + reach)
    covered = F.size(F.array_distinct(F.flatten(F.transform("inside", lambda h: F.sequence(h["at"], h["at"] + F.col("k") - 1)))))
    spans = (places.withColumn("inside", stretch).withColumn("coverage", covered / F.col("length"))
             .where(F.col("coverage") >= threshold)
             .withColumn("last", F.array_max(F.transform("inside", lambda h: h["pos"])) + F.col("k") - 1)
             .select("key", "template", "run", "label", "base", F.col("pos").alias("first"), "last", "coverage"))
    earlier = run.orderBy("first", F.desc("last")).rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("new", F.when(F.coalesce(F.col("first") > F.max("last").over(earlier), F.lit(True)), 1).otherwise(0))
    spans = spans.withColumn("island", F.sum("new").over(run.orderBy("first", F.desc("last")).rowsBetween(W.unboundedPreceding, W.currentRow)))
    best = F.max(F.struct(F.col("coverage"), (-F.col("first")).alias("before"), "last")).alias("best")
    return (spans.groupBy("key", "template", "run", "island", "label", "base").agg(best)
            .select("key", "template", "label", "base", (-F.col("best.before")).alias("first"), "best.last", "best.coverage"))


def scan(docs: DataFrame, text: str = "text", templates: list[tuple[str, str, bool]] | None = None,
         **options) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    ``score`` is the best coverage of a span (0 without one). Null text is empty: no
    words, no labels, null first_word and last_word. Repeated rows and equal texts
    get equal results; an empty table gives no rows; names that clash get an underscore.
    """
    names = ["n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    found = find_spans(docs, text, default_templates() if templates is None else templates, **options)
    base = F.when(F.col("base"), F.col("first"))
    per_text = found.groupBy("key").agg(
        F.count(base).alias("n_base"), F.min(base).cast("bigint").alias("first_word"),
        F.max(base).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("coverage").alias("score"),
        F.array_sort(F.collect_list(F.struct("first", "last", "label", "coverage"))).alias("spans"))
    # Written, so that their size is known: findings are broadcast to the texts while they
    # are small, and joined by a shuffle that Spark can split where they aren't.
    per_text = materialized(per_text, "license_findings")
    n_words, key, *own = fresh(docs, "n_words", "text_key", *names)
    # The key is a column before the join, so that texts nobody asks for aren't shuffled.
    own_key = fresh(docs, "own_key")[0]
    rows = docs.withColumns({n_words: count_alnum_words(F.col(text)), own_key: text_key(F.col(text))})
    rows = rows.join(per_text.toDF(key, *own), F.col(own_key) == F.col(key), "left").drop(own_key, key)
    empty = {"n_base": F.lit(0).cast("bigint"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0),
             "spans": F.array().cast("array<struct<first:int,last:int,label:string,coverage:double>>")}
    return rows.withColumns({o: F.coalesce(F.col(o), empty[n]) for n, o in zip(names, own) if n in empty})


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return scan(docs.select("doc_id", "text")).drop("text", "spans")
