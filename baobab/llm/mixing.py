"""Mixing sources to target weights: weighted sampling by exponential keys.

Sources in code-point order (null last) get the weights 5, 2, 1, repeating, and
share ``budget`` times all words in proportion; a target stops at ``max_epochs``
times its source's words and the excess is shared anew until none is above. A
source takes every document floor(target / words) times (complete epochs); the rest
is drawn without replacement: keys -ln(u) / quality sorted ascending, a prefix sum
up to the remaining budget, the document on the border taken if that ends nearer to
the budget. u comes from a hash of the id, so reruns agree.

No text is shuffled and no source is sorted as a whole: words are summed per
(source, key bucket), the prefix sum over a source's buckets finds the one
bucket in which a source's budget ends, and only that bucket's (key, words) rows are
sorted. Documents then compare their key with their source's border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm._text import count_space_words, fresh, materialized, whole

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
OCTAVE = 1024
SEED = "mix"


def quality_weight(text: Column, size: Column) -> Column:
    """Sampling weight of a document in (0, 1]: falls with the share of symbols and
    with word lengths far from prose. Empty texts weigh 1 (they take no budget)."""
    symbols = F.regexp_count(whole(text), F.lit(r"[#*$%&|<>]"))
    mean = F.length(whole(text)) / size
    tidy = F.when((mean >= 3) & (mean <= 15), 1.0).otherwise(0.5)
    return F.when(size == 0, 1.0).otherwise(tidy / (1.0 + 10.0 * symbols / size))


def uniform(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) fixed by the id (by the text where the id is null)."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), whole(text))))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(float(2 ** 52))


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> adds ``target``.

    Sharing the excess anew until no target is above its limit ends where each
    target is min(limit, rate * weight) for one common rate; sources reach their
    limit in the order of limit / weight, so the rate follows from prefix sums over
    the sources in that order. One row per source: the only global windows here.
    """
    code_point = W.orderBy(F.col("source").asc_nulls_last())
    w = sizes.select("source", "source_size", F.get(F.array(*(F.lit(float(x)) for x in weights)),
                     (F.row_number().over(code_point) - 1) % len(weights)).alias("weight"))
    w = w.withColumn("limit", F.lit(float(max_epochs)) * F.col("source_size"))
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    w = w.select("*", F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("limits_before"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
                 F.sum("weight").over(everything).alias("weights_all"),
                 (F.lit(float(budget)) * F.sum("source_size").over(everything)).alias("total"))
    w = w.withColumn("rate", F.greatest(F.lit(0.0), F.col("total") - F.col("limits_before"))
                     / (F.col("weights_all") - F.col("weights_before")))
    # The common rate is that of the first source in this order that stays below its limit.
    open_ = F.when(F.col("rate") * F.col("weight") < F.col("limit"), F.col("rate"))
    rate = F.first(open_, ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return w.withColumn("rate", rate).select(
        "source", "source_size",
        F.coalesce(F.least(F.col("limit"), F.col("rate") * F.col("weight")), F.col("limit")).alias("target"))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          quality: Column | None = None) -> DataFrame:
    """(source, id, size, key) of every document, written once: all that the plan needs."""
    rows = docs.select(F.col(source).alias("source"), F.col(doc_id).alias("id"), F.col(text).alias("text"),
                       count_space_words(F.col(text)).alias("size"),
                       (F.lit(None) if quality is None else quality).cast("double").alias("weight"))
    weight = quality_weight(F.col("text"), F.col("size")) if quality is None else F.col("weight")
    return materialized(rows.select("source", "id", "size", _key(F.col("id"), F.col("text"), weight).alias("key")),
                        "mix_keys")


def _key(doc_id: Column, text: Column, weight: Column) -> Column:
    return -F.log(uniform(doc_id, text)) / F.greatest(F.lit(1e-6), F.coalesce(weight, F.lit(1.0)))


def _bucket(key: Column) -> Column:
    """Rises with the key: OCTAVE buckets for every doubling. Weights scale a key, so
    whatever they are, a bucket holds about 1 / (3.9 OCTAVE) of a source's keys at most."""
    return F.floor(F.log2(key) * OCTAVE)


def source_plan(slim: DataFrame) -> DataFrame:
    """One row per source of :func:`keyed`: source_size, target, epochs, border (largest
    key drawn once more; null: none)."""
    by_bucket = (slim.withColumn("bucket", _bucket(F.col("key"))).groupBy("source", "bucket")
                 .agg(F.sum("size").alias("words"), F.max("key").alias("last_key")))
    sizes = by_bucket.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sizes).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
        .cast("bigint").alias("epochs"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = (by_bucket.withColumn("upto", F.sum("words").over(upto)).alias("b")
               .join(plan.select("source", "rest").alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
               .select("b.source", "b.bucket", "b.words", "b.upto", "b.last_key", "p.rest"))
    whole_buckets = reached.where(F.col("upto") <= F.col("rest")).groupBy("source").agg(F.max("last_key").alias("border"))
    border_bucket = (reached.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
                     .select("source", "bucket", (F.col("upto") - F.col("words")).alias("before"), "rest"))
    # Rows of a border bucket, repeated rows (equal keys) as one.
    rows = slim.withColumn("bucket", _bucket(F.col("key"))).alias("s").join(
        border_bucket.alias("e"), F.col("s.source").eqNullSafe(F.col("e.source")) & (F.col("s.bucket") == F.col("e.bucket")))
    ties = rows.groupBy("s.source", "s.key", "e.before", "e.rest").agg(F.sum("s.size").alias("size"))
    prior = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow)
    ties = ties.withColumn("end", F.col("before") + F.sum("size").over(prior))
    inside = (ties.where(F.col("end") - F.col("size") / 2 <= F.col("rest"))
              .groupBy("source").agg(F.max("key").alias("border")))
    border = whole_buckets.unionByName(inside).groupBy("source").agg(F.max("border").alias("border"))
    return (plan.alias("p").join(border.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")), "left")
            .select("p.source", "p.source_size", "p.target", "p.epochs",
                    F.when(F.col("p.rest") > 0, F.col("b.border")).alias("border")))


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds copies, 0 to ``max_epochs``, to rows with mix_source and mix_key."""
    p = plan.toDF("p_source", "source_size", "target", "epochs", "border")
    again = F.coalesce(F.col("mix_key") <= F.col("border"), F.lit(False)).cast("bigint")
    return (rows.join(p, F.col("mix_source").eqNullSafe(F.col("p_source")), "left")
            .withColumn("copies", F.col("epochs") + again).drop("p_source", "epochs", "border"))


def mix_table(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; no text is moved.

    Null text has size 0; a null source is a source of its own; rows repeated in id
    and text are drawn together; an empty table gives no rows.
    """
    slim = keyed(docs, **columns)
    rows = slim.select("id", "size", F.col("source").alias("mix_source"), F.col("key").alias("mix_key"))
    return _taken(rows, materialized(source_plan(slim), "mix_plan")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          quality: Column | None = None) -> DataFrame:
    """The mix itself: every document as often as it is taken, the columns of ``docs``.
    The documents stay where they are and meet one plan row per source."""
    # Written, so that its size is known: one row per source is broadcast while it is
    # small, and a join that Spark can split by source where it isn't.
    plan = materialized(source_plan(keyed(docs, doc_id, text, source, quality)), "mix_plan")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    size = count_space_words(F.col(f"row.{text}"))
    weight = quality_weight(F.col(f"row.{text}"), size) if quality is None else F.col("weight")
    rows = docs.select(row, (F.lit(None) if quality is None else quality).cast("double").alias("weight"))
    rows = rows.select("row", F.col(f"row.{source}").alias("mix_source"),
                       _key(F.col(f"row.{doc_id}"), F.col(f"row.{text}"), weight).alias("mix_key"))
    taken = _taken(rows, plan).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
