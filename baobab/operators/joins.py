"""Join operators: enrichment, semi/anti audits and the lost-vs-duplicated audit.

Strategy is left to Catalyst and AQE: a dimension under the broadcast threshold
(statistics-checked at plan time, re-checked at run time by AQE) is broadcast;
otherwise both sides shuffle on the key and AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own_partitions(dim: DataFrame) -> DataFrame:
    """``dim`` (grouped by the key it is about to be joined on) in partitions of its own.

    Joined as it is, it brings the shuffle of its aggregate along, and AQE splits a hot
    key only between two shuffles made for the join. Rebalanced, it is shuffled once
    more, so a fact key holding a third of the rows is split over tasks.
    """
    return dim.hint("rebalance")


def enrich(facts: DataFrame, dim: DataFrame, key: str, cols: list[str],
           how: str = "inner") -> DataFrame:
    """Facts joined to ``cols`` of the dimension on a shared key name."""
    return facts.join(dim.select(key, *cols), on=key, how=how)


def anti(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
         facts_on_right: bool = False) -> DataFrame:
    """Rows of ``left`` without a match (NULL keys never match).

    AQE splits a hot key on the left of an anti join only. Where the right side holds the
    facts (J8), ``facts_on_right`` reduces it to distinct keys on the mappers.
    """
    rk = right_key or left_key
    r = right.select(F.col(rk).alias("_rk"))
    if facts_on_right:
        r = r.where(F.col("_rk").isNotNull()).distinct()
    return left.join(r, F.col(left_key) == F.col("_rk"), "left_anti")


def not_in(left: DataFrame, right: DataFrame, left_key: str,
           right_key: str | None = None) -> DataFrame:
    """``left_key NOT IN (SELECT right_key FROM right)`` with SQL semantics.

    An empty right side keeps every row; otherwise a NULL left key never passes and
    a single NULL on the right empties the result. Written as a hash anti join plus
    one scalar subquery (empty? holds a NULL?), so it scales like any anti join (the null-aware plan
    SQL uses for NOT IN needs a broadcastable right side).
    """
    rk = right_key or left_key
    right_keys = right.select(F.col(rk).alias("_rk"))
    # One scalar answers both questions: 0 = right side empty, 1 = rows without
    # NULL, 2 = holds a NULL.
    mode = right_keys.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(0))
         .when(F.count(F.when(F.col("_rk").isNull(), F.lit(1))) > 0, F.lit(2))
         .otherwise(F.lit(1))).scalar()
    # mode picks the rule; Spark infers the filter on both sides and reuses the subquery
    keep = F.element_at(F.array(F.lit(True), F.col(left_key).isNotNull(), F.lit(False)), mode + 1)
    return anti(left.where(keep), right_keys, left_key, "_rk")


def anti_by_outer(left: DataFrame, right: DataFrame, left_key: str,
                  right_key: str | None = None) -> DataFrame:
    """The same as :func:`anti` written as LEFT JOIN ... WHERE right IS NULL.

    The right side is reduced to distinct keys first so the outer join cannot
    multiply left rows.
    """
    rk = right_key or left_key
    r = own_partitions(right.select(F.col(rk).alias("_rk")).distinct())
    return (left.join(r, F.col(left_key) == F.col("_rk"), "left")
                .where(F.col("_rk").isNull()).drop("_rk"))


def partition_check(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """|semi| + |anti| = |left|, from one left join of per-key row counts
    against distinct right keys (one pass instead of three counting jobs)."""
    per_key = left.groupBy(F.col(key).alias("_lk")).agg(F.count(F.lit(1)).alias("_n"))
    r = right.select(F.col(key).alias("_rk")).distinct().withColumn("_hit", F.lit(1))
    j = per_key.join(r, F.col("_lk") == F.col("_rk"), "left")
    hit = F.col("_hit").isNotNull()
    return j.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("nb_gauche"),
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).cast("bigint").alias("nb_semi"),
        F.coalesce(F.sum(F.when(~hit, F.col("_n"))), F.lit(0)).cast("bigint").alias("nb_anti"),
    ).withColumn("partition_ok", F.col("nb_semi") + F.col("nb_anti") == F.col("nb_gauche"))


def join_audit(facts: DataFrame, dim: DataFrame, key: str, measure: str,
               where: Column | None = None) -> DataFrame:
    """What an inner enrichment join does to the facts.

    Both sides are reduced per key first -- facts to (rows, measure sum), the
    dimension to its number of matches -- and joined once: every figure of the
    report is linear in those per-key values, so the inner join's copies are
    counted without being produced and a hot key is a single row. Reports rows and
    ``measure`` sums before and after, lost rows (no match) and fan-out rows (extra
    copies) separately: a net difference can hide losses offset by duplications.
    """
    src = facts.where(where) if where is not None else facts
    f = src.groupBy(F.col(key).alias("_fk")).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(measure), F.lit(0)).alias("_s"))
    m = dim.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_m"))
    j = f.join(m, F.col("_fk") == F.col("_k"), "left")
    c = F.coalesce(F.col("_m"), F.lit(0))
    n, v = F.col("_n"), F.col("_s")

    def total(e: Column, name: str) -> Column:  # 0, not NULL, on empty facts
        return F.coalesce(F.sum(e), F.lit(0)).cast("bigint").alias(name)

    return j.agg(
        total(n, "nb_avant"),
        total(n * c, "nb_apres"),
        total(F.when(c == 0, n).otherwise(F.lit(0)), "nb_perdues"),
        total(F.when(c > 1, n * (c - 1)).otherwise(F.lit(0)), "nb_dupliquees"),
        total(v, "somme_avant"),
        total(v * c, "somme_apres"),
        total(F.when(c == 0, v).otherwise(F.lit(0)), "somme_perdue"),
        total(F.when(c > 1, v * (c - 1)).otherwise(F.lit(0)), "somme_dupliquee"),
    )
