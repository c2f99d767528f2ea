"""Heavy keys: found by a sketch, joined by salting them alone.

AQE splits a hot partition only between two plain shuffles of a join, and only once it
is there. Where the key is known to be heavy before the shuffle, its facts are dealt to
``salts`` tasks and the dimension's rows of those keys go to each; every other key moves
once and lands as in the plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.01
SALTS = 32


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> Column:
    """Scalar: array of the keys that hold ``share`` of the rows or more.

    A frequent-items sketch keeps a bounded number of counters per task (a few times
    1 / share) and merges them, so no key is shuffled. It never misses a heavy key; one
    that is nearly heavy can be in the array as well. A NULL key is never in it.
    """
    tracked = 2 ** math.ceil(math.log2(8 / share))  # the sketch's error is below share / 6
    most = math.ceil(2 / share)
    known = df.where(F.col(key).isNotNull())
    top = known.agg(F.expr(f"approx_top_k({key}, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    heavy = F.transform(F.filter("top", lambda t: t["count"] >= share * F.col("n")), lambda t: t["item"])
    return top.select(heavy.alias("heavy")).scalar()


def salted_join(facts: DataFrame, dim: DataFrame, key: str, cols: list[str], how: str = "inner",
                share: float = SHARE, salts: int = SALTS) -> DataFrame:
    """J1/J2 over facts with heavy keys: the rows of ``facts.join(dim, key, how)`` for
    ``how`` inner or left.

    The salt of a fact is a hash of its whole row, so that a task run again deals the
    same; equal rows share a salt. The dimension's rows of heavy keys are repeated
    ``salts`` times (at most 2 / share keys of them), all others once.
    """
    if how not in ("inner", "left"):
        raise ValueError("a repeated dimension row must not be a result by itself: inner or left only")
    heavy = heavy_keys(facts, key, share)
    f = facts.withColumn("_heavy", F.coalesce(F.array_contains(heavy, F.col(key)), F.lit(False)))
    f = f.withColumn("_salt", F.when(F.col("_heavy"), F.pmod(F.xxhash64(*facts.columns), F.lit(salts))).otherwise(0).cast("int"))
    # The dimension's keys are compared with the facts' heavy keys, in the facts' type.
    d = dim.select(key, *cols)
    parts = F.when(F.array_contains(heavy, F.col(key)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    d = d.where(F.col(key).isNotNull()).withColumn("_salt", F.explode(parts))
    return f.join(d, [key, "_salt"], how).drop("_heavy", "_salt")
