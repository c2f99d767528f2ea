"""Two tables compared as multisets by checksums per bucket (S9, at any size).

Each side is reduced to a few numbers per bucket, the bucket of a row being part of its
hash: rows, sum and xor of a 64-bit row hash. None of them depends on the order of the
rows, and equal buckets need no further look. Only the rows of buckets that differ are
grouped and told apart, so equal tables shuffle a bucket list and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.operators.quality import fingerprint

BUCKETS = 4096


def _row_hash(columns: list[str]) -> Column:
    return fingerprint([F.col(f"`{c}`") for c in columns])["a"]


def checksums(df: DataFrame, columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, total, parity): an order-independent checksum of each bucket. The sum
    is over 32-bit halves, so it doesn't overflow below 2^31 rows a bucket."""
    h = _row_hash(columns or df.columns)
    rows = df.select(h.alias("h")).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    halves = F.struct(F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.sum(F.col("h").bitwiseAND(F.lit(2 ** 32 - 1))).alias("low"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), halves.alias("total"), F.bit_xor("h").alias("parity"))


def differing_buckets(a: DataFrame, b: DataFrame, columns: list[str] | None = None, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose checksums differ (at most ``buckets`` numbers to the driver)."""
    columns = columns or a.columns
    x, y = (checksums(d, columns, buckets).select("bucket", F.struct("rows", "total", "parity").alias(n)) for d, n in ((a, "x"), (b, "y")))
    both = x.join(y, "bucket", "full").where(~F.col("x").eqNullSafe(F.col("y")))
    return sorted(r["bucket"] for r in both.select("bucket").collect())


def differences(a: DataFrame, b: DataFrame, columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows that ``a`` and ``b`` don't hold equally often: their columns, and how often
    each side has them (``in_a``, ``in_b``). Empty for equal tables."""
    columns = columns or a.columns
    bad = differing_buckets(a, b, columns, buckets)
    mine = F.pmod(_row_hash(columns), F.lit(buckets)).cast("int").isin(bad) if bad else F.lit(False)
    names = [f"`{c}`" for c in columns]
    sides = (a.select(*names).where(mine).withColumns({"in_a": F.lit(1), "in_b": F.lit(0)})
             .unionByName(b.select(*names).where(mine).withColumns({"in_a": F.lit(0), "in_b": F.lit(1)})))
    counted = sides.groupBy(*names).agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    return counted.where("in_a <> in_b")
