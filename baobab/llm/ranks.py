"""Global ranks without a single sorting task.

Rows are dealt into ranges of (group, order), numbered inside each range, and every
range is shifted by the rows of its group in the ranges before it. A group of any
size spans as many ranges as it needs; the only window over a whole group holds one
row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baobab.llm._text import fresh, materialized


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """``df`` with the rank of each row in its group (long, from 0, nulls first) and the
    rows of the group.

    Rows that tie in ``order`` take arbitrary neighbouring ranks, so ``order`` must tell
    apart all rows whose order matters. The dealt rows are written to the shared folder
    once: ranges and ties are then fixed, whatever executors are lost. A null group is a
    group like any other; an empty table stays empty.
    """
    tie, part, rows, part_, rows_, before = fresh(df, "tie", "part", "rows", "part_of", "rows_of", "before")
    keys = [F.col(f"`{c}`") for c in group]
    dealt = materialized(
        df.withColumn(tie, F.monotonically_increasing_id())
          .repartitionByRange(*keys, *(F.col(f"`{c}`") for c in order), F.col(tie))
          .withColumn(part, F.spark_partition_id()), "ranked")
    inside = Window.partitionBy(part, *keys).orderBy(*(F.col(f"`{c}`") for c in order), tie)
    numbered = dealt.withColumn(rows, F.row_number().over(inside).cast("bigint") - 1)
    names = fresh(df, *(f"{c}_of" for c in group))
    counts = dealt.groupBy(F.col(part).alias(part_), *(k.alias(n) for k, n in zip(keys, names))).agg(F.count(F.lit(1)).alias(rows_))
    whole = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(part_).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumns({before: F.coalesce(F.sum(rows_).over(earlier), F.lit(0)), total: F.sum(rows_).over(whole)})
    same = F.col(part) == F.col(part_)
    for k, n in zip(keys, names):
        same = same & k.eqNullSafe(F.col(n))
    return (numbered.join(shifts, same)
            .select(*(F.col(f"`{c}`") for c in df.columns), (F.col(rows) + F.col(before)).alias(rank), F.col(total)))
