"""Distinct counts by mergeable sketches.

A HyperLogLog sketch per column is a few kilobytes whatever the column holds, all of a
table's come from one scan, and sketches of parts (days, partitions, feeds) merge into
that of the whole without reading the parts again. With ``lg_k`` = 12 the standard error
is about 1.6 %; the exact counts of ``operators.profile`` stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
# Types that a sketch takes as they are; the others are counted by their text.
_PLAIN = ("int", "bigint", "string", "binary")


def _value(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c if dict(df.dtypes)[name] in _PLAIN else c.cast("string")


def column_sketches(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None,
                    lg_k: int = LG_K) -> DataFrame:
    """One row per ``by`` group (one in all without): ``rows``, and for every column ``c``
    the known values ``c_known`` and their sketch ``c_sketch``. One scan, and one row per
    group and map task in the shuffle."""
    columns = columns or [c for c in df.columns if c not in (by or [])]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        aggs += [F.count(F.col(f"`{c}`")).alias(f"{c}_known"), F.hll_sketch_agg(_value(df, c), F.lit(lg_k)).alias(f"{c}_sketch")]
    return df.groupBy(*(by or [])).agg(*aggs)


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of parts as those of their union, per ``by`` group: the same columns."""
    columns = [c.removesuffix("_sketch") for c in sketches.columns if c.endswith("_sketch")]
    aggs = [F.sum("rows").alias("rows")]
    for c in columns:
        aggs += [F.sum(f"`{c}_known`").alias(f"{c}_known"), F.hll_union_agg(f"`{c}_sketch`").alias(f"{c}_sketch")]
    return sketches.groupBy(*(by or [])).agg(*aggs)


def estimated(sketches: DataFrame, column: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.col(f"`{column}_sketch`")), F.lit(0))


def sketched_profile(df: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """P1 with estimated distinct counts: per column its type, rows, NULLs and distinct
    values, for any number of columns in one scan."""
    sketches = column_sketches(df, lg_k=lg_k)
    lines = [F.struct(F.lit(f.name).alias("colonne"), F.col("rows").alias("nb_lignes"),
                      (F.col("rows") - F.col(f"`{f.name}_known`")).alias("nb_null"), estimated(sketches, f.name).alias("nb_distinct_estime"),
                      F.lit(f.dataType.simpleString()).alias("type_spark")) for f in df.schema.fields]
    return sketches.select(F.inline(F.array(*lines)))
