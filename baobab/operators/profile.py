"""Exploration operators (the course's pandas profiling, as distributed jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.operators.quality import measure_profile
from baobab.operators.windows import share_of_total


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column, its type, row count, NULL count and exact distinct count.

    Every count is made in the column's own type (see ``measure_profile``): each column
    is read once more for its distinct values, and no row is expanded."""
    p = measure_profile(df, {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(df.columns)})
    lines = [F.struct(F.lit(f.name).alias("colonne"), F.col(f"c{i}_rows").alias("nb_lignes"),
                      F.col(f"c{i}_nulls").alias("nb_null"), F.col(f"c{i}_distinct").alias("nb_distinct"),
                      F.lit(f.dataType.simpleString()).alias("type_spark")) for i, f in enumerate(df.schema.fields)]
    return p.select(F.inline(F.array(*lines)))


def value_shares(df: DataFrame, col: str, digits: int = 3) -> DataFrame:
    """Share of each value among all rows (pandas ``value_counts(normalize)``)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, "n", "part", scale=1.0, digits=digits).drop("n")


def distinct_before_after(df: DataFrame, col: str) -> DataFrame:
    """Distinct values before and after lower(trim()), and the difference: distinct
    values first, then grouped by their normalised form."""
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    forms = values.groupBy(F.lower(F.trim(F.col(col))).alias("form")).agg(F.count(F.lit(1)).alias("spellings"))
    before = F.coalesce(F.sum("spellings"), F.lit(0)).cast("bigint")
    return forms.agg(before.alias("nb_avant"), F.count(F.lit(1)).alias("nb_apres"),
                     (before - F.count(F.lit(1))).alias("difference"))


def contains_rate(df: DataFrame, col: str, token: str, digits: int = 2) -> DataFrame:
    """Rows whose text contains ``token`` (case-insensitive), count and percent."""
    hit = F.lower(F.col(col)).contains(token.lower())
    return df.agg(
        F.count(F.when(hit, F.lit(1))).alias("nb"),
        F.round(F.lit(100.0) * F.count(F.when(hit, F.lit(1))) / F.count(F.lit(1)), digits).alias("pct"),
    )


def missing_like(df: DataFrame, col: str, tokens: list[str]) -> DataFrame:
    """P5: NULL or upper(trim(value)) in ``tokens``."""
    u = F.upper(F.trim(F.col(col)))
    return df.agg(F.count(F.when(F.col(col).isNull() | u.isin(*tokens), F.lit(1))).alias("nb_manquants"))
