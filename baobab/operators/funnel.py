"""Conversion funnel: distinct sessions reaching each step, overall and by segment.

``COUNT(DISTINCT CASE WHEN type = x THEN session END)`` for several steps makes
Spark expand every row once per distinct aggregate. Instead each (segment,
session) pair is first reduced to one row of step flags (a partial aggregation,
so a session or segment holding a large share of the events is pre-reduced on the
mappers), then the flags are summed: exact, one extra small shuffle, no Expand.

Steps are not nested (a purchase without a cart event counts as a purchase), and a
session whose events carry several segment values counts once in each segment:
segment totals do not add up to the overall funnel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Funnel steps (event type -> output column).
STEPS = [("view_product", "vues"), ("add_to_cart", "paniers"), ("purchase", "achats")]


def session_flags(events: DataFrame, segments: list[str], session: str = "session_id",
                  etype: str = "event_type") -> DataFrame:
    """One row per (segments, session) with a 0/1 flag per step."""
    flags = [F.max(F.when(F.col(etype) == t, F.lit(1)).otherwise(F.lit(0))).alias(name)
             for t, name in STEPS]
    return (events.where(F.col(session).isNotNull())
                  .groupBy(*segments, session).agg(*flags))


def funnel_counts(events: DataFrame, segments: list[str] | None = None,
                  session: str = "session_id", etype: str = "event_type") -> DataFrame:
    """Sessions and sessions per step (overall or per segment)."""
    segments = segments or []
    f = session_flags(events, segments, session, etype)
    sums = [F.sum(name).cast("bigint").alias(name) for _, name in STEPS]
    if segments:
        return f.groupBy(*segments).agg(F.count(F.lit(1)).alias("sessions"), *sums)
    return f.agg(F.count(F.lit(1)).alias("sessions"), *sums)


def _rate(num: str, den: str, digits: int) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * F.col(num), F.col(den).cast("double")), digits)


def with_rates(counts: DataFrame, digits: int = 1) -> DataFrame:
    """Step-to-step and overall rates in percent (NULL on empty steps)."""
    return counts.withColumns({
        "taux_vue": _rate("vues", "sessions", digits),
        "taux_panier": _rate("paniers", "vues", digits),
        "taux_achat": _rate("achats", "paniers", digits),
        "taux_global": _rate("achats", "sessions", digits),
    })


def segment_conversion(events: DataFrame, segment: str, digits: int = 2,
                       top: int | None = None) -> DataFrame:
    """Sessions, buying sessions and overall rate per segment value,
    optionally the ``top`` segments by sessions (ties by segment value)."""
    c = funnel_counts(events, [segment]).select(segment, "sessions", "achats")
    c = c.withColumn("taux_global", _rate("achats", "sessions", digits))
    if top is not None:
        c = c.orderBy(F.col("sessions").desc(), F.col(segment).asc_nulls_last()).limit(top)
    return c
