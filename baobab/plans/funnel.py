"""Funnel queries (A22-A25) and word count (A3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from baobab.operators import funnel as FN
from baobab.operators.text import top_words, word_counts
from baobab.plans import model as M
from baobab.plans.base import query, wh
from baobab.plans.oracle_model import with_views as V

def flags_sql(src: str, *keys: str) -> str:
    """Oracle text: one row per (keys, session) with a 0/1 column per step."""
    steps = ", ".join(f"CAST(bool_or(event_type = '{t}') AS INTEGER) AS {name}" for t, name in FN.STEPS)
    by = ", ".join([*keys, "session_id"])
    return f"SELECT {by}, {steps} FROM {src} WHERE session_id IS NOT NULL GROUP BY {by}"


def steps_sql(src: str, *keys: str, steps: list[str] | None = None) -> str:
    """Oracle text: sessions and sessions per step for each of ``keys``."""
    sums = [f"CAST(SUM({n}) AS BIGINT) AS {n}" for n in steps or [name for _, name in FN.STEPS]]
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join([*keys, 'COUNT(*) AS sessions', *sums])} FROM ({flags_sql(src, *keys)}){group}"


@query("funnel", V(steps_sql("events_nav"), "events_nav"))
def funnel_q(spark, sf_dir):
    """Distinct sessions per step in one pass."""
    return FN.funnel_counts(M.events_nav(wh(spark, sf_dir)))


@query("funnel_rates", V(f"""
SELECT *, round(100.0 * vues / sessions, 1) AS taux_vue, round(100.0 * paniers / vues, 1) AS taux_panier,
       round(100.0 * achats / paniers, 1) AS taux_achat, round(100.0 * achats / sessions, 1) AS taux_global
FROM ({steps_sql("events_nav")})""", "events_nav"))
def funnel_rates_q(spark, sf_dir):
    """Step-to-step and overall rates."""
    return FN.with_rates(FN.funnel_counts(M.events_nav(wh(spark, sf_dir))))


def _segment_sql(seg: str, src: str, top: int | None) -> str:
    s = f"SELECT *, round(100.0 * achats / sessions, 2) AS taux_global FROM ({steps_sql(src, seg, steps=['achats'])})"
    if top:
        s += f" ORDER BY sessions DESC, {seg} NULLS LAST LIMIT {top}"
    return s


@query("funnel_by_device", V(_segment_sql("device", "events_nav", None), "events_nav"))
def funnel_by_device_q(spark, sf_dir):
    """Conversion per device (a session may appear under several devices)."""
    return FN.segment_conversion(M.events_nav(wh(spark, sf_dir)), "device")


@query("funnel_by_city", V(_segment_sql("ville", "events_city", 10), "events_city"))
def funnel_by_city_q(spark, sf_dir):
    """Conversion per city of the user, top 10 cities by sessions.

    The city is an attribute of the user, so each (user, session) is first reduced
    to its step flags and only then joined to the user's city: the join sees one
    row per session instead of one per event."""
    w = wh(spark, sf_dir)
    flags = FN.session_flags(M.events_nav(w), ["user_id"])
    per_city = (flags.join(M.user_cities(w), "user_id", "left").groupBy("ville")
                .agg(F.count(F.lit(1)).alias("sessions"), F.sum("achats").cast("bigint").alias("achats")))
    rate = F.round(F.try_divide(F.lit(100.0) * F.col("achats"), F.col("sessions").cast("double")), 2)
    return (per_city.withColumn("taux_global", rate)
            .orderBy(F.col("sessions").desc(), F.col("ville").asc_nulls_last()).limit(10))


_WORDS = r"""
SELECT mot, COUNT(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS mot FROM documents)
WHERE mot <> '' GROUP BY mot"""


@query("word_count", V(_WORDS))
def word_count_q(spark, sf_dir):
    """A3: word frequencies over every document, whole texts."""
    return word_counts(M.documents_text(wh(spark, sf_dir))).orderBy(F.col("n").desc(), "mot")


@query("word_count_top15", V(_WORDS + " ORDER BY n DESC, mot LIMIT 15"))
def word_count_top_q(spark, sf_dir):
    """A3 as displayed: the 15 most frequent words."""
    return top_words(M.documents_text(wh(spark, sf_dir)), 15)
