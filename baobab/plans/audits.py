"""Exploration profiles (P1-P8, A6, A36) and data-quality audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from baobab.operators import profile, quality, sketches
from baobab.operators.windows import behind_running_max
from baobab.plans import model as M
from baobab.plans.base import AS_OF, orders_clean, query, wh
from baobab.plans.cleaning import RAW_COLS
from baobab.plans.oracle_model import with_views as V
from baobab.session import scratch_path

# Payment status spellings after lower/trim/accent removal.
PAY_SUCCESS = ["reussi", "ok", "succes", "success"]
PAY_FAILURE = ["echec", "failure"]
MISSING_LIKE = ["N/A", "NA", "", "NONE"]

# Expected Spark types of the orders export (P1 reports them; the oracle states them).
ORDERS_RAW_TYPES = {"order_id": "bigint", "customer_id": "bigint", "date_commande": "timestamp_ntz",
                    "statut": "string", "canal": "string", "frais_livraison_fcfa": "int",
                    "montant_total_fcfa": "string", "priorite": "string"}


@query("profile_columns", V(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, '{t}' AS type_spark, COUNT(*) AS nb_lignes, "
    f"COUNT(*) - COUNT({c}) AS nb_null, COUNT(DISTINCT {c}) AS nb_distinct FROM orders_raw"
    for c, t in ORDERS_RAW_TYPES.items()), "orders_raw"))
def profile_columns_q(spark, sf_dir):
    """Shape and per-column profile of the orders export."""
    return profile.profile_columns(M.orders_raw(wh(spark, sf_dir)))


@query("profile_columns_sketch")
def profile_columns_sketch_q(spark, sf_dir):
    """P1/A5 with estimated distinct counts: all columns in one scan."""
    return sketches.sketched_profile(M.orders_raw(wh(spark, sf_dir)))


@query("monthly_visitors_sketch")
def monthly_visitors_sketch_q(spark, sf_dir):
    """A5: users per month from daily sketches that are stored, then merged: a day's
    events are read once, whatever periods are asked for later."""
    days = M.events_nav(wh(spark, sf_dir)).select(F.to_date("event_time").alias("jour"), "user_id", "session_id")
    path = scratch_path(spark, "daily_sketches")
    sketches.column_sketches(days, ["user_id", "session_id"], by=["jour"]).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("mois", F.date_format("jour", "yyyy-MM"))
    months = sketches.merge_sketches(stored, by=["mois"])
    return months.select("mois", F.col("rows").alias("nb_evenements"), sketches.estimated(months, "user_id").alias("utilisateurs_estimes"),
                         sketches.estimated(months, "session_id").alias("sessions_estimees"))


@query("share_3dp", V("""
SELECT statut, round(COUNT(*) * 1.0 / (SELECT COUNT(*) FROM orders_raw), 3) AS part
FROM orders_raw GROUP BY statut""", "orders_raw"))
def share_3dp_q(spark, sf_dir):
    """Normalised value counts, three decimals."""
    return profile.value_shares(M.orders_raw(wh(spark, sf_dir)), "statut", 3)


@query("missing_like_emails", V(f"""
SELECT COUNT(*) AS nb_manquants FROM customers_raw
WHERE email IS NULL OR upper(trim(email)) IN ({", ".join("'" + t + "'" for t in MISSING_LIKE)})""",
                                "customers_raw"))
def missing_like_q(spark, sf_dir):
    """P5: missing-looking e-mails."""
    return profile.missing_like(M.customers_raw(wh(spark, sf_dir)), "email", MISSING_LIKE)


@query("city_distinct_before_after", V("""
SELECT COUNT(DISTINCT ville) AS nb_avant, COUNT(DISTINCT lower(trim(ville))) AS nb_apres,
       COUNT(DISTINCT ville) - COUNT(DISTINCT lower(trim(ville))) AS difference
FROM customers_raw""", "customers_raw"))
def city_distinct_q(spark, sf_dir):
    """Distinct cities before/after lower+trim."""
    return profile.distinct_before_after(M.customers_raw(wh(spark, sf_dir)), "ville")


@query("suffix_rate", V("""
SELECT COUNT(CASE WHEN lower(montant_total_fcfa) LIKE '%fcfa%' THEN 1 END) AS nb,
       round(100.0 * COUNT(CASE WHEN lower(montant_total_fcfa) LIKE '%fcfa%' THEN 1 END) / COUNT(*), 2) AS pct
FROM orders_raw""", "orders_raw"))
def suffix_rate_q(spark, sf_dir):
    """Amounts carrying the currency text (any case)."""
    return profile.contains_rate(M.orders_raw(wh(spark, sf_dir)), "montant_total_fcfa", "FCFA")


@query("age_anomalies", V(f"""
SELECT COUNT(CASE WHEN d IS NULL THEN 1 END) AS nb_illisibles,
       COUNT(CASE WHEN age < 0 THEN 1 END) AS nb_futur,
       COUNT(CASE WHEN age > 120 THEN 1 END) AS nb_plus_120_ans,
       round(MIN(age), 2) AS age_min, round(MAX(age), 2) AS age_max
FROM (SELECT d, date_diff('day', d, DATE '{AS_OF}') / 365.25 AS age
      FROM (SELECT try_strptime(date_naissance, '%Y-%m-%d')::DATE AS d FROM customers_raw))""",
                          "customers_raw"))
def age_anomalies_q(spark, sf_dir):
    """Implausible birth dates (fixed reference date)."""
    return quality.age_anomalies(M.customers_raw(wh(spark, sf_dir)), "date_naissance", AS_OF)


@query("null_counts", V("SELECT " + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in RAW_COLS)
                        + " FROM customers_raw", "customers_raw"))
def null_counts_q(spark, sf_dir):
    """NULLs of every column in one pass."""
    return quality.null_counts(M.customers_raw(wh(spark, sf_dir)))


@query("duplicate_count", V(f"""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS nb_doublons
FROM (SELECT COUNT(*) AS n FROM customers_raw GROUP BY {", ".join(RAW_COLS)})""", "customers_raw"))
def duplicate_count_q(spark, sf_dir):
    """Exact duplicate rows (count minus distinct count) in one job."""
    return quality.surplus_rows(M.customers_raw(wh(spark, sf_dir)))


@query("padded_names", V("SELECT COUNT(CASE WHEN nom <> trim(nom) THEN 1 END) AS nb_espaces_parasites "
                         "FROM customers_raw", "customers_raw"))
def padded_names_q(spark, sf_dir):
    """Names with stray spaces."""
    return quality.padded_values(M.customers_raw(wh(spark, sf_dir)), "nom")


_NORM = ", ".join("lower(trim(email))" if c == "email" else c for c in RAW_COLS)


@query("near_duplicates", V(f"""
SELECT (SELECT COUNT(*) FROM customers_raw) AS nb_lignes,
       (SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customers_raw
          GROUP BY {", ".join(RAW_COLS)})) AS nb_doublons_exacts,
       (SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customers_raw GROUP BY {_NORM}))
       - (SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customers_raw
          GROUP BY {", ".join(RAW_COLS)})) AS nb_quasi_doublons""", "customers_raw"))
def near_duplicates_q(spark, sf_dir):
    """R2: exact duplicates vs rows equal once the e-mail is normalised."""
    return quality.near_duplicates(M.customers_raw(wh(spark, sf_dir)),
                                   {"email": F.lower(F.trim(F.col("email")))})


@query("customer_skew", V("""
SELECT (SELECT customer_id FROM c ORDER BY n DESC, customer_id LIMIT 1) AS cle_dominante,
       (SELECT MAX(n) FROM c) AS nb_lignes_cle,
       round(100.0 * (SELECT MAX(n) FROM c) / (SELECT total FROM t), 2) AS part_cle_pct,
       round(100.0 * (SELECT SUM(n) FROM (SELECT n FROM c ORDER BY n DESC, customer_id LIMIT 10))
             / (SELECT total FROM t), 2) AS part_top10_pct""", "orders_raw", extra=[
    ("c", "SELECT customer_id, COUNT(*) AS n FROM orders_raw GROUP BY customer_id"),
    ("t", "SELECT SUM(n) AS total FROM c")]))
def customer_skew_q(spark, sf_dir):
    """Concentration of orders on the heaviest customers."""
    return quality.key_concentration(M.orders_raw(wh(spark, sf_dir)), "customer_id", 10)


@query("order_total_check", V("""
SELECT COUNT(*) AS nb_commandes,
       COUNT(CASE WHEN l.total IS NULL THEN 1 END) AS nb_sans_lignes,
       COUNT(CASE WHEN l.total + o.frais_livraison_fcfa = o.montant_fcfa THEN 1 END) AS nb_coherentes,
       COUNT(CASE WHEN l.total + o.frais_livraison_fcfa <> o.montant_fcfa THEN 1 END) AS nb_ecarts,
       CAST(SUM(abs(l.total + o.frais_livraison_fcfa - o.montant_fcfa)) AS BIGINT) AS ecart_absolu_total
FROM orders_clean o
LEFT JOIN (SELECT order_id, SUM(quantite * prix_unitaire_fcfa) AS total FROM order_items GROUP BY 1) l
  ON o.order_id = l.order_id""", "orders_clean", "order_items"))
def order_total_check_q(spark, sf_dir):
    """sum(quantity x unit price) + shipping against the order total."""
    w = wh(spark, sf_dir)
    lines = (M.order_items(w).groupBy("order_id")
             .agg(F.sum(F.col("quantite") * F.col("prix_unitaire_fcfa")).alias("total")))
    j = orders_clean(w).join(lines, "order_id", "left")
    expected = F.col("total") + F.col("frais_livraison_fcfa")
    return j.agg(
        F.count(F.lit(1)).alias("nb_commandes"),
        F.count(F.when(F.col("total").isNull(), F.lit(1))).alias("nb_sans_lignes"),
        F.count(F.when(expected == F.col("montant_fcfa"), F.lit(1))).alias("nb_coherentes"),
        F.count(F.when(expected != F.col("montant_fcfa"), F.lit(1))).alias("nb_ecarts"),
        F.sum(F.abs(expected - F.col("montant_fcfa"))).alias("ecart_absolu_total"),
    )


_PAY_NORM = (f"CASE WHEN lower(strip_accents(trim(statut))) IN ({', '.join(repr(s) for s in PAY_SUCCESS)}) "
             f"THEN 'success' WHEN lower(strip_accents(trim(statut))) IN "
             f"({', '.join(repr(s) for s in PAY_FAILURE)}) THEN 'failure' ELSE 'unknown' END")


@query("payment_status", V(f"""
SELECT statut, {_PAY_NORM} AS statut_norm, COUNT(*) AS n FROM payments_raw GROUP BY 1, 2""",
                           "payments_raw"))
def payment_status_q(spark, sf_dir):
    """Payment status spellings mapped to success / failure."""
    p = M.payments_raw(wh(spark, sf_dir))
    norm = quality.status_normalized("statut", PAY_SUCCESS, PAY_FAILURE)
    return p.groupBy("statut", norm.alias("statut_norm")).agg(F.count(F.lit(1)).alias("n"))


@query("payment_audit", V("""
SELECT COUNT(*) AS nb_paiements,
       COUNT(CASE WHEN p.montant_fcfa < 0 THEN 1 END) AS nb_negatifs,
       COUNT(CASE WHEN o.order_id IS NOT NULL AND p.montant_fcfa >= 0
                   AND p.montant_fcfa <> o.montant_fcfa THEN 1 END) AS nb_partiels,
       COUNT(CASE WHEN o.order_id IS NULL THEN 1 END) AS nb_orphelins,
       CAST(COALESCE(SUM(CASE WHEN o.order_id IS NULL THEN p.montant_fcfa END), 0) AS BIGINT) AS montant_orphelins
FROM payments_raw p LEFT JOIN orders_clean o ON p.order_id = o.order_id""", "payments_raw", "orders_clean"))
def payment_audit_q(spark, sf_dir):
    """Negative, partial and orphan payments."""
    w = wh(spark, sf_dir)
    return quality.payment_audit(M.payments_raw(w), orders_clean(w))


@query("payment_dedup", V("""
SELECT payment_id, order_id, customer_id, montant_fcfa, methode, statut,
       strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS paid_at
FROM (SELECT DISTINCT * FROM payments_raw)""", "payments_raw"))
def payment_dedup_q(spark, sf_dir):
    """At-least-once duplicates removed (one row per payment id)."""
    out = quality.dedup_on_key(M.payments_raw(wh(spark, sf_dir)), "payment_id", "paid_at")
    return out.withColumn("paid_at", F.date_format("paid_at", "yyyy-MM-dd HH:mm:ss"))


LATE_EVENTS = V("""
SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       CAST(date_diff('second', event_time, max_avant) AS BIGINT) AS retard_s
FROM (SELECT *, max(event_time) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS max_avant FROM events_arrivals)
WHERE event_time < max_avant""", "events_arrivals")


@query("late_events", LATE_EVENTS)
def late_events_q(spark, sf_dir):
    """Events whose time is behind the latest time already received."""
    e = M.events_arrivals(wh(spark, sf_dir)).select("event_id", "event_time")
    x = behind_running_max(e, "event_id", "event_time")
    late = x.where(F.col("event_time") < F.col("max_avant"))
    return late.select(
        "event_id",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        (F.unix_timestamp("max_avant") - F.unix_timestamp("event_time")).alias("retard_s"))
