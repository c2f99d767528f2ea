"""Streaming (R8, R10), compaction (R11) and file-format round trips.

These queries write to the cluster's shared folder (``spark.checkpoint.dir``) and
return what was written, read back: the result is compared with the batch
equivalent over the same input tables.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from baobab.operators.text import word_counts
from baobab.plans import model as M
from baobab.plans.audits import LATE_EVENTS
from baobab.plans.base import query, wh
from baobab.plans.funnel import _WORDS, steps_sql
from baobab.plans.oracle_model import with_views as V
from baobab.session import scratch_path
from baobab.sources import compare, files, quarantine
from baobab.streaming import events as S
from baobab.streaming import late as L
from baobab.streaming import lateness as D


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, name)


def _delay(spark, sf_dir: str, table: str, batch, ts: str) -> str:
    """Watermark delay that covers every row of a feed derived from ``table``."""
    files = D.arrivals(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")
    return D.delay_bound(D.delay_histogram(batch, ts, files))


@query("stream_dedup", V("""
SELECT payment_id, order_id, customer_id, montant_fcfa, methode, statut,
       strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS paid_at
FROM (SELECT DISTINCT * FROM payments_raw)""", "payments_raw"))
def stream_dedup_q(spark, sf_dir):
    """Payments feed as a stream, duplicates dropped within the measured lateness."""
    sw = S.StreamWarehouse(spark, sf_dir)
    late = _delay(spark, sf_dir, "orders", M.payments_raw(wh(spark, sf_dir)), "paid_at")
    dedup = S.dedup_within_watermark(M.payments_raw(sw), "payment_id", "paid_at", late)
    out = S.run_to_table(spark, dedup, "stream_dedup")
    return out.withColumn("paid_at", F.date_format(S.instant_to_ntz(F.col("paid_at")), "yyyy-MM-dd HH:mm:ss"))


@query("stream_window_counts", V("""
SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS debut, event_type, COUNT(*) AS n
FROM events_nav GROUP BY 1, 2""", "events_nav"))
def stream_window_counts_q(spark, sf_dir):
    """Hourly event counts per type from the event stream (watermark of the
    measured lateness, update mode; final state per window)."""
    sw = S.StreamWarehouse(spark, sf_dir)
    late = _delay(spark, sf_dir, "events", M.events_nav(wh(spark, sf_dir)), "event_time")
    counts = S.windowed_counts(M.events_nav(sw), "event_time", "event_type", "1 hour", late)
    out = S.run_upserts(spark, counts, ["fenetre", "event_type"], "stream_window_counts")
    return out.select(F.date_format(S.instant_to_ntz(F.col("fenetre.start")), "yyyy-MM-dd HH:mm:ss")
                      .alias("debut"), "event_type", "n")


@query("compact_events", V("SELECT * FROM events"))
def compact_events_q(spark, sf_dir):
    """The events table rewritten as files of about 128 MB, without a shuffle."""
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    return S.compact(spark, spark.read.parquet(src), S.input_bytes(spark, src),
                     _scratch(spark, "compact_events"))


def _orders_csv(spark, sf_dir: str, name: str) -> tuple[str, StructType]:
    """The orders export written as headed CSV (path, schema)."""
    o = M.orders_raw(wh(spark, sf_dir)).withColumn(
        "date_commande", F.date_format("date_commande", "yyyy-MM-dd HH:mm:ss"))
    path = _scratch(spark, name)
    files.write_csv(o, path)
    return path, StructType(o.schema.fields)


_ORDERS_CSV = """
SELECT * REPLACE (strftime(date_commande, '%Y-%m-%d %H:%M:%S') AS date_commande) FROM orders_raw"""


@query("csv_roundtrip", V(_ORDERS_CSV, "orders_raw"))
def csv_roundtrip_q(spark, sf_dir):
    """S3: CSV read back with an explicit, header-checked schema."""
    path, schema = _orders_csv(spark, sf_dir, "orders_csv")
    return files.read_csv(spark, path, schema)


@query("csv_inferred", V(_ORDERS_CSV, "orders_raw"))
def csv_inferred_q(spark, sf_dir):
    """CSV read back with inferred types (numbers and the order time among them),
    the inferred widths then brought to those of the export."""
    path, schema = _orders_csv(spark, sf_dir, "orders_csv_inferred")
    back = files.read_csv(spark, path, infer=True)
    when = F.date_format("date_commande", "yyyy-MM-dd HH:mm:ss").alias("date_commande")
    return back.select(*[when if f.name == "date_commande" else F.col(f.name).cast(f.dataType) for f in schema])


@query("csv_strings", V(f"SELECT COLUMNS(*)::VARCHAR FROM ({_ORDERS_CSV})", "orders_raw"))
def csv_strings_q(spark, sf_dir):
    """CSV read back without a schema, every column a string."""
    path, _ = _orders_csv(spark, sf_dir, "orders_csv_strings")
    return files.read_csv(spark, path)


@query("jsonl_roundtrip", V("""
SELECT payment_id, order_id, customer_id, montant_fcfa, methode, statut,
       strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS paid_at FROM payments_raw""", "payments_raw"))
def jsonl_roundtrip_q(spark, sf_dir):
    """The payments feed as JSON Lines, read back with its schema."""
    p = M.payments_raw(wh(spark, sf_dir)).withColumn("paid_at", F.date_format("paid_at", "yyyy-MM-dd HH:mm:ss"))
    path = _scratch(spark, "payments_jsonl")
    files.write_jsonl(p, path)
    return files.read_jsonl(spark, path, p.schema)


@query("text_word_count", V(_WORDS))
def text_word_count_q(spark, sf_dir):
    """S5 + A3: documents written as plain text lines, read back with the text
    source (column ``value``), then counted."""
    path = _scratch(spark, "documents_txt")
    M.documents_text(wh(spark, sf_dir)).select("value").write.mode("overwrite").text(path)
    return word_counts(files.read_text(spark, path))


def _rejects(found: quarantine.Quarantine) -> DataFrame:
    """(raison, n) of a quarantine, good rows as ``ok``."""
    ok = found.good.agg(F.lit("ok").alias("raison"), F.count(F.lit(1)).alias("n"))
    return ok.unionByName(found.rejected.groupBy(F.col("reason").alias("raison")).agg(F.count(F.lit(1)).alias("n")))


@query("csv_quarantine", V("""
SELECT CASE WHEN payment_id % 40 = 3 THEN 'fields' WHEN payment_id % 40 = 9 THEN 'type of montant_fcfa' ELSE 'ok' END AS raison, COUNT(*) AS n
FROM payments_raw GROUP BY 1""", "payments_raw"))
def csv_quarantine_q(spark, sf_dir):
    """S3: a CSV feed with a field too many in some rows and a text for an amount in
    others: good rows, and rejected ones by reason."""
    p = M.payments_raw(wh(spark, sf_dir)).select("payment_id", "order_id", "montant_fcfa", "methode")
    k = F.col("payment_id") % 40
    sent = p.withColumns({"montant_fcfa": F.when(k == 9, "abc").otherwise(F.col("montant_fcfa").cast("string")),
                          "methode": F.when(k == 3, F.concat("methode", F.lit(",x"))).otherwise(F.col("methode"))})
    path = _scratch(spark, "payments_csv")
    sent.write.option("header", True).option("quote", "\u0000").csv(path)
    return _rejects(quarantine.read_csv(spark, path, p.schema))


@query("jsonl_quarantine", V("""
SELECT CASE WHEN payment_id % 40 = 3 THEN 'json' WHEN payment_id % 40 = 9 THEN 'type of montant_fcfa' ELSE 'ok' END AS raison, COUNT(*) AS n
FROM payments_raw GROUP BY 1""", "payments_raw"))
def jsonl_quarantine_q(spark, sf_dir):
    """A JSON Lines feed with broken lines and texts for amounts."""
    p = M.payments_raw(wh(spark, sf_dir)).select("payment_id", "order_id", "montant_fcfa", "methode")
    k, line = F.col("payment_id") % 40, F.to_json(F.struct("*"))
    sent = p.select(F.when(k == 3, F.left(line, F.lit(25))).when(k == 9, F.regexp_replace(line, r'"montant_fcfa":-?\d+', '"montant_fcfa":"abc"'))
                    .otherwise(line).alias("value"))
    path = _scratch(spark, "payments_json")
    sent.write.text(path)
    return _rejects(quarantine.read_jsonl(spark, path, p.schema))


@query("export_comparison", V("""
SELECT payment_id, CASE WHEN payment_id % 500 = 1 THEN 0 ELSE n END AS nb_export, n AS nb_source
FROM (SELECT payment_id, COUNT(*) AS n FROM payments_raw GROUP BY payment_id) WHERE payment_id % 500 = 1""", "payments_raw"))
def export_comparison_q(spark, sf_dir):
    """An export read back that lost some payments, told by checksums per bucket."""
    p = M.payments_raw(wh(spark, sf_dir)).withColumn("paid_at", F.date_format("paid_at", "yyyy-MM-dd HH:mm:ss"))
    path = _scratch(spark, "payments_export")
    p.where(F.col("payment_id") % 500 != 1).write.parquet(path)
    found = compare.differences(spark.read.parquet(path), p)
    return found.select("payment_id", F.col("in_a").alias("nb_export"), F.col("in_b").alias("nb_source"))


_HOURLY = "(SELECT *, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS debut FROM events_nav)"


@query("stream_window_funnel", V(steps_sql(_HOURLY, "debut"), "events_nav"))
def stream_window_funnel_q(spark, sf_dir):
    """Hourly funnel (distinct sessions per step) from the event stream:
    per-(window, session) step flags kept as stream state, summed per window."""
    from baobab.operators.funnel import STEPS
    sw = S.StreamWarehouse(spark, sf_dir)
    flags = S.windowed_session_flags(M.events_nav(sw), "event_time", "session_id", "event_type",
                                     STEPS, "1 hour", _delay(spark, sf_dir, "events", M.events_nav(wh(spark, sf_dir)), "event_time"))
    state = S.run_upserts(spark, flags, ["fenetre", "session_id"], "stream_window_funnel")
    sums = [F.sum(name).cast("bigint").alias(name) for _, name in STEPS]
    start = F.date_format(S.instant_to_ntz(F.col("fenetre.start")), "yyyy-MM-dd HH:mm:ss")
    return (state.groupBy(start.alias("debut"))
                 .agg(F.count(F.lit(1)).alias("sessions"), *sums))


def _late_columns(late, *more):
    """The columns of ``late_events`` from (event_id, event_us, behind_us)."""
    return late.select("event_id", *more, F.date_format(S.instant_to_ntz(F.timestamp_micros("event_us")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
                       (F.floor((F.col("event_us") + F.col("behind_us")) / 1_000_000) - F.floor(F.col("event_us") / 1_000_000)).alias("retard_s"))


@query("stream_late_events", LATE_EVENTS)
def stream_late_events_q(spark, sf_dir):
    """R9 as a stream: events behind the latest event time already received, to a side
    output with their delay."""
    events = M.events_arrivals(S.StreamWarehouse(spark, sf_dir))
    return _late_columns(L.run_late_events(spark, L.micros(events, "event_id", "event_time")))


@query("stream_late_events_by_user", V("""
SELECT event_id, user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
       CAST(date_diff('second', event_time, max_avant) AS BIGINT) AS retard_s
FROM (SELECT *, max(event_time) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS max_avant FROM events_arrivals)
WHERE event_time < max_avant""", "events_arrivals"))
def stream_late_events_by_user_q(spark, sf_dir):
    """R9 per user, the running maximum as keyed state."""
    events = M.events_arrivals(S.StreamWarehouse(spark, sf_dir))
    late = L.late_by_key(L.micros(events, "event_id", "event_time", "user_id"), "user_id")
    return _late_columns(S.run_to_table(spark, late, "late_by_user").withColumnRenamed("key", "user_id"), "user_id")
