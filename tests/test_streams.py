"""Streams over folders, one file per micro-batch: the results of the batch queries."""

import pytest
from pyspark.sql import functions as F

from baobab.plans import model as M
from baobab.plans.base import wh
from baobab.streaming import events as S
from baobab.streaming import late as L
from baobab.streaming import lateness as D
from conftest import SF_SMALL


def delay(spark, folder, table, batch, ts):
    return D.delay_bound(D.delay_histogram(batch, ts, D.arrivals(spark, f"{folder}/{table}.parquet")))


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("folders"))
    for name in ("orders", "events"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(4).write.parquet(f"{root}/{name}.parquet")
    return root


def test_dedup_over_several_batches_equals_batch(spark, folders):
    sw = S.StreamWarehouse(spark, folders, max_files_per_trigger=1)
    batch = M.payments_raw(wh(spark, folders))
    late = delay(spark, folders, "orders", batch, "paid_at")
    out = S.run_to_table(spark, S.dedup_within_watermark(M.payments_raw(sw), "payment_id", "paid_at", late), "t_dedup")
    assert out.count() == batch.distinct().count() > 0


def test_windowed_counts_over_several_batches_equal_batch(spark, folders):
    sw = S.StreamWarehouse(spark, folders, max_files_per_trigger=1)
    batch = M.events_nav(wh(spark, folders))
    counts = S.windowed_counts(M.events_nav(sw), "event_time", "event_type", "1 hour", delay(spark, folders, "events", batch, "event_time"))
    out = S.run_upserts(spark, counts, ["fenetre", "event_type"], "t_counts")
    assert out.agg(F.sum("n")).first()[0] == batch.count()
    want = batch.groupBy(F.date_trunc("hour", "event_time").alias("h"), "event_type").count().count()
    assert out.count() == want


def test_an_expired_limit_raises(spark, folders):
    sw = S.StreamWarehouse(spark, folders, max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        S.run_to_table(spark, M.payments_raw(sw), "t_limit", timeout_s=0.001)


def test_compaction_does_not_shuffle(spark, folders, tmp_path):
    src = spark.read.parquet(f"{folders}/events.parquet")
    out = S.compact(spark, src, S.input_bytes(spark, f"{folders}/events.parquet"), str(tmp_path / "c"))
    assert out.count() == src.count()
    assert "Exchange" not in src.coalesce(1)._jdf.queryExecution().executedPlan().toString()


def test_customers_without_orders_exist(spark):
    from baobab.plans import QUERIES
    assert QUERIES["customers_without_order"](spark, SF_SMALL).count() > 0
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert M.customers_raw(wh(spark, SF_SMALL)).select("customer_id").distinct().count() == customers


def test_shared_folder_is_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from baobab.session import shared_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        shared_dir(cluster)


# ------------------------------------------------------------------ bounded state
def in_files(spark, frame, order, root, table, files):
    """``frame`` in ``files`` files, written one after another in order of ``order``."""
    bounds = frame.approxQuantile(order, [k / files for k in range(1, files)], 0.0) if files > 1 else []
    for k in range(files):
        part = frame
        if k:
            part = part.where(F.col(order) > bounds[k - 1])
        if k < len(bounds):
            part = part.where(F.col(order) <= bounds[k])
        part.coalesce(1).write.mode("append").parquet(f"{root}/{table}.parquet")


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    """Orders in files by time, but for one that comes a file late; events in files by number."""
    root = str(tmp_path_factory.mktemp("ordered"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("t", F.unix_date(F.to_date("o_orderdate")).cast("double"))
    in_files(spark, orders, "t", root, "orders", 6)
    in_files(spark, spark.read.parquet(f"{SF_SMALL}/events.parquet"), "event_id", root, "events", 5)
    return root


def test_state_is_bounded_by_the_disorder_of_the_feed(spark, ordered):
    sw = S.StreamWarehouse(spark, ordered, max_files_per_trigger=1)
    batch = M.payments_raw(wh(spark, ordered))
    late = delay(spark, ordered, "orders", batch, "paid_at")
    assert int(late.split()[0]) < 86_400 * 30  # the feed spans years
    report = S.StreamReport()
    out = S.run_to_table(spark, S.dedup_within_watermark(M.payments_raw(sw), "payment_id", "paid_at", late), "t_bounded", report=report)
    keys = batch.select("payment_id").distinct().count()
    assert out.count() == keys and report.late_rows == 0 and report.batches >= 6
    assert report.state_rows < keys / 20 and report.most_state_rows < keys / 2


def test_windows_are_evicted_too(spark, ordered):
    sw = S.StreamWarehouse(spark, ordered, max_files_per_trigger=1)
    batch = M.events_nav(wh(spark, ordered))
    report = S.StreamReport()
    counts = S.windowed_counts(M.events_nav(sw), "event_time", "event_type", "1 hour", delay(spark, ordered, "events", batch, "event_time"))
    out = S.run_upserts(spark, counts, ["fenetre", "event_type"], "t_evicted", report=report)
    assert out.agg(F.sum("n")).first()[0] == batch.count() and report.late_rows == 0
    assert report.state_rows < out.count() / 4


def test_a_row_beyond_the_bound_is_told(spark, tmp_path):
    rows = [[(1, "2024-05-02 10:00:00")], [(2, "2024-05-02 12:00:00")], [(3, "2024-05-02 08:00:00"), (4, "2024-05-02 12:30:00")]]
    for part in rows:
        frame = spark.createDataFrame(part, "id long, t string").select("id", F.col("t").cast("timestamp").alias("t"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "feed.parquet"))
    files = D.arrivals(spark, str(tmp_path / "feed.parquet"))
    batch = spark.read.parquet(str(tmp_path / "feed.parquet"))
    histogram = D.delay_histogram(batch, "t", files)
    assert {r["bucket"]: r["rows"] for r in histogram.collect()} == {0: 3, 14: 1}  # 4 hours are under 2^14 s
    assert D.delay_bound(histogram) == "16384 seconds" and D.delay_bound(histogram, 0.75) == "1 seconds"
    assert {r["bucket"]: r["rows"] for r in D.merged(histogram, histogram).collect()} == {0: 6, 14: 2}

    def run(bound, report=None):
        stream = S.StreamWarehouse(spark, str(tmp_path), max_files_per_trigger=1)("feed")
        return S.run_to_table(spark, S.dedup_within_watermark(stream, "id", "t", bound), "t_told", report=report)

    assert run(D.delay_bound(histogram)).count() == 4
    with pytest.raises(S.LateRows, match="1 rows"):
        run("1 hour")
    report = S.StreamReport()
    assert run("1 hour", report).count() == 3 and report.late_rows == 1


# ------------------------------------------------------------------ late events
def expected_late(spark, folder, by=()):
    from baobab.operators.windows import behind_running_max
    e = M.events_arrivals(wh(spark, folder)).select("event_id", "event_time", *by)
    x = behind_running_max(e, "event_id", "event_time", by=list(by)).where("event_time < max_avant")
    us = [F.timestamp_diff("MICROSECOND", F.col("event_time"), F.col("max_avant")).cast("bigint")]
    return sorted((r[0], r[1]) for r in x.select("event_id", *us).collect())


def test_late_events_over_several_files(spark, ordered):
    sw = S.StreamWarehouse(spark, ordered, max_files_per_trigger=1)
    got = L.run_late_events(spark, L.micros(M.events_arrivals(sw), "event_id", "event_time"))
    assert sorted((r.event_id, r.behind_us) for r in got.collect()) == expected_late(spark, ordered) != []


def test_late_events_go_on_from_the_checkpoint(spark, ordered, tmp_path, monkeypatch):
    sw = S.StreamWarehouse(spark, ordered, max_files_per_trigger=1)
    events = L.micros(M.events_arrivals(sw), "event_id", "event_time")
    real, calls = L.behind_running_max, []

    def breaks(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("executor lost")
        return real(*args, **kw)

    monkeypatch.setattr(L, "behind_running_max", breaks)
    with pytest.raises(Exception):
        L.run_late_events(spark, events, folder=str(tmp_path / "late"))
    got = L.run_late_events(spark, events, folder=str(tmp_path / "late"))
    assert sorted((r.event_id, r.behind_us) for r in got.collect()) == expected_late(spark, ordered)
    assert len(calls) == 6  # the two batches before the break aren't run again
    again = L.run_late_events(spark, events, folder=str(tmp_path / "late"))
    assert again.count() == got.count() and len(calls) == 6


def test_late_events_by_key_over_several_files(spark, ordered):
    def events(w):
        late = F.when(F.col("event_id") % 7 == 0, F.lit(86_400_000_000)).otherwise(F.lit(0))
        return L.micros(M.events_arrivals(w), "event_id", "event_time", "device").withColumn("event_us", F.col("event_us") - late)

    sw = S.StreamWarehouse(spark, ordered, max_files_per_trigger=1)
    got = S.run_to_table(spark, L.late_by_key(events(sw), "device"), "t_by_key")
    top, want = {}, []
    for r in sorted(events(wh(spark, ordered)).collect(), key=lambda r: r.event_id):
        if top.get(r.device, r.event_us) > r.event_us:
            want.append((r.device, r.event_id, top[r.device] - r.event_us))
        top[r.device] = max(top.get(r.device, r.event_us), r.event_us)
    assert sorted((r.key, r.event_id, r.behind_us) for r in got.collect()) == sorted(want) != []
