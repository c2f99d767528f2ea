"""File sources, catalog helpers and streaming runners."""

import os
import tempfile

from pyspark.sql import functions as F

from baobab.sources import catalog, files
from baobab.streaming import events as S
from conftest import SF_SMALL


def test_csv_three_schema_modes(spark, tmp_path):
    p = tmp_path / "o.csv"
    p.write_text("order_id,montant_total_fcfa,frais\n1,12500,1000\n2,7000 FCFA,500\n")
    inferred = files.read_csv(spark, str(p), infer=True)
    assert dict(inferred.dtypes) == {"order_id": "int", "montant_total_fcfa": "string", "frais": "int"}
    strings = files.read_csv(spark, str(p))
    assert {t for _, t in strings.dtypes} == {"string"}
    explicit = files.read_csv(spark, str(p), inferred.schema)
    assert explicit.count() == 2


def test_jsonl_and_text(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text('{"payment_id": 1, "statut": "OK"}\n{"payment_id": 2, "statut": "ECHEC"}\n')
    assert files.read_jsonl(spark, str(p)).count() == 2
    t = tmp_path / "d.txt"
    t.write_text("une ligne\ndeux lignes\n")
    assert files.read_text(spark, str(t)).columns == ["value"]


def test_catalog_helpers(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    catalog.register({"vue_test": df})
    names = [r.tableName for r in catalog.list_tables(spark).collect()]
    assert "vue_test" in names
    sch = {r.column: r.type for r in catalog.schema_frame(spark, df).collect()}
    assert sch == {"k": "int", "v": "string"}
    sizes = catalog.partition_sizes(spark.range(100).repartition(4))
    assert sizes.agg(F.sum("rows")).collect()[0][0] == 100


def test_stream_dedup_across_micro_batches(spark):
    # three files read one per trigger: duplicates that land in later batches are dropped too
    src = tempfile.mkdtemp(prefix="baobab-src-")
    rows = [(i % 40, f"2024-01-01 00:{i % 60:02d}:00") for i in range(120)]
    for part in range(3):
        spark.createDataFrame(rows[part * 40:(part + 1) * 40], "payment_id long, paid_at string") \
            .withColumn("paid_at", F.to_timestamp("paid_at")).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(src, f"f{part}"))
    schema = spark.read.parquet(os.path.join(src, "f0")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    out = S.run_to_table(spark, S.dedup_within_watermark(stream, "payment_id", "paid_at", "1 day"), "t")
    assert out.count() == 40 and out.select("payment_id").distinct().count() == 40


def test_stream_upserts_keep_final_counts(spark):
    src = tempfile.mkdtemp(prefix="baobab-src-")
    for part in range(3):
        spark.createDataFrame([("a", "2024-01-01 10:05:00"), ("b", "2024-01-01 10:10:00")],
                              "t string, ts string").withColumn("ts", F.to_timestamp("ts")) \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"f{part}"))
    schema = spark.read.parquet(os.path.join(src, "f0")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    counts = S.windowed_counts(stream, "ts", "t", "1 hour", "1 day")
    out = S.run_upserts(spark, counts, ["fenetre", "t"], "w")
    assert sorted((r.t, r.n) for r in out.collect()) == [("a", 3), ("b", 3)]


def test_compaction_keeps_rows(spark):
    src = f"{SF_SMALL}/events.parquet"
    dest = tempfile.mkdtemp(prefix="baobab-compact-") + "/events"
    out = S.compact(spark, spark.read.parquet(src), S.input_bytes(spark, src), dest, target_file_bytes=10_000)
    assert out.count() == spark.read.parquet(src).count()
    assert out.rdd.getNumPartitions() >= 2


def test_staged_intermediates_give_same_results(spark):
    import __spark_entry__ as E
    from baobab.plans import base
    q = E.queries()
    plain = {n: sorted(map(tuple, q[n](spark, SF_SMALL).collect())) for n in ("revenue_by_region", "join_audit")}
    stage = tempfile.mkdtemp(prefix="baobab-stage-")
    base.stage_intermediates(SF_SMALL, stage)
    try:
        for n, rows in plain.items():
            assert sorted(map(tuple, q[n](spark, SF_SMALL).collect())) == rows
        assert sorted(os.listdir(stage)) == ["customers_clean", "orders_clean"]
    finally:
        base._STAGING.pop(SF_SMALL, None)


def test_job_runner_writes_results(spark):
    from baobab import job
    from baobab.plans import base
    out = tempfile.mkdtemp(prefix="baobab-job-")
    try:
        job.main(["--input", SF_SMALL, "--output", out, "--query", "funnel", "--query", "join_audit",
                  "--stage"])
    finally:
        base._STAGING.pop(SF_SMALL, None)
    assert spark.read.parquet(f"{out}/funnel").count() == 1
    assert spark.read.parquet(f"{out}/join_audit").count() == 1
    assert os.path.isdir(f"{out}/_stage/orders_clean")


def test_streaming_windows_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as E
    q = E.queries()["stream_window_counts"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = {}
        for tz in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = sorted(map(tuple, q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got["UTC"] == got["Asia/Kolkata"]


def test_bucketed_lines_and_orders_join_without_shuffle(spark):
    from baobab.plans import model as M
    w = M.Warehouse(spark, SF_SMALL)
    files.write_bucketed(M.order_items(w), "lignes_b", ["order_id"], 8)
    files.write_bucketed(M.orders_raw(w).select("order_id", "customer_id", "statut"), "commandes_b",
                         ["order_id"], 8)
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        j = spark.table("lignes_b").join(spark.table("commandes_b"), "order_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == M.order_items(w).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
