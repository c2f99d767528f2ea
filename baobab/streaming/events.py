"""Structured Streaming counterparts of the batch audits.

* :func:`dedup_within_watermark` — at-least-once duplicates removed with state
  bounded by the watermark (R8).
* :func:`windowed_counts` — tumbling-window counts per type with a watermark (R10).
* :func:`run_to_table` / :func:`run_upserts` — run a stream to completion
  (``availableNow``) into files under the shared checkpoint folder, so a lost
  executor or a restarted driver resumes from the checkpoint instead of
  recomputing or double-writing.
* :func:`compact` — rewrite a directory of many small files as files of a target
  size (R11).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import TimestampNTZType

from baobab.operators.windows import latest_per_key
from baobab.session import scratch_path


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


class StreamWarehouse:
    """Streaming view of the input tables, a file or a folder each: read as a file
    stream with the schema of its batch counterpart (no inference)."""

    def __init__(self, spark: SparkSession, root: str, max_files_per_trigger: int | None = None):
        self.spark, self.root, self.max_files = spark, root.rstrip("/"), max_files_per_trigger

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}.parquet"
        r = self.spark.readStream.schema(self.spark.read.parquet(path).schema)
        if self.max_files:
            r = r.option("maxFilesPerTrigger", self.max_files)
        if _is_folder(self.spark, path):
            return r.parquet(path)
        return r.option("pathGlobFilter", f"{name}.parquet").parquet(self.root)


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(c: Column) -> Column:
    """A wall-clock (NTZ) timestamp read as UTC, whatever the session time zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def instant_to_ntz(c: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks and windows need a zoned timestamp. Wall-clock (NTZ) event times
    are read as UTC, so tumbling windows fall on the data's own hour boundaries in
    any session time zone; zoned event times are kept."""
    if isinstance(stream.schema[ts].dataType, TimestampNTZType):
        return stream.withColumn(ts, ntz_to_instant(F.col(ts)))
    return stream


def dedup_within_watermark(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop repeated ``key`` values arriving within ``delay`` of each other."""
    return _event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, group: str, size: str, delay: str) -> DataFrame:
    """Events per tumbling window and ``group``; rows later than the watermark
    are dropped by Spark (the result equals the batch count only when no event is
    later than ``delay``)."""
    return (_event_time(stream, ts).withWatermark(ts, delay)
                  .groupBy(F.window(ts, size).alias("fenetre"), group)
                  .agg(F.count(F.lit(1)).alias("n")))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class StreamReport:
    """What a finished run says of itself: rows that came later than the watermark allows
    (after partial aggregation, for aggregating streams), state rows left at the end, the
    most there were, and micro-batches."""

    late_rows: int = 0
    state_rows: int = 0
    most_state_rows: int = 0
    batches: int = 0


class LateRows(RuntimeError):
    """A stream dropped rows that came later than its watermark allows."""


_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.numRecentProgressUpdates": "100000"}


def _finish(spark: SparkSession, writer: DataStreamWriter, timeout_s: int | None) -> StreamReport:
    """Run a stream over all input available now. Without a limit it ends when the input
    does; with one, a stream that needs longer is stopped and raises. State is kept on
    the executors' disks (RocksDB), not in their heaps."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        q = writer.trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not end within {timeout_s} s")
    if q.exception() is not None:
        raise q.exception()
    progress = q.recentProgress
    states = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return StreamReport(late, states[-1] if states else 0, max(states, default=0), len(progress))


def _check(report: StreamReport, into: StreamReport | None) -> None:
    """Rows beyond the watermark are an error, or are told to a caller who asked for the report."""
    if into is not None:
        into.__dict__.update(report.__dict__)
    elif report.late_rows:
        raise LateRows(f"{report.late_rows} rows came later than the watermark allows and are not in the result")


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, timeout_s: int | None = None,
                 report: StreamReport | None = None) -> DataFrame:
    """Append a stream to parquet files until the input available now is consumed;
    return the written table as a batch frame. Rows beyond the watermark raise
    :class:`LateRows`, or are counted in ``report`` where one is given."""
    base = scratch_path(spark, name)
    _check(_finish(spark, stream.writeStream.format("parquet").outputMode("append")
                   .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/data"), timeout_s), report)
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def run_upserts(spark: SparkSession, stream: DataFrame, keys: list[str], name: str,
                timeout_s: int | None = None, report: StreamReport | None = None) -> DataFrame:
    """Run an aggregating stream in update mode; each micro-batch is written to its
    own folder (idempotent on batch replay); the current state of every key is its
    row from the latest batch. Rows beyond the watermark: as in :func:`run_to_table`."""
    base = scratch_path(spark, name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite") \
             .parquet(f"{base}/data/b={batch_id}")

    _check(_finish(spark, stream.writeStream.outputMode("update").foreachBatch(sink)
                   .option("checkpointLocation", f"{base}/_checkpoint"), timeout_s), report)
    out = spark.read.parquet(f"{base}/data")
    return latest_per_key(out.drop("b"), keys, ["_batch"]).drop("_batch")


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def compact(spark: SparkSession, src: DataFrame, src_bytes: int, dest: str,
            target_file_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Rewrite ``src`` as ceil(bytes / target) files and return the new table.

    Many small splits (the case that compaction is for) are gathered into as many tasks
    without a shuffle. Only an input of fewer splits than files, too coarse to be cut
    by the scan, is dealt out anew.
    """
    n = max(1, -(-src_bytes // target_file_bytes))
    out = src.coalesce(n) if src.rdd.getNumPartitions() >= n else src.repartition(n)
    out.write.mode("overwrite").parquet(dest)
    return spark.read.parquet(dest)


def windowed_session_flags(stream: DataFrame, ts: str, session: str, etype: str,
                           steps: list[tuple[str, str]], size: str, delay: str) -> DataFrame:
    """R10 (funnel): per tumbling window and session, a 0/1 flag per funnel step.

    Streaming aggregation has no ``COUNT(DISTINCT)``; keeping one state row per
    (window, session) and summing the flags per window afterwards gives the exact
    distinct-session counts per step."""
    flags = [F.max(F.when(F.col(etype) == t, F.lit(1)).otherwise(F.lit(0))).alias(name)
             for t, name in steps]
    return (_event_time(stream, ts).where(F.col(session).isNotNull()).withWatermark(ts, delay)
                  .groupBy(F.window(ts, size).alias("fenetre"), session).agg(*flags))
