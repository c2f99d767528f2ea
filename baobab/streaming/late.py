"""Late events as a stream (R9): rows behind the latest event time already received go to
a side output with their delay, each exactly once.

* :func:`run_late_events`: one running maximum over the whole feed. Inside a
  micro-batch it is the batch operator (windows over bounded blocks of arrivals, so no
  task holds the feed); from one micro-batch to the next the maximum so far is a row in
  the shared folder, written under the number of its batch. A replayed batch starts from
  the same row and overwrites its own output.
* :class:`RunningMax`: a running maximum per key as keyed state (``transformWithState``
  over RocksDB), for feeds whose clocks differ by user or device.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from baobab.operators.windows import behind_running_max
from baobab.session import scratch_path
from baobab.streaming.events import _finish

LATE = "event_id long, event_us long, behind_us long"


def micros(stream: DataFrame, arrival: str, ts: str, *more: str) -> DataFrame:
    """(event_id, event_us, further columns): arrival number and event time in microseconds,
    wall-clock times read as UTC. Rows without either are left out: they are never late."""
    us = F.unix_micros(F.col(ts)) if dict(stream.dtypes)[ts] != "timestamp_ntz" else F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    return (stream.select(F.col(arrival).cast("bigint").alias("event_id"), us.alias("event_us"), *more)
            .where(F.col("event_id").isNotNull() & F.col("event_us").isNotNull()))


def run_late_events(spark: SparkSession, events: DataFrame, name: str = "late_events", folder: str | None = None,
                    timeout_s: int | None = None) -> DataFrame:
    """Run a stream of (event_id, event_us) over the input available now and return the
    late rows (event_id, event_us, behind_us).

    Rows arrive in the order of micro-batches, and in that of ``event_id`` inside one.
    With ``folder`` named, a run continues where the last one over it ended or broke off.
    """
    base = folder or scratch_path(spark, name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # One row a batch; batches without rows repeat the last one, so the row before is always there.
        top = session.read.schema("top long").parquet(f"{base}/top/b={batch_id - 1}").first()["top"] if batch_id else None
        carried = F.lit(top).cast("bigint")
        before = F.greatest(F.col("max_avant"), carried)
        late = (behind_running_max(batch, "event_id", "event_us").select("event_id", "event_us", (before - F.col("event_us")).alias("behind_us"))
                .where("behind_us > 0"))
        late.write.mode("overwrite").parquet(f"{base}/late/b={batch_id}")
        batch.agg(F.greatest(F.max("event_us"), carried).alias("top")).write.mode("overwrite").parquet(f"{base}/top/b={batch_id}")

    _finish(spark, events.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/_checkpoint"), timeout_s)
    return spark.read.schema(LATE).parquet(f"{base}/late").select("event_id", "event_us", "behind_us")


class RunningMax(StatefulProcessor):
    """Late rows of each key against the key's greatest event time so far.

    State: one long per key. The rows of a key inside a micro-batch are put in order of
    arrival as two longs each, so a task holds at most what a trigger admits
    (``max_files_per_trigger``); feeds with a key of a third of all rows are better
    served by :func:`run_late_events`, which spreads one running maximum over tasks.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._top = handle.getValueState("top", "top long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([r[["event_id", "event_us"]] for r in rows]).sort_values("event_id", kind="stable")
        before = batch["event_us"].cummax().shift(1)
        if self._top.exists():
            top = self._top.get()[0]
            before = before.fillna(top).clip(lower=top)
            self._top.update((max(top, int(batch["event_us"].max())),))
        else:
            self._top.update((int(batch["event_us"].max()),))
        behind = before - batch["event_us"]
        late = batch.assign(behind_us=behind)[behind > 0]
        if len(late):
            yield late.assign(key=key[0]).astype({"behind_us": "int64"})[["key", "event_id", "event_us", "behind_us"]]

    def close(self) -> None:
        pass


def late_by_key(events: DataFrame, key: str) -> DataFrame:
    """Late rows (key, event_id, event_us, behind_us) of a stream of (event_id, event_us, ``key``)."""
    kind = dict(events.dtypes)[key]
    return events.groupBy(key).transformWithStateInPandas(statefulProcessor=RunningMax(), outputStructType=f"key {kind}, {LATE}",
                                                          outputMode="Append", timeMode="None")
