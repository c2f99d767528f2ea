"""How late a feed is in the order in which it arrives, and a watermark that follows from it.

A file stream takes files in order of their modification time, and the watermark moves
between micro-batches, never inside a file. So a row is late by as much as its event
time lies behind the greatest one of the files before its own. Those delays, counted
per power of two of a second, are a histogram: small, mergeable over days by adding, and
the bound of any share of the rows can be read from it. The state of a watermarked
operator is then as large as the feed is unordered, not as long as its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from baobab.operators.windows import behind_running_max
from baobab.streaming.events import ntz_to_instant


def _name(path: Column) -> Column:
    return F.url_decode(F.substring_index(path, "/", -1))


def arrivals(spark: SparkSession, path: str) -> DataFrame:
    """(file, arrived): the data files at ``path`` and their modification time in
    microseconds, listed without reading their content."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(_name(F.col("path")).alias("file"), F.unix_micros("modificationTime").alias("arrived"))


def delay_histogram(batch: DataFrame, ts: str, files: DataFrame) -> DataFrame:
    """(bucket, rows): rows of ``batch`` by their delay behind the files that arrived before
    theirs. Bucket 0 has the rows that are not behind, bucket b those behind by less than
    2^b seconds and not by less than half of that.

    ``batch`` is the batch counterpart of the stream over the same ``files`` (see
    :func:`arrivals`), with no shuffle below it. Files of one modification time may be
    taken in any order, so each counts as before the others. The running maximum is over
    one row per modification time.
    """
    t = F.col(ts)
    if isinstance(batch.schema[ts].dataType, TimestampNTZType):
        t = ntz_to_instant(t)
    rows = batch.select(_name(F.input_file_name()).alias("_file"), F.unix_micros(t).alias("_t")).where("_t is not null")
    tops = (rows.groupBy("_file").agg(F.max("_t").alias("_top")).join(files, F.col("_file") == F.col("file"))
            .groupBy("arrived").agg(F.max("_top").alias("_top"), F.count(F.lit(1)).alias("_together")))
    tops = behind_running_max(tops, "arrived", "_top", prev_col="_earlier")
    before = F.greatest(F.col("_earlier"), F.when(F.col("_together") > 1, F.col("_top")))
    seen = files.join(tops.select(F.col("arrived").alias("_arrived"), before.alias("_before")), F.col("arrived") == F.col("_arrived"))
    late = rows.join(seen.select("file", "_before"), F.col("_file") == F.col("file"))
    behind = F.greatest(F.coalesce(F.col("_before") - F.col("_t"), F.lit(0)), F.lit(0)) / 1_000_000
    bucket = F.when(behind == 0, 0).when(behind < 1, 1).otherwise(F.floor(F.log2(behind)) + 1).cast("int")
    return late.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def merged(*histograms: DataFrame) -> DataFrame:
    """Histograms of several days or feeds as one."""
    out = histograms[0]
    for h in histograms[1:]:
        out = out.unionByName(h)
    return out.groupBy("bucket").agg(F.sum("rows").alias("rows"))


def delay_bound(histogram: DataFrame, share: float = 1.0) -> str:
    """The smallest power of two of seconds that ``share`` of all rows are not later than,
    as a watermark delay (at least one second: a row at the watermark counts as late).
    A histogram has a row per power of two, some forty at most."""
    counts = sorted((r["bucket"], r["rows"]) for r in histogram.collect())
    total, so_far, bound = sum(n for _, n in counts), 0, 0
    for bucket, n in counts:
        if so_far >= share * total:
            break
        so_far, bound = so_far + n, bucket
    return f"{2 ** bound} seconds"
