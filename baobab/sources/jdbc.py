"""JDBC sources and sinks (federation).

Credentials come from the caller (options or environment), never from source code.
A single-connection read is one partition; pass ``partition_column`` with bounds to
split the read into ``num_partitions`` parallel range queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _opts(url: str, driver: str | None, user: str | None, password: str | None) -> dict:
    o = {"url": url}
    if driver:
        o["driver"] = driver
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    return o


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a whole table; filters and projections applied later are pushed down."""
    reader = spark.read.format("jdbc").options(**_opts(url, driver, user, password))
    reader = reader.option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
) -> DataFrame:
    """Push a whole query to the database (manual pushdown)."""
    return (spark.read.format("jdbc").options(**_opts(url, driver, user, password))
            .option("query", query).load())


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    truncate: bool = True,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    column_types: str | None = None,
) -> None:
    """Write a frame; ``truncate`` keeps the table definition and grants on overwrite.

    ``num_partitions`` caps concurrent connections to the database;
    ``column_types`` (e.g. ``"id VARCHAR(4), nom VARCHAR(50)"``) sets the database
    types used when the table is created (strings otherwise become CLOB/TEXT on
    some databases, where pushed-down comparisons are not allowed).
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").options(**_opts(url, driver, user, password))
         .option("dbtable", table).option("truncate", truncate).option("batchsize", batch_size))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.mode(mode).save()


def verify_roundtrip(written: DataFrame, read_back: DataFrame) -> DataFrame:
    """One-row report comparing what was written with what the database returns.

    Both sides are compared as multisets in a single shuffle: rows are tagged by
    side, grouped on all columns, and per-group count differences are summed, so
    lost and duplicated rows are both counted.
    """
    from pyspark.sql import functions as F

    cols = written.columns
    tagged = (written.select(*cols, F.lit(1).alias("_w"), F.lit(0).alias("_r"))
              .unionByName(read_back.select(*cols, F.lit(0).alias("_w"), F.lit(1).alias("_r"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("_w").alias("w"), F.sum("_r").alias("r"))
    return per_row.agg(
        F.sum("w").alias("written"),
        F.sum("r").alias("read_back"),
        F.sum(F.greatest(F.col("w") - F.col("r"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("r") - F.col("w"), F.lit(0))).alias("extra"),
    )
