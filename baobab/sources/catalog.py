"""Session catalog helpers: views, listing, schema and partition introspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(views: dict[str, DataFrame]) -> None:
    """Register each frame as a temporary view under its key."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """Catalog listing as a frame (``SHOW TABLES``)."""
    return spark.sql("SHOW TABLES")


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column: name, simple type string, nullability."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per input partition, computed on the executors."""
    return (df.groupBy(F.spark_partition_id().alias("partition"))
              .agg(F.count(F.lit(1)).alias("rows")))
