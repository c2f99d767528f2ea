"""File sources and sinks: CSV (three schema modes), JSON Lines, text, Parquet.

CSV applies an explicit schema *by position*. A file with an extra column would
silently shift every later column, so :func:`read_csv` checks the header names
against the schema before reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SchemaMismatch(ValueError):
    """The file header does not list the schema's columns in order."""


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the header line (one small read, no inference)."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer: bool = False,
    sep: str = ",",
    check_header: bool = True,
) -> DataFrame:
    """Read a headed CSV.

    * ``schema`` given: explicit types; the header must match the schema names
      exactly (order included), else :class:`SchemaMismatch`. ``enforceSchema`` is
      off so Spark re-checks the header of every file it opens.
    * ``infer=True``: one extra pass to infer types (exploration only).
    * neither: every column as string.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        if check_header:
            found = csv_header(spark, path, sep)
            wanted = [f.name for f in schema.fields]
            if found != wanted:
                raise SchemaMismatch(f"header {found} != schema {wanted}")
        return reader.option("enforceSchema", False).schema(schema).csv(path)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON Lines; pass a schema at scale to avoid the inference pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                   sort: bool = True, mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed (and sorted) on ``keys``.

    Two tables bucketed on the join key with the same bucket count join without a
    shuffle (and, sorted, without a sort): e.g. order lines and orders on the order
    key, the one large-large join of the line-level queries.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
