"""CSV and JSON Lines rows that don't parse: kept, with the reason, beside the good ones.

A reader that drops or nulls bad rows hides them; one that fails at the first of them
stops the feed. Here every line is read into its typed columns and, where that fails, its
own text, in one pass. Good and rejected rows add up to the lines (:func:`reconciled`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from baobab.session import scratch_path
from baobab.sources.files import SchemaMismatch, csv_header

BAD = "_rejected_line"
FILE = "_file"


@dataclass
class Quarantine:
    """Rows of the schema, and (line, reason, file) of the rejected ones."""

    good: DataFrame
    rejected: DataFrame

    def reconciled(self) -> DataFrame:
        """One row: good, rejected, and rejected per reason as a map."""
        reasons = self.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
        total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
        told = reasons.agg(total.alias("rejected"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("reasons"))
        return told.select(self.good.agg(F.count(F.lit(1))).scalar().alias("good"), "rejected", "reasons")


def _split(spark: SparkSession, read: DataFrame, schema: StructType, reason: Column, name: str) -> Quarantine:
    # Written once: Spark may not ask a text source for the bad line alone, and the two
    # halves would parse every file twice.
    path = scratch_path(spark, name)
    read.withColumn("_reason", F.when(F.col(BAD).isNotNull(), reason)).write.parquet(path)
    rows = spark.read.parquet(path)
    names = [f"`{f.name}`" for f in schema.fields]
    return Quarantine(rows.where(F.col(BAD).isNull()).select(*names),
                      rows.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("line"), F.col("_reason").alias("reason"), F.col(FILE).alias("file")))


def _stamped(schema: StructType) -> StructType:
    if {BAD, FILE, "_reason"} & {f.name for f in schema.fields}:
        raise ValueError(f"{BAD}, {FILE} and _reason are this reader's own columns")
    return StructType([*schema.fields, StructField(BAD, StringType())])


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> Quarantine:
    """A headed CSV in ``schema``. Rejected: rows with too few or too many fields
    (``fields``), and rows with a field that isn't of its type (``type of <column>``, the
    first one). Empty fields are NULL; blank lines are no rows.
    """
    found, wanted = csv_header(spark, path, sep), [f.name for f in schema.fields]
    if found != wanted:
        raise SchemaMismatch(f"header {found} != schema {wanted}")
    read = (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
            .schema(_stamped(schema)).csv(path).withColumn(FILE, F.input_file_name()))
    # The reason is read off the line itself, parsed once more as plain strings.
    texts = F.from_csv(F.col(BAD), ", ".join(f"c{i} string" for i in range(len(wanted) + 1)), {"sep": sep})
    field = [F.col("_fields").getField(f"c{i}") for i in range(len(wanted) + 1)]
    wrong = [F.when(field[i].isNotNull() & F.expr(f"try_cast(_fields.c{i} AS {f.dataType.simpleString()})").isNull(), f"type of {f.name}")
             for i, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    n_fields = F.size(F.split(F.regexp_replace(F.col(BAD), r'"(?:[^"\\]|\\.|"")*"', "q"), f"\\Q{sep}\\E", -1))
    reason = F.when(n_fields != len(wanted), "fields").otherwise(F.coalesce(*wrong, F.lit("unreadable")))
    return _split(spark, read.withColumn("_fields", texts), schema, reason, "csv_quarantine")


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> Quarantine:
    """JSON Lines in ``schema``. Rejected: lines that are no JSON object (``json``) and
    objects with a value that isn't of its type (``type of <field>``, the first one).
    A missing field is NULL, an unknown one is passed over; blank lines are no rows.
    """
    read = (spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
            .schema(_stamped(schema)).json(path).withColumn(FILE, F.input_file_name()))
    # A value of a wrong type leaves its own field NULL; get_json_object shows that it's there.
    wrong = [F.when(F.col(f"`{f.name}`").isNull() & F.get_json_object(BAD, f"$['{f.name}']").isNotNull(), f"type of {f.name}")
             for f in schema.fields]
    whole = F.try_parse_json(F.col(BAD))
    reason = F.when(whole.isNull() | ~F.schema_of_variant(whole).startswith("OBJECT"), "json").otherwise(F.coalesce(*wrong, F.lit("unreadable")))
    return _split(spark, read, schema, reason, "json_quarantine")
