"""Rows that don't parse, and tables compared by checksums."""

import pytest
from pyspark.sql import functions as F

from baobab.sources import compare, quarantine
from baobab.sources.files import SchemaMismatch

SCHEMA = "id int, amount decimal(8,2), day date, note string"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_csv_rows_are_good_or_rejected_with_a_reason(spark, tmp_path):
    lines = ["id,amount,day,note", "1,10.50,2024-01-31,fine", "2,abc,2024-01-31,x", "3,1.0", "4,1.0,2024-02-31,y", "5,2.0,2024-01-01,a,b",
             '6,3.0,2024-01-01,"quoted, with a comma"', "x,y,z,w", "7,,,", ""]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([lines[0], "8,1,2024-01-02,ok"]))
    found = quarantine.read_csv(spark, str(tmp_path), schema(spark))
    assert sorted((r.id, r.note) for r in found.good.collect()) == [(1, "fine"), (6, "quoted, with a comma"), (7, None), (8, "ok")]
    got = {r.line: r.reason for r in found.rejected.collect()}
    assert got == {lines[2]: "type of amount", lines[3]: "fields", lines[4]: "type of day", lines[5]: "fields", lines[7]: "type of id"}
    told = found.reconciled().first()
    assert told.good + told.rejected == 9 and told.reasons == {"fields": 2, "type of amount": 1, "type of day": 1, "type of id": 1}
    with pytest.raises(SchemaMismatch):
        quarantine.read_csv(spark, str(tmp_path), spark.createDataFrame([], "id int, other string").schema)


def test_json_lines_are_good_or_rejected_with_a_reason(spark, tmp_path):
    lines = ['{"id": 1, "amount": 2.5, "day": "2024-01-31", "note": "fine", "more": 1}', '{"id": 2', '{"id": "x"}', '[1, 2]', '{"amount": 1}',
             '{"id": 3, "day": "soon"}', 'null?', '{}']
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    found = quarantine.read_jsonl(spark, str(tmp_path), schema(spark))
    got = {r.line: r.reason for r in found.rejected.collect()}
    assert got == {lines[1]: "json", lines[2]: "type of id", lines[3]: "json", lines[5]: "type of day", lines[6]: "json"}
    assert sorted(str(r.id) for r in found.good.collect()) == ["1", "None", "None"]
    told = found.reconciled().first()
    assert told.good + told.rejected == len(lines)


def test_a_clean_file_has_no_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n')
    told = quarantine.read_jsonl(spark, str(tmp_path), schema(spark)).reconciled().first()
    assert (told.good, told.rejected, told.reasons) == (1, 0, {})


def rows(spark, n=20_000):
    return spark.range(n).select("id", (F.col("id") % 100).cast("string").alias("s"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("d")).repartition(5)


def test_equal_tables_in_any_order_do_not_differ(spark):
    a, b = rows(spark), rows(spark).orderBy(F.desc("id"))
    assert compare.differing_buckets(a, b) == [] and compare.differences(a, b).count() == 0
    plan = compare.checksums(a)._jdf.queryExecution().executedPlan().toString()
    assert "functions=[partial_count(1)" in plan and plan.count("Exchange hashpartitioning(bucket") == 1


def test_changed_lost_and_doubled_rows_are_told(spark):
    a = rows(spark)
    b = (a.where("id <> 5").withColumn("s", F.when(F.col("id") == 7, "changed").otherwise(F.col("s"))).unionByName(a.where("id = 11")).unionByName(a.where("id = 11"))
         .withColumn("d", F.when(F.col("id") == 13, None).otherwise(F.col("d"))))
    got = sorted((r.id, r.s, r.in_a, r.in_b) for r in compare.differences(a, b).collect())
    assert got == [(5, "5", 1, 0), (7, "7", 1, 0), (7, "changed", 0, 1), (11, "11", 1, 3), (13, "13", 0, 1), (13, "13", 1, 0)]
    assert len(compare.differing_buckets(a, b)) <= 6
    # Two equal rows more on both sides of an xor still change the sum and the count.
    assert compare.differences(a, a.unionByName(a)).count() == a.count()
    assert compare.differences(a.where("false"), a.where("false")).count() == 0
