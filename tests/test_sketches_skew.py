"""Sketches, salted joins, collated keys and row fingerprints: results and plans."""

import pytest
from pyspark.sql import functions as F

from baobab.functions.text import city_key
from baobab.operators import joins as J
from baobab.operators import quality, sketches
from baobab.operators.skew import heavy_keys, salted_join
from baobab.plans import QUERIES
from baobab.plans import model as M
from baobab.plans.base import wh
from conftest import SF_SMALL
from test_skew import conf


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ sketches
def test_sketched_profile_is_near_the_exact_one(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") % 20_000).alias("many"), F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("some"),
                               F.lit(None).cast("double").alias("none"), (F.col("id") / 7).cast("decimal(12,3)").alias("dec"), F.lit(True).alias("one"))
    got = {r.colonne: r for r in sketches.sketched_profile(df).collect()}
    for name, exact in (("many", 20_000), ("some", 10_000), ("none", 0), ("dec", n), ("one", 1)):
        assert got[name].nb_distinct_estime == pytest.approx(exact, rel=0.05) and got[name].nb_lignes == n
    assert got["some"].nb_null == n * 3 // 4 and got["none"].nb_null == n
    assert [r.nb_distinct_estime for r in sketches.sketched_profile(df.where("false")).collect()] == [0] * 5


def test_all_columns_come_from_one_scan(spark):
    assert plan(QUERIES["profile_columns_sketch"](spark, SF_SMALL)).count("FileScan") == 1


def test_merged_sketches_are_those_of_the_union(spark, tmp_path):
    df = spark.range(30_000).select((F.col("id") % 9).alias("day"), (F.col("id") % 7_000).alias("user"))
    sketches.column_sketches(df, ["user"], by=["day"]).write.parquet(str(tmp_path / "days"))
    merged = sketches.merge_sketches(spark.read.parquet(str(tmp_path / "days")))
    whole = sketches.column_sketches(df, ["user"])
    a, b = (s.select("rows", "user_known", sketches.estimated(s, "user").alias("n")).first() for s in (merged, whole))
    assert (a.rows, a.user_known) == (b.rows, b.user_known) == (30_000, 30_000)
    assert a.n == pytest.approx(7_000, rel=0.05) and b.n == pytest.approx(7_000, rel=0.05)


# ------------------------------------------------------------------ heavy keys
@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 31 == 1, 8).when(F.col("id") % 50 == 2, None).otherwise(F.col("id") % 5_000 + 100)
    return spark.range(60_000).repartition(6).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


def test_heavy_keys_are_found(spark, facts):
    found = spark.range(1).select(heavy_keys(facts, "k").alias("h")).first().h
    assert sorted(found) == [7, 8]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_one_and_spreads_the_key(spark, facts, how):
    # Key 8 has no row in the dimension, key 7 two.
    dim = spark.range(4_000).where("id <> 8").select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).unionAll(spark.sql("SELECT 7L, -1L"))
    off = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with conf(spark, off):
        salted, plain = salted_join(facts, dim, "k", ["w"], how), facts.join(dim, "k", how)
        assert "BroadcastHashJoin" not in plan(salted)
        assert sorted(map(str, salted.select("k", "v", "w").collect())) == sorted(map(str, plain.select("k", "v", "w").collect()))

        def largest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            return max(sizes) / sum(sizes)

        assert largest(plain) > 0.4 and largest(salted) < 0.2


def test_salted_join_refuses_what_it_would_repeat(spark, facts):
    with pytest.raises(ValueError):
        salted_join(facts, facts, "k", ["v"], "full")


# ------------------------------------------------------------------ reverse anti join
def test_facts_on_the_right_are_reduced_before_the_shuffle(spark, facts):
    left = spark.range(5_200).select(F.col("id").alias("k"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        out = J.anti(left, facts, "k", facts_on_right=True)
        text = plan(out)
    assert "LeftAnti" in text and text.count("HashAggregate") == 2
    assert sorted(r.k for r in out.collect()) == sorted(r.k for r in J.anti(left, facts, "k").collect()) != []
    for name in ("customers_without_order", "customers_without_delivered_order"):
        assert "LeftAnti" in plan(QUERIES[name](spark, SF_SMALL))


# ------------------------------------------------------------------ collation
def test_collated_cities_group_as_normalised_ones(spark):
    from baobab.operators.clean import normalize_city
    c = normalize_city(M.customers_raw(wh(spark, SF_SMALL))).where("ville_norm is not null")
    pairs = c.select(city_key("ville").alias("a"), F.col("ville_norm").alias("b")).groupBy("a").agg(F.count_distinct("b").alias("n"))
    assert {r.n for r in pairs.collect()} == {1}
    assert pairs.count() == c.select("ville_norm").distinct().count()
    odd = spark.createDataFrame([("É", "e "), ("straße", "strasse"), ("a", "b")], "x string, y string")
    assert [r[0] for r in odd.select(city_key("x") == city_key("y")).collect()][::2] == [True, False]


# ------------------------------------------------------------------ fingerprints
def test_fingerprints_tell_rows_apart(spark):
    rows = [(None, "a"), ("a", None), ("a", "a"), (None, None), ("", "a"), ("aa", ""), ("a", "a"), (None, "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(quality.fingerprint([F.col("x"), F.col("y")]).alias("f")).distinct().count() == len(set(rows))
    assert quality.surplus_rows(df).first()[0] == len(rows) - len(set(rows))
    assert quality.surplus_rows(df.where("false")).first()[0] == 0


def test_what_moves_does_not_grow_with_the_table(spark):
    wide = M.customers_raw(wh(spark, SF_SMALL)).withColumns({f"c{i}": F.concat(F.lit("x" * 50), "nom") for i in range(40)})
    for out in (quality.surplus_rows(wide), quality.near_duplicates(wide, {"email": F.lower(F.trim(F.col("email")))}), quality.cleaning_report(wide)):
        for line in plan(out).splitlines():
            if "Exchange hashpartitioning" in line:
                assert "c39" not in line and "telephone" not in line, line
    assert quality.near_duplicates(wide, {}).first().nb_lignes == wide.count()


# ------------------------------------------------------------------ lines and products
@pytest.mark.parametrize("name", ["three_source_revenue", "top3_by_region"])
def test_lines_are_shuffled_once(spark, name):
    import re
    with conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        lines = plan(QUERIES[name](spark, SF_SMALL)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "Scan" in line)
    depth, above = re.search(r"[A-Za-z*]", lines[scan]).start(), []
    for line in reversed(lines[:scan]):
        at = re.search(r"[A-Za-z*]", line).start()
        if at < depth:
            depth = at
            above.append(line)
    subtotal = next(i for i, line in enumerate(above) if "HashAggregate" in line)
    assert sum("Exchange" in line for line in above[:subtotal]) <= 1
    assert "product_id" not in above[subtotal]  # what is left is the result's groups, not lines
