"""A key holding a third of the fact rows: AQE splits it across tasks at run time."""

import shutil
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from baobab.operators import joins as J
from baobab.operators.windows import latest_per_key
from baobab.plans import QUERIES
from conftest import SF_SMALL

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",          # force a shuffle join
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _facts(spark, n=60_000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    return spark.range(n).select(hot.alias("k"), F.col("id").alias("v"))


def test_hot_key_join_is_split(spark):
    with conf(spark, SMALL):
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        out = J.enrich(_facts(spark), dim, "k", ["w"])
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 60_000
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_key_latest_per_key_is_pre_aggregated(spark):
    out = latest_per_key(_facts(spark), ["k"], ["v"])
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == 1000 and got[7] == 59_997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2  # partial + final


@pytest.fixture(scope="module")
def hot_orders(spark, tmp_path_factory):
    """The small tables with a third of the orders on customer 7, in several files."""
    root = tmp_path_factory.mktemp("hot")
    for t in ("customer", "nation", "region", "lineitem", "part"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", root / f"{t}.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")).cast(o.schema["o_custkey"].dataType)
    o.withColumn("o_custkey", hot).repartition(6).write.parquet(f"{root}/orders.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["enrich_on_key", "enrich_by_expr", "orphans_left_null", "top3_by_region",
                                  "top_products", "three_source_revenue"])
def test_hot_customer_is_split(spark, hot_orders, name):
    with conf(spark, SMALL):
        out = QUERIES[name](spark, hot_orders)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "skew=true" in line]
    assert any("customer_id" in line or "_rk" in line for line in joins), plan
