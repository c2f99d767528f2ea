"""Physical-plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def Q():
    return E.queries()


def test_top_n_has_partial_window_group_limit(spark, Q):
    p = _plan(Q["top3_by_region"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2  # partial (before the shuffle) and final


def test_funnel_avoids_expand(spark, Q):
    for name in ("funnel", "funnel_by_device", "funnel_by_city"):
        assert "Expand" not in _plan(Q[name](spark, SF_SMALL)), name


def test_dedup_is_an_aggregation_not_a_window(spark, Q):
    p = _plan(Q["dedup_customers"](spark, SF_SMALL))
    assert "Window" not in p and "Aggregate" in p


def test_no_cartesian_or_nested_loop(spark, Q):
    for name, fn in Q.items():
        if name.startswith(("stream_", "compact_", "csv_", "jsonl_", "text_")):
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_no_python_udf_in_registered_queries(spark, Q):
    for name, fn in Q.items():
        if name.startswith(("stream_", "compact_", "csv_", "jsonl_", "text_")):
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_filter_and_projection_reach_the_scan(spark, Q):
    p = _plan(Q["status_channel_month_count_df"](spark, SF_SMALL))
    read_schema = p.split("ReadSchema:")[1].split("\n")[0]
    # only the columns the count needs are read (no customer key, no amount)
    assert "o_custkey" not in read_schema and "o_totalprice" not in read_schema
    assert "PushedFilters: [IsNotNull(o_orderdate)" in p or "o_orderdate" in p.split("PushedFilters:")[1]


def test_single_scan_quality_report(spark, Q):
    p = _plan(Q["quality_report"](spark, SF_SMALL))
    assert p.count("FileScan parquet") <= 3 and "Expand" not in p  # customer, nation, region


def _ops(df) -> list[str]:
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    # operator names only (no attribute ids, aliases or arguments)
    names = [re.sub(r"^[\s+\-:*()0-9]*", "", line).split(" ")[0].split("(")[0] for line in plan.splitlines()]
    return [n for n in names if n]


def test_sql_and_dataframe_forms_plan_alike(spark, Q):
    for sql_name, df_name in [("basket_by_channel_sql", "basket_by_channel_df"),
                              ("status_channel_month_count_sql", "status_channel_month_count_df"),
                              ("orphan_orders_sql", "orphan_orders_df")]:
        a, b = _ops(Q[sql_name](spark, SF_SMALL)), _ops(Q[df_name](spark, SF_SMALL))
        strip = lambda ops: [o for o in ops if o not in ("Project", "Filter")]
        assert strip(a) == strip(b), (sql_name, a, b)


def test_lines_are_shuffled_once_before_the_subtotal(spark, Q):
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("top_products", "product_ranking"):
            lines = _plan(Q[name](spark, SF_SMALL)).splitlines()
            scan = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "Scan" in line)
            depth = re.search(r"[A-Za-z*]", lines[scan]).start()
            between = []  # the scan's ancestors, from below
            for line in reversed(lines[:scan]):
                at = re.search(r"[A-Za-z*]", line).start()
                if at < depth:
                    depth = at
                    between.append(line)
            subtotal = next(i for i, line in enumerate(between) if "HashAggregate" in line)
            assert sum("Exchange" in line for line in between[:subtotal]) == 1, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_profiles_expand_no_row(spark, Q):
    for name in ("profile_columns", "city_distinct_before_after", "near_duplicates"):
        p = _plan(Q[name](spark, SF_SMALL))
        assert "to_json" not in p and "Expand" not in p, name
    assert "to_json" not in _plan(Q["quality_report"](spark, SF_SMALL))
    p = _plan(Q["profile_columns"](spark, SF_SMALL)).splitlines()
    generate = [i for i, line in enumerate(p) if "Generate" in line]
    scan = [i for i, line in enumerate(p) if "FileScan" in line]
    assert all(any("Aggregate" in line for line in p[g:scan[0]]) for g in generate)


def test_delivered_orders_are_filtered_in_the_scan(spark, Q):
    for name in ("top3_by_region", "monthly_revenue", "enrich_by_expr"):
        assert "EqualTo(o_orderstatus,F)" in _plan(Q[name](spark, SF_SMALL)), name


def test_a_query_opens_only_its_tables(spark, Q, tmp_path):
    import shutil
    for t in ("orders", "customer", "nation", "region"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    assert Q["enrich_orders"](spark, str(tmp_path)).columns
