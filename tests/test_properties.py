"""Property checks against plain-Python semantics on random small inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from baobab.functions.amounts import clean_amount
from baobab.operators import joins

keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=25)
SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(left=keys, right=keys)
def test_not_in_matches_sql_semantics(spark, left, right):
    ldf = spark.createDataFrame([(k,) for k in left], "k int")
    rdf = spark.createDataFrame([(k,) for k in right], "k int")
    got = sorted((r.k is None, r.k or 0) for r in joins.not_in(ldf, rdf, "k").collect())
    if not right:
        exp = left
    elif None in right:
        exp = []
    else:
        exp = [k for k in left if k is not None and k not in right]
    assert got == sorted((k is None, k or 0) for k in exp)


@settings(**SETTINGS)
@given(facts=st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 100))), max_size=30),
       dim=st.lists(st.integers(0, 5), max_size=15))
def test_join_audit_matches_materialised_join(spark, facts, dim):
    fdf = spark.createDataFrame(facts, "k int, v int")
    ddf = spark.createDataFrame([(k,) for k in dim], "k int")
    a = joins.join_audit(fdf, ddf, "k", "v").collect()[0]
    copies = [dim.count(k) for k, _ in facts]
    vals = [v or 0 for _, v in facts]
    assert a.nb_avant == len(facts)
    assert (a.nb_apres or 0) == sum(copies)
    assert a.nb_perdues == sum(1 for c in copies if c == 0)
    assert (a.nb_dupliquees or 0) == sum(c - 1 for c in copies if c > 1)
    assert (a.somme_apres or 0) == sum(v * c for v, c in zip(vals, copies))
    assert (a.somme_perdue or 0) == sum(v for v, c in zip(vals, copies) if c == 0)


@settings(**SETTINGS)
@given(texts=st.lists(st.text(alphabet=" 0123456789-.,FCAfca", max_size=12), min_size=1, max_size=20))
def test_clean_amount_is_digit_stripping(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clean_amount("t")).collect()]
    exp = []
    for t in texts:
        d = re.sub(r"[^0-9]", "", t.strip(" "))
        exp.append(int(d) if d and len(d) < 19 else None)
    assert got == exp


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b", "B "]))),
                     max_size=30))
def test_measure_profile_matches_python(spark, rows):
    from pyspark.sql import functions as F

    from baobab.operators.quality import measure_profile
    df = spark.createDataFrame(rows, "k int, s string")
    p = measure_profile(df, {"s": F.col("s"), "norm": F.lower(F.trim("s")),
                             "row": F.struct("k", "s")}).collect()
    if not rows:
        return
    r = p[0]
    vals = [s for _, s in rows]
    assert r.s_rows == len(rows) and r.s_nulls == vals.count(None)
    assert r.s_distinct == len({v for v in vals if v is not None})
    assert r.norm_distinct == len({v.strip().lower() for v in vals if v is not None})
    assert r.row_surplus == len(rows) - len(set(rows))


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.text("xyz", max_size=2)),
                     max_size=30))
def test_latest_per_key_matches_python(spark, rows):
    from baobab.operators.windows import latest_per_key
    df = spark.createDataFrame(rows, "k int, d int, s string")
    got = {r.k: (r.d, r.s) for r in latest_per_key(df, ["k"], ["d"]).collect()}
    exp = {}
    for k, d, s in rows:
        # greatest (d, s), NULLs lowest
        cand = ((d is not None, d or 0), s)
        if k not in exp or cand > exp[k][0]:
            exp[k] = (cand, (d, s))
    assert got == {k: v for k, (_, v) in exp.items()}
