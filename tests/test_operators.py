"""Operators checked against brute-force Python on small fixtures."""

import datetime as dt
import random

from pyspark.sql import functions as F

from baobab.operators import funnel, joins, profile, quality, text
from baobab.operators.windows import behind_running_max, latest_per_key, top_n_per_group


def test_behind_running_max_of_sparse_ids_by_key(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["a", "b", None]), i, base + dt.timedelta(minutes=rnd.randint(0, 10_000)))
            for i in {rnd.randrange(-2 ** 62, 2 ** 62) for _ in range(400)}]
    df = spark.createDataFrame(rows, "k string, event_id long, t timestamp").repartition(4)
    out = behind_running_max(df, "event_id", "t", by=["k"])
    best, exp = {}, {}
    for k, i, t in sorted(rows, key=lambda r: r[1]):
        exp[i] = best.get(k)
        best[k] = max(t, best.get(k, t))
    assert {r.event_id: r.max_avant for r in out.collect()} == exp
    assert out.columns == ["k", "event_id", "t", "max_avant"]


def test_behind_running_max_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    ids = rnd.sample(range(5000), 700)  # sparse, unordered arrival keys
    rows = [(i, base + dt.timedelta(minutes=rnd.randint(0, 10_000))) for i in ids]
    df = spark.createDataFrame(rows, "event_id long, t timestamp").repartition(5)
    for block in (1, 7, 64, 10_000):
        got = {r.event_id: r.max_avant for r in behind_running_max(df, "event_id", "t", block).collect()}
        best, exp = None, {}
        for i, t in sorted(rows):
            exp[i] = best
            best = t if best is None else max(best, t)
        assert got == exp, block


def test_latest_per_key_hot_key(spark):
    # one key holds most rows; result must still be one row per key, latest first
    rows = [("hot", i, f"v{i}") for i in range(5000)] + [("cold", 1, "a"), ("cold", 3, "b")]
    df = spark.createDataFrame(rows, "k string, d int, v string").repartition(8)
    got = {r.k: (r.d, r.v) for r in latest_per_key(df, ["k"], ["d"]).collect()}
    assert got == {"hot": (4999, "v4999"), "cold": (3, "b")}


def test_top_n_per_group(spark):
    rows = [("a", "x", 5), ("a", "y", 5), ("a", "z", 1), ("a", "w", 9), ("b", "x", 1)]
    df = spark.createDataFrame(rows, "g string, p string, v int")
    out = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("p")], 2).collect()
    assert sorted((r.g, r.p, r.rang) for r in out) == [("a", "w", 1), ("a", "x", 2), ("b", "x", 1)]


def test_funnel_matches_count_distinct(spark):
    rnd = random.Random(3)
    types = ["view_product", "add_to_cart", "purchase", "search"]
    rows = [(f"s{rnd.randint(0, 60)}", rnd.choice(types), rnd.choice(["m", "d"])) for _ in range(2000)]
    rows.append((None, "purchase", "m"))
    df = spark.createDataFrame(rows, "session_id string, event_type string, device string")
    got = funnel.funnel_counts(df).collect()[0]
    sess = {s for s, _, _ in rows if s}
    by = {t: {s for s, tt, _ in rows if s and tt == t} for t in types}
    assert (got.sessions, got.vues, got.paniers, got.achats) == (
        len(sess), len(by["view_product"]), len(by["add_to_cart"]), len(by["purchase"]))
    seg = {r.device: (r.sessions, r.achats) for r in funnel.segment_conversion(df, "device").collect()}
    for d in ("m", "d"):
        s = {x for x, _, dd in rows if x and dd == d}
        p = {x for x, t, dd in rows if x and dd == d and t == "purchase"}
        assert seg[d] == (len(s), len(p))


def test_word_counts_whole_text(spark):
    df = spark.createDataFrame([(" Le chat  le\nchien\tLE ",), ("",), (None,)], "value string")
    got = {r.mot: r.n for r in text.word_counts(df).collect()}
    assert got == {"le": 3, "chat": 1, "chien": 1}


def test_join_audit_lost_and_duplicated(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None)], "k int, v int")
    dim = spark.createDataFrame([(1,), (1,), (1,), (2,), (4,)], "k int")
    a = joins.join_audit(facts, dim, "k", "v").collect()[0]
    assert (a.nb_avant, a.nb_apres, a.nb_perdues, a.nb_dupliquees) == (4, 5, 1, 2)
    assert (a.somme_avant, a.somme_apres, a.somme_perdue, a.somme_dupliquee) == (60, 50, 30, 20)


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "x int, y string")
    got = {r.colonne: (r.type_spark, r.nb_lignes, r.nb_null, r.nb_distinct)
           for r in profile.profile_columns(df).collect()}
    assert got == {"x": ("int", 4, 1, 2), "y": ("string", 4, 1, 2)}


def test_surplus_and_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 2)], "s string, n int")
    assert quality.surplus_rows(df).collect()[0].nb_doublons == 2


def test_key_concentration(spark):
    rows = [(1,)] * 30 + [(2,)] * 10 + [(k,) for k in range(3, 63)]
    df = spark.createDataFrame(rows, "customer_id long")
    r = quality.key_concentration(df, "customer_id", 2).collect()[0]
    assert (r.cle_dominante, r.nb_lignes_cle, r.part_cle_pct, r.part_top2_pct) == (1, 30, 30.0, 40.0)


def test_equal_null_never_matches(spark):
    df = spark.createDataFrame([(None,), ("a",)], "email string")
    df.createOrReplaceTempView("t_null")
    assert spark.sql("SELECT COUNT(*) FROM t_null WHERE email = NULL").collect()[0][0] == 0
    assert spark.sql("SELECT COUNT(*) FROM t_null WHERE email IS NULL").collect()[0][0] == 1


def test_sizing_conf():
    from baobab.session import sizing_conf
    c = sizing_conf(100 * 1024 ** 4, cores=8000)  # 100 TB on 8000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    assert int(sizing_conf(1024, cores=8)["spark.sql.shuffle.partitions"]) == 16
