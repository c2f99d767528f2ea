"""Merkle manifest, hard negatives and multiset hashes against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from baobab.llm import hard_negatives, merkle, multiset_hash
from baobab.llm.ranks import ranked

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "one\ntwo\n", "en", "a", 8), (1, "one\ntwo\n", "en", "a", 8), (1, "other text, taken id", "en", "a", 1),
    (2, None, None, None, None), (3, "", "en", "a", 0), (None, "no id here", "en", None, 3), (None, None, None, None, None),
    (4, "é words\n\nin two paragraphs ß", "fr", "", 9), (-5, "\n", "en", "ä", 1), (6, "-", "-", "-", -1),
    (7, "x " * 30_000 + "end\n" * 300, "en", "c", 1), (8, "copy of a text " * 20, "en", "d", 1), (9, "copy of a text " * 20, "en", "d", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, DOCS)
    given = spark.read.parquet(f"{SF}/documents.parquet").select(odd.columns).withColumn("doc_id", F.col("doc_id") + 1000)
    clash = ("i", "h", "key", "item", "total", "block", "at", "own", "path", "root", "leaf", "rank", "part", "tie", "copies")
    return odd.unionByName(given).withColumns({c: F.lit("mine") for c in clash})


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


# ------------------------------------------------------------------ ranks
def test_ranks_equal_sorting(spark):
    r = random.Random(3)
    data = [(r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(40)])) for _ in range(500)]
    frame = spark.createDataFrame(data, "g string, v long").repartition(7)
    got = ranked(frame, ["g"], ["v"]).collect()
    assert sorted((x.g or "", x.g is None, x.v or -1, x.v is None) for x in got) == sorted((g or "", g is None, v or -1, v is None) for g, v in data)
    for g in ("a", "b", None):
        mine = sorted((x.rank, -1 if x.v is None else x.v, x.total) for x in got if x.g == g)
        assert [m[0] for m in mine] == list(range(len(mine))) and {m[2] for m in mine} == {len(mine)}
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)
    assert ranked(frame.where("false"), ["g"], ["v"]).count() == 0


# ------------------------------------------------------------------ manifest
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root, and for every leaf its (left, right) per step."""
    level, paths, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, place in enumerate(at):
            run = level[place // 3 * 3:place // 3 * 3 + 3]
            paths[k].append(("".join(run[:place % 3]), "".join(run[place % 3 + 1:])))
            at[k] = place // 3
        level = [sha("".join(level[k:k + 3])) for k in range(0, len(level), 3)]
    return level[0], paths


def manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subroots = {}
    for s in order:
        by_source[s].sort(key=lambda x: x[:3])
        subroots[s] = tree([x[2] for x in by_source[s]])
    root, tops = tree([subroots[s][0] for s in order])
    for s, top in zip(order, tops):
        for (_, _, leaf, r), path in zip(by_source[s], subroots[s][1]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = leaf_of(r, text)
            for left, right in path + top:
                now = sha(left + now + right)
            yield (r["doc_id"], leaf, subroots[s][0], root, sha("".join(a + b for a, b in path + top)), now, now == root)


@pytest.mark.parametrize("depth", [6, 2, 1])
def test_manifest_equals_brute_force(docs, rows, depth, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", depth)  # low blocks: several heights of them
    got = merkle.digest(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, manifest(rows)))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_proofs_keep_columns_and_fold_to_the_root(docs):
    found = merkle.proofs(docs.withColumn("leaf", merkle.leaf_hash([F.col("text")])), "leaf", "source", ["doc_id"])
    assert set(docs.columns) | {"subroot"} == set(found.columns) and found.where("key = 'mine'").count() == docs.count()
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_manifest_of_one_source_one_row_or_none(spark, docs):
    assert merkle.digest(docs.where("false")).count() == 0
    one = merkle.digest(spark.createDataFrame(ODD[4:5], DOCS)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("") and one.verified


# ------------------------------------------------------------------ hard negatives
def test_strassen_is_exact():
    r = np.random.default_rng(5)
    for m, d, n, big in ((1, 1, 1, 9), (70, 65, 133, 2 ** 20), (128, 128, 128, 2 ** 62), (33, 200, 5, 9), (40, 0, 40, 9)):
        a, b = r.integers(-big, big, (m, d)), r.integers(-big, big, (d, n))
        assert (hard_negatives.strassen(a, b, cutoff=8) == a @ b).all()


def test_components_are_floored_and_wrap():
    values = [[0.5, -0.001, 1e300], [], [3.0], [2.0 ** 55, -2.0 ** 55 - 2.0 ** 3]]
    got = hard_negatives.to_integers(pa.array(values, pa.list_(pa.float64())))
    for row, want in zip(got, values):
        whole = [math.floor(v * 256) if abs(v) < 1e290 else int(v) * 256 for v in want] + [0] * (3 - len(want))
        assert [int(x) % 2 ** 64 for x in row] == [w % 2 ** 64 for w in whole]


def negatives(rows):
    kept = []
    for r in rows:
        v = r["embedding"]
        if r["label"] is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = r["vec_id"] is not None and r["vec_id"] % 7 == 0
        kept.append((r["vec_id"], (r["label"] + 1) % 10 if moved else r["label"], [math.floor(256 * x) for x in v]))
    by_score = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for ident, label, e in kept:
        if ident is None or ident % 100:
            continue
        scored = [(sum(p * q for p, q in zip(e, w)), i, lab) for i, lab, w in kept]
        for ps, pid, _ in sorted((x for x in scored if x[2] == label and x[1] != ident), key=by_score)[:5]:
            found = sorted((x for x in scored if x[2] != label and 30 * ps <= 100 * x[0] <= 90 * ps), key=by_score)[:10]
            for k, (ns, nid, _) in enumerate(found):
                yield (ident, pid, k + 1, nid, ps, ns)


@pytest.fixture(scope="module")
def vectors(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    same = [0.25] * 8
    odd = [(None, same, 1), (10_001, None, 1), (10_002, [0.1, None], 1), (10_003, [float("nan")], 2), (10_004, [float("inf")], 2),
           (10_005, same, None), (10_100, same, 3), (10_100, same, 3), (10_200, [], 3), (10_300, [1.0], 3), (10_400, same, 4),
           *((10_500 + k, same, 4) for k in range(1, 30)), *((10_600 + k, [0.2] * 8, 5) for k in range(1, 60)), (None, [0.2] * 8, 5),
           (-100, same, 3), (-99, [-0.2] * 8, 6), (10_701, [0.2] * 8, 5), (10_701, [0.2] * 8, 5)]
    return given.unionByName(spark.createDataFrame(odd, given.schema)).withColumns({"anchor": F.lit("mine"), "score": F.lit("mine"), "at": F.lit(1)}).repartition(5)


@pytest.mark.parametrize("block_bytes", [hard_negatives.BLOCK_BYTES, 3 * 64 * 8])
def test_negatives_equal_brute_force(vectors, block_bytes, monkeypatch):
    monkeypatch.setattr(hard_negatives.mine, "__defaults__", (*hard_negatives.mine.__defaults__[:-1], block_bytes))
    got = hard_negatives.digest(vectors).collect()
    want = list(negatives(vectors.collect()))
    assert want and sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_negatives_without_anchors(vectors):
    assert hard_negatives.digest(vectors.where("false")).count() == 0
    assert hard_negatives.digest(vectors.where("vec_id % 100 <> 0")).count() == 0


# ------------------------------------------------------------------ multiset hashes
def spark_hash(*parts):
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else (p & (2 ** 64 - 1)).to_bytes(8, "little") if p >= 2 ** 32 else p.to_bytes(4, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def long_then(h, k):
    return xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42))


def brute_lanes(text):
    equal, hashes = [0] * multiset_hash.EQUAL, []
    for p in (text or "").split("\n"):
        for i in range(multiset_hash.EQUAL // 2):
            h = spark_hash(i, sha(p))
            equal[2 * i] += h >> 32
            equal[2 * i + 1] += h & (2 ** 32 - 1)
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", p) if w]
        n = multiset_hash.SHINGLE
        runs = [words[i:i + n] for i in range(len(words) - n + 1)] if len(words) >= n else [words] if words else []
        hashes += [spark_hash(*run) for run in runs]
    counts = [c for k in range(multiset_hash.SIGNS // 64) for c in np.array(
        [[(h if k == 0 else long_then(h, k)) >> j & 1 for j in _order()] for h in hashes]).reshape(-1, 64).sum(0).tolist()]
    return [x % 2 ** 32 for x in [*equal, len(hashes), *counts]]


def _order():
    return [8 * k + j for k in range(8) for j in range(8)]


def test_lanes_equal_brute_force(docs, rows):
    got = docs.select("text", multiset_hash.lanes(F.col("text")).alias("lanes")).collect()
    assert len(got) == len(rows)
    for r in got[:40]:
        assert r.lanes == brute_lanes(r.text)


def test_paragraphs_in_any_order_inserted_and_deleted(spark):
    frame = spark.createDataFrame([("b b b\na a a a", "a a a a\nb b b", "b b b", "a a a a")], "x string, y string, b string, a string")
    x, y, b, a = (multiset_hash.lanes(F.col(c)) for c in "xyba")
    r = frame.select((x == y).alias("order"), (multiset_hash.combine(a, b) == x).alias("insert"), (multiset_hash.combine(x, b, -1) == a).alias("delete"),
                     (multiset_hash.lanes_of(multiset_hash.as_text(x)) == x).alias("text"), (x == a).alias("differs")).first()
    assert r.order and r.insert and r.delete and r.text and not r.differs


def edits(rows):
    """Distinct (id, text) in order, each with its edited text and the next text."""
    def key(r):
        own = f"{'-' if r['doc_id'] is None else r['doc_id']}:{hashlib.md5((r['text'] or '').encode()).hexdigest()}"
        return (r["doc_id"] is not None, r["doc_id"] or 0, own)
    distinct = {key(r): r["text"] or "" for r in rows}
    order = sorted(distinct)
    for k, mine in enumerate(order):
        text, following = distinct[mine], distinct[order[(k + 1) % len(order)]]
        half = len(text) // 2
        yield mine, (text, text[:len(text) - half] + following[:half], following)


@pytest.mark.parametrize("block", [multiset_hash.BLOCK, 7, 1])
def test_edits_and_likeness(docs, rows, block, monkeypatch):
    monkeypatch.setattr(multiset_hash.neighbours, "__defaults__", (block,))
    got = multiset_hash.digest(docs).collect()
    want, copies = dict(edits(rows)), Counter((r["doc_id"], r["text"] or "") for r in rows)
    expected = Counter()
    for (has, ident, _), (text, edited, _) in want.items():
        ident = ident if has else None
        expected[str((ident, len(text), sha(edited)))] += copies[ident, text]
    assert Counter(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == expected
    of = {sha(v[1]) + str(k[1]): (v, k) for k, v in want.items()}
    for r in got[:60]:
        (text, edited, following), _ = of[r.edited_sha256 + str(r.doc_id or 0)]
        for mine, other, near in ((text, edited, r.near_edited), (text, following, r.near_next)):
            a, b = (brute_lanes(t) for t in (mine, other))
            s, e = (np.array([2 * c - v[multiset_hash.EQUAL] for c in v[multiset_hash.EQUAL + 1:]], float) for v in (a, b))
            share = 1.0 if a == b else max(0.0, 2 * (s @ e) / (s @ s + e @ e)) if s @ s + e @ e else 0.0
            assert near == pytest.approx(min(1.0, share), abs=1e-9)
    prose = [r for r in got if r.n_chars > 400]
    assert np.mean([r.near_edited > r.near_next for r in prose]) > 0.97
    assert {len(r.fingerprint) for r in got} == {multiset_hash.LANES * 8}


def test_equal_texts_have_equal_fingerprints_and_an_empty_table(docs):
    by = {r.doc_id: r for r in multiset_hash.digest(docs).collect()}
    assert by[8].fingerprint == by[9].fingerprint and by[8].near_next == 1.0
    assert by[2].fingerprint == by[3].fingerprint
    assert multiset_hash.digest(docs.where("false")).count() == 0
