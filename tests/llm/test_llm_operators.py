"""Operators against brute force, and the stated results of odd inputs."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from baobab.llm import (decontaminate, license_scan, mixing, preferences, quality_classifier, quality_rules,
                        secret_scan, sharding, simhash, substring_dedup)
from baobab.llm._text import SPACE_WORD

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DOCS_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(SPACE_WORD)
NOTICE = ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
          "granted, provided that the above copyright notice and this permission notice appear in all copies")
ODD = [
    (1, "CC BY all rights reserved; GNU General Public License. cc-by", "en", "a", 1),
    (1, "CC BY all rights reserved; GNU General Public License. cc-by", "en", "a", 1),
    (2, None, None, None, None), (3, "", "en", "a", 0), (None, "no id here", "en", None, 3), (None, None, None, None, None),
    (4, "é password = hunter22 token:abc AKIA" + "A" * 16 + " " + "0af" * 9 + " api_key='zz' password=token:abcdef user: bob", "fr", "b", 9),
    (5, "user=alice pwd: hello host=db.example.com", "en", "b", 1), (6, "see https://only.url/here", "en", "c", 1),
    (7, "x " * 30_000 + "end", "en", "c", 1), (8, NOTICE.upper(), "en", "d", 1),
    (9, "\t\x0b mixed\x1cspace  words\x85 \n\n line\n line\n", "zz", "e", 2),
]


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def key(row):
    return str(tuple(row))


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, DOCS)
    given = spark.read.parquet(f"{SF}/documents.parquet").select(odd.columns).withColumn("doc_id", F.col("doc_id") + 1000)
    clash = spark.createDataFrame([(1, "another text under an id that is taken", "en", "a", 1)], DOCS)
    # Columns that operators use for themselves.
    return odd.unionByName(clash).unionByName(given).withColumns({c: F.lit("mine") for c in ("n_words", "items", "copies", "key", "size", "kept", "fp")})


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_license_base_columns(docs, rows):
    def of(r):
        w, found = ALNUM.findall(ascii_lower(r.text)), []
        for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
            p = phrase.split()
            found += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
        at = [i for i, _ in found]
        return r.doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))

    got = license_scan.digest(docs).collect()
    same([tuple(r)[:6] for r in got], [of(r) for r in rows])
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    notice = next(r for r in got if r.doc_id == 8)
    assert notice.labels == "isc" and 0.8 <= notice.score < 1  # one word of the template is missing


def test_shards_are_even_and_moves_are_few(spark, docs):
    names = [f"s{i}" for i in range(20)]
    table = sharding.fill_table(names)
    counts = [table.count(i) for i in range(20)]
    assert max(counts) - min(counts) <= 1
    fewer = sharding.fill_table(names[:-1])
    assert sum(a != b for a, b in zip(table, fewer) if a != 19) < 0.1 * len(table)

    def slot(r):
        name = str(r.doc_id) if r.doc_id is not None else "t" + (r.text or "")
        return int(hashlib.md5(name.encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE

    got = sharding.place(docs, names)
    assert got.columns == [*docs.columns, "shard"]
    same([(r.doc_id, r.text, r.shard) for r in got.collect()], [(r.doc_id, r.text, table[slot(r)]) for r in docs.collect()])
    with pytest.raises(ValueError):
        sharding.fill_table(names, 100)


@pytest.mark.parametrize("bound", [decontaminate.MAX_BROADCAST, 0])
def test_decontamination(spark, docs, rows, bound):
    bench = spark.createDataFrame([(500, "and the"), (501, "AND The"), (502, None), (None, "x x x"), (503, "!"), (504, "mixed")],
                                  "item_id long, text string")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(bench)
    windows = {}
    for r in bench.collect():
        w = ALNUM.findall(ascii_lower(r.text))
        if w:
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(None if r.item_id is None else str(r.item_id))
    lengths = {len(w) for w in windows}

    def of(r):
        w, hit, items = ALNUM.findall(ascii_lower(r.text)), set(), set()
        for i in range(len(w)):
            for n in lengths:
                if tuple(w[i:i + n]) in windows and i + n <= len(w):
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(w[i:i + n])]
        return r.doc_id, len(w), len(hit), sorted(items, key=lambda x: (x is None, x)), bool(hit) and 20 * len(hit) >= len(w)

    got = decontaminate.scan(docs.select("doc_id", "text"), bench, max_broadcast=bound)
    want = [of(r) for r in rows]
    same([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()], want)
    assert decontaminate.drop_documents(docs, bench, max_broadcast=bound).count() == sum(not w[-1] for w in want)


def test_cutting_spans(spark):
    docs = spark.createDataFrame([(1, "Keep, this. A B-c! tail."), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert {r.text for r in decontaminate.cut_spans(docs, bench).collect()} == {"Keep, this! tail.", "nothing"}


def test_secret_base_spans(docs, rows):
    def of(r):
        t, found = r.text or "", []
        for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
            found += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        return r.doc_id, *(sum(x[1] == k for x in found) for k in range(3)), hashlib.sha256(text.encode()).hexdigest()

    got = secret_scan.digest(docs).collect()
    same([tuple(r)[:5] for r in got], [of(r) for r in rows])


def test_weak_parts_need_each_other(docs):
    spans = {r.doc_id: r.spans for r in secret_scan.digest(docs).collect()}
    assert spans[5] == "identifier:0:10,secret:11:21,endpoint:22:41"
    assert spans[6] == "" and "identifier" in spans[4]
    far = {r.doc_id: r.spans for r in secret_scan.digest(
        docs.select(F.lit(1).cast("long").alias("doc_id"), F.lit("user=alice " + "x " * 200 + "pwd: hello").alias("text")).limit(1)).collect()}
    assert far == {1: ""}


SECRETS = {"identifier": "user: bob1", "access": "AKIA" + "B" * 16, "hex": "0a" * 14, "assign": "token=abcdef99", "secret": "pwd: hello", "endpoint": "host=db.example",
           "named hex": 'signing_key "' + "1b" * 13 + '"'}
ROLES = {"identifier": "identifier", "access": "identifier", "assign": "secret", "secret": "secret", "endpoint": "endpoint", "named hex": "secret"}


def test_every_pair_and_triple_of_secret_parts(spark):
    """Weak parts are reported exactly where complementary ones are in scope."""
    import itertools
    rnd, rows, want = random.Random(4), [], {}
    cases = [c for n in (1, 2, 3) for c in itertools.permutations(SECRETS, n)]
    for i, case in enumerate(cases):
        text, places = "é ", []
        for kind in case:
            text += "." * rnd.choice([2, 120, 400]) + " "
            places.append((kind, len(text), len(text) + len(SECRETS[kind])))
            text += SECRETS[kind] + " "
        rows.append((i, text))
        spans = set()
        for kind, start, end in places:
            near = {ROLES[k] for k, a, b in places if k in ROLES and (a, b) != (start, end) and (0 <= start - b <= 300 or 0 <= a - end <= 300)}
            if {"identifier": "secret" in near, "secret": bool(near & {"identifier", "endpoint"}), "endpoint": {"identifier", "secret"} <= near}.get(kind, True):
                at = start + SECRETS[kind].index("1b") if kind == "named hex" else start
                spans.add((kind.removeprefix("named "), at, end - (kind == "named hex")))
        want[i] = spans
    got = secret_scan.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        found = {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)}
        assert found == want[r.doc_id], (cases[r.doc_id], rows[r.doc_id][1])


def test_a_text_of_many_secrets(spark):
    import time
    text = "é token=abcdef " * 64_000
    start = time.time()
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.size("base"), F.element_at("base", -1)["end"]).first()
    assert tuple(got) == (64_000, len(text) - 1) and time.time() - start < 60


def test_license_stretches(spark):
    """A complete notice keeps its label, whatever phrases of it stand around it; a run of phrases alone has none."""
    from baobab.llm.license_templates import templates
    template, label, text = next((i, t[0], t[1]) for i, t in enumerate(templates()) if len(t[1].split()) > 60)
    words, phrase = text.split(), " ".join(text.split()[20:23])
    rnd = random.Random(8)
    noise = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(40))
    half = " ".join(words[:len(words) // 2])
    swapped = " ".join(w if i % 30 else "changed" for i, w in enumerate(words))
    cases = [(text, 1), (f"{text} " + f"{phrase} " * 40, 1), (f"{phrase} " * 40 + text, 1), (f"{noise} {text} {noise} {text}", 2), (f"{phrase} " * 200, 0),
             (half, 0), (f"{half} {noise} {noise} {noise}", 0), (swapped, 1), (f"{swapped} {phrase} {noise}", 1), ("", 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, (t, n) in enumerate(cases):
        spans = [s for s in got[i].spans if s.label == label]
        assert len(spans) == n and (label in got[i].labels.split(",")) == bool(n), (i, spans)
    assert all(s.coverage == 1.0 for s in got[1].spans + got[2].spans if s.label == label)


@pytest.mark.parametrize("script", ["abcdefghijklmnop", "абвгдежзийклмноп", "กขฃคฅฆงจฉชซฌญฎฏฐ"])
def test_salad_is_rejected_in_every_script(spark, script):
    rnd = random.Random(6)
    words = ["".join(rnd.choices(script, k=rnd.randint(5, 9))) for _ in range(40)]
    for n in (200, 50, 49, 20):
        rows = [(i, " ".join(rnd.choices(words, k=150)), "xx", "s", 1) for i in range(n)]
        rows += [(1000 + i, " ".join("".join(rnd.choices(script, k=7)) for _ in range(150)), "xx", "s", 1) for i in range(3)]
        got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, DOCS)).collect()}
        assert [i for i, k in got.items() if not k] == [1000, 1001, 1002], n


def test_distances_by_brute_force(docs, rows):
    import unicodedata
    from collections import Counter
    import xxhash as x

    def classes(t):
        out = Counter()
        for ch in t:
            if ch < "\x80":
                name = ("lower" if "a" <= ch <= "z" else "upper" if "A" <= ch <= "Z" else "digit" if "0" <= ch <= "9" else "space" if ch in " \t\n\x0b\x0c\r"
                        else "mark" if ch in ".,;:!?'\"()-" else "symbol" if "!" <= ch <= "~" else "other")
            else:
                c = unicodedata.category(ch)
                name = {"Ll": "other lower", "Lu": "other upper", "Lt": "other upper", "Lm": "other letter", "Lo": "other letter"}.get(
                    c, {"M": "other mark", "N": "other digit"}.get(c[0], "other sign"))
            out[name] += 1
        return out

    def lowered(t):
        return SPACE.findall(ascii_lower(t))

    def js(p, q):
        keys, a, b, total = set(p) | set(q), sum(p.values()), sum(q.values()), 0.0
        for k in keys:
            u, v = p.get(k, 0) / a, q.get(k, 0) / b
            for w in (u, v):
                total += w * math.log2(w / ((u + v) / 2)) if w else 0
        return max(0.0, total / 2) ** 0.5

    chars, words, n = {}, {}, Counter()
    for r in rows:
        t, lang = r.text or "", r.lang or ""
        if len(lowered(t)) >= 20:
            n[lang] += 1
            for table, counts in ((chars, classes(t)), (words, Counter(lowered(t)))):
                for k, v in counts.items():
                    table.setdefault(lang, Counter())[k] += round(v * 1_000_000 / sum(counts.values()))
    common = {}
    for lang, table in words.items():
        top = dict(sorted(table.items(), key=lambda kv: (-kv[1], (x.xxh64_intdigest(kv[0].encode()) + 2 ** 63) % 2 ** 64))[:64])
        common[lang] = top | {None: n[lang] * 1_000_000 - sum(top.values())}
    for r, g in zip(sorted(rows, key=key), sorted(quality_rules.judge(docs.select(DOCS_COLUMNS)).collect(), key=key)):
        t, lang = r.text or "", r.lang or ""
        w = lowered(t)
        c = js(classes(t), chars[lang]) if len(w) >= 20 else 0.0
        d = js(Counter(v if v in common[lang] else None for v in w), common[lang]) if len(w) >= 100 else 0.0
        assert g.chars_distance == pytest.approx(c, abs=1e-3) and g.words_distance == pytest.approx(d, abs=1e-3)
        wide = 0.5 / max(1, n[lang]) ** 0.5
        assert g.kept == (not g.base_failed and g.chars_distance <= 0.35 + wide and g.words_distance <= 0.40 + wide)


def test_classifier_with_a_repeated_labelled_id(spark):
    """An id on a third of the rows is one text of the sample, and one of the held-out ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one = labels.orderBy("doc_id").first().doc_id
    copies = docs.where(F.col("doc_id") == one).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("col")
    target = quality_classifier._labels(labels, "quality")
    a, b = (quality_classifier.fit_evidence(d, target) for d in (docs, docs.unionByName(copies)))
    assert a == b and a["weights"]


def test_key_buckets_are_even_for_any_weight(spark):
    for text in ("# # ab", "plain words here", "#"):
        rows = spark.range(100_000).select("id", F.lit("s").alias("source"), F.lit(text).alias("text"))
        keys = mixing.keyed(rows, doc_id="id").groupBy(mixing._bucket(F.col("key"))).count()
        assert keys.agg(F.max("count")).first()[0] < 100_000 / 500


def test_simhash_components(docs, rows):
    def fp(t):
        w = SPACE.findall(ascii_lower(t))
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = sorted({fp(r.text) for r in rows})
    group = {f: f for f in fps}
    for _ in fps:
        before = dict(group)
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
        if before == group:
            break
    least = {}
    for r in rows:
        if r.doc_id is not None:
            g = group[fp(r.text)]
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    same([tuple(r) for r in simhash.digest(docs).collect()],
         [(r.doc_id, f"{fp(r.text):016x}", least.get(group[fp(r.text)])) for r in rows])
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group.values()))


def test_simhash_splits_large_keys(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 3))) for b in base for _ in range(60)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    group = {f: f for f in signed}
    for _ in signed:
        before = dict(group)
        for a in signed:
            for b in signed:
                if (a ^ b).bit_count() <= 3 if (a < 0) == (b < 0) else ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
        if before == group:
            break
    assert {f: roots.get(f, f) for f in signed} == group


def test_mixing_targets_and_reruns(docs):
    first = mixing.mix_table(docs).collect()
    same(first, mixing.mix_table(docs).collect())
    same([(r.doc_id, r.size) for r in first], [(r.doc_id, len(SPACE.findall(r.text or ""))) for r in docs.collect()])
    by = {}
    for r in first:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), group in by.items():
        ties = 2 * max(r.size for r in group)  # a document and its repeated row are drawn together
        assert 0 <= target <= 2 * size and abs(sum(r.taken for r in group) - target) <= ties
        assert all(r.taken <= 2 * r.size for r in group)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = sum(len(SPACE.findall(r.text or "")) for r in mixed.collect())
    assert words == sum(r.taken for r in first)


def test_mixing_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10_000), (None, 900)], "source string, source_size long")
    weights, caps, total = {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}, {"a": 200, "b": 2000, "c": 20_000, None: 1800}, 18_000.0
    want, open_ = {}, dict(weights)
    while open_:
        rate = (total - sum(want.values())) / sum(open_.values())
        over = [s for s in open_ if rate * open_[s] >= caps[s]]
        for s in over:
            want[s] = caps[s]
            del open_[s]
        if not over:
            want |= {s: rate * w for s, w in open_.items()}
            break
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s]) for s in want)


def test_quality_base_counts(docs, rows):
    def of(r):
        t = r.text or ""
        w, seen, dup = SPACE.findall(t), set(), 0
        for line in t.split("\n"):
            if SPACE.search(line):
                dup += line in seen
                seen.add(line)
        grams, hit = [tuple(w[i:i + 8]) for i in range(len(w) - 7)], set()
        count = {}
        for g in grams:
            count[g] = count.get(g, 0) + 1
        for i, g in enumerate(grams):
            if count[g] > 1:
                hit |= set(range(i, i + 8))
        return r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)

    got = quality_rules.digest(docs).collect()
    same([tuple(r)[:7] for r in got], [of(r) for r in rows])
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_rules_keep_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.digest(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    junk = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.3 * len(junk)


def test_rare_languages_are_not_judged_by_others(spark, monkeypatch):
    """Clean documents of a language with few documents, and of one beyond MAX_LANGUAGES, stay."""
    rnd, rows = random.Random(2), []
    for lang, n in (("aa", 300), ("bb", 45), ("cc", 60)):
        words = [lang + "".join(rnd.choices("abcdefgh", k=3)) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rnd.choices(words, k=150)), lang, "s", 1) for i in range(n)]
    rows.append((999, " ".join(f"aaq{i}" for i in range(150)), "cc", "s", 1))
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(quality_rules, "MAX_LANGUAGES", 1)
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert [i for i, r in got.items() if not r.kept] == [999] and len(got) == len(rows)
    monkeypatch.setattr(quality_rules, "MAX_LANGUAGES", 1000)
    same(quality_rules.judge(docs).collect(), got.values())  # joined or shipped, the same verdicts


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.digest(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [(r.p_quality >= 0.5) == (r.quality == 1) for r in got]
    clean = [r.kept for r in got if r.quality == 1 and r.toxic == 0]
    toxic = [r.p_toxic >= 0.5 for r in got if r.toxic == 1 and r.quality == 1]
    assert sum(right) >= 0.93 * len(right) and sum(clean) >= 0.95 * len(clean) and sum(toxic) >= 0.6 * len(toxic)


def test_classifier_without_labels_and_odd_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_classifier.digest(docs, labels).collect()
    assert len(got) == docs.count() and {round(r.p_quality, 6) for r in got} == {0.5}


def test_preferences(spark):
    t = "pair_id long, turn long, role string, text string"
    chosen = spark.createDataFrame([(1, 0, "user", "hi <|x"), (1, 1, "assistant", "yo"), (2, 0, "user", "a"), (None, 0, None, None)], t)
    rejected = spark.createDataFrame([(1, 0, "user", "hi <|x"), (1, 1, "assistant", "no"), (3, 0, "user", "b")], t)
    got = {r.pair_id: r for r in preferences.format_pairs(chosen, rejected).collect()}
    one = got[1]
    assert one.prompt == "<|user|>\nhi < |x<|end|>\n" and one.n_prompt_turns == 1 and one.usable
    for side in ("chosen", "rejected"):
        (span,) = one[f"{side}_mask"]
        assert (one.prompt + one[side])[span.start:span.end] == ("yo" if side == "chosen" else "no") + "<|end|>\n"
    assert not got[2].usable and got[2].rejected == "" and got[3].chosen == "" and got[None].n_prompt_turns == 0


def test_passages_made_of_common_phrases(spark):
    """Every phrase stands in many unrelated texts, every passage in two."""
    rnd = random.Random(5)

    def filler(n):
        return " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))

    phrases = [filler(12) for _ in range(30)]
    texts = [" ".join(filler(30) + " " + p for p in rnd.sample(phrases, 3)) for _ in range(300)]
    for _ in range(60):
        passage = " ".join(rnd.sample(phrases, 6))
        texts += [f"{filler(60)} {passage} {filler(60)}" for _ in range(2)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(300, len(texts)))
    assert all(r.first_word <= 60 and r.first_word + r.n_words >= 132 for r in got)


@pytest.mark.parametrize("copies", [10, 40])
def test_every_near_copy_of_a_group_is_found(spark, monkeypatch, copies):
    """Copies with one word changed: many pairs are not similar enough, and each has a partner that is."""
    monkeypatch.setattr(substring_dedup, "CHUNK", 16, raising=False)
    rnd, texts, want = random.Random(11), [], set()

    def filler(n):
        return ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)]

    for _ in range(400 // copies):
        base, group = filler(60), []
        for _ in range(copies):
            passage = list(base)
            passage[rnd.randrange(60)] = "other" + filler(1)[0]
            group.append(passage)
        at = len(texts)
        for i, x in enumerate(group):
            if any(substring_dedup.verified(y, x) for j, y in enumerate(group) if j != i):
                want.add(at + i)
        texts += [filler(70) + x + filler(70) for x in group]
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    got = {r.doc_id for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= want and len(want - got) <= 0.01 * len(want)  # two of four hash functions must agree


def test_passages_are_whole():
    """Differences of any number and gaps that the similarity allows stay inside one passage."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    a = [word() for _ in range(100)]
    inserted = a[:40] + [word() for _ in range(8)] + a[40:]
    assert [x[:4] for x in substring_dedup.verified(a, inserted)] == [(0, 100, 0, 108)]
    long = [word() for _ in range(2000)]
    changed = [word() if i % 45 == 44 else w for i, w in enumerate(long)]
    around = [word() for _ in range(300)] + changed + [word() for _ in range(300)]
    assert [x[:4] for x in substring_dedup.verified(long, around)] == [(0, 1999 if 1999 % 45 == 44 else 2000, 300, 2300)]
    two = a + [word() for _ in range(90)] + long[:120]
    assert [x[:4] for x in substring_dedup.verified(a + [word() for _ in range(90)] + long[:120], two)] == [(0, 100, 0, 100), (190, 310, 190, 310)]
    assert substring_dedup.verified(a, [w if i % 4 else word() for i, w in enumerate(a)]) == []


def test_compact_windows():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(40):
        v = rng.integers(1, 40, rng.integers(0, 80)).astype(np.uint64)
        v[rng.random(len(v)) < 0.03] = 0
        width, want = int(rng.integers(2, 9)), set()
        for c in range(len(v)):
            left = right = c
            while left > 0 and v[left - 1] > v[c]:
                left -= 1
            while right + 1 < len(v) and v[right + 1] >= v[c]:
                right += 1
            if v[c] and right - left + 1 >= width:
                want.add((c, left, right))
        assert set(zip(*(x.tolist() for x in substring_dedup.compact_windows(v, width)))) == want


def test_repeated_passages(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [rnd.choices(words, k=rnd.randint(60, 500)) for _ in range(120)]
    planted, free = set(), rnd.sample(range(120), 120)
    for _ in range(15):
        passage = rnd.choices(words, k=rnd.randint(55, 120))
        for i in [free.pop() for _ in range(rnd.randint(2, 4))]:
            near = list(passage)
            if len(near) > 80:
                near[rnd.randrange(len(near))] = "other"
            at = rnd.randrange(len(texts[i]))
            texts[i][at:at] = near
            planted.add(i)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(500, " ".join(texts[0])), (501, None), (502, ""), (None, "x")]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == planted | {0, 500}
    assert all(r.n_words >= 50 and r.match_id != r.doc_id and r.similarity >= 0.8 for r in got)


EMPTY = {
    "license": lambda d, s: license_scan.digest(d), "sharding": lambda d, s: sharding.place(d, ["a", "b"], 7),
    "decontaminate": lambda d, s: decontaminate.digest(d, d.selectExpr("doc_id item_id", "text")),
    "secrets": lambda d, s: secret_scan.digest(d), "passages": lambda d, s: substring_dedup.repeated_passages(d),
    "simhash": lambda d, s: simhash.digest(d), "dedup": lambda d, s: simhash.deduplicate(d),
    "mix": lambda d, s: mixing.mix_table(d), "mixed": lambda d, s: mixing.mixed(d), "rules": lambda d, s: quality_rules.digest(d),
    "preferences": lambda d, s: preferences.digest(d.selectExpr("doc_id conv_id", "doc_id turn", "lang role", "text")),
    "classifier": lambda d, s: quality_classifier.digest(d, d.selectExpr("doc_id", "1 quality", "0 toxic")),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, name):
    assert EMPTY[name](spark.createDataFrame([], DOCS), spark).count() == 0


def test_places_left_out_before_verification_hold_no_passage():
    rng = random.Random(11)
    found = 0
    for trial in range(300):
        pool = [f"w{k}" for k in range(rng.choice([3, 40, 4000]))]
        a = [rng.choice(pool) for _ in range(rng.randint(50, 160))]
        b = [x if rng.random() > rng.choice([0.0, 0.01, 0.03, 0.1]) else rng.choice(pool) for x in a][rng.randint(0, 20):]
        sa, sb = substring_dedup._shingles(a, 5), substring_dedup._shingles(b, 5)
        passages = substring_dedup.verified(a, b)
        for x, y, spans in ((sa, sb, [p[:2] for p in passages]), (sb, sa, [p[2:4] for p in passages])):
            for start, end in spans:
                found += 1
                # Any place inside the passage: both sides' surplus isn't below zero.
                first, last = np.array([start + 1]), np.array([end - 6])
                own = substring_dedup._surplus(np.isin(x, y)[None], 46, 1.6 / 1.8, first, last)
                other = substring_dedup._surplus(np.isin(y, x)[None], 46, 1.6 / 1.8, np.array([len(y)]), np.array([-1]))
                assert own[0] + other[0] >= -1e-6
    assert found > 100


def _plain_passages(sa, sb, min_words, similarity, shingle):
    """One pair, place by place."""
    matched, last = [], None
    for j, s in enumerate(sb):
        at = [i for i, x in enumerate(sa) if x == s]
        if at:
            i = min(at, key=lambda x: (abs(x - (j if last is None else last + j)), x))
            last = i - j
            matched.append((j, i))
    gap = (1 - similarity) / similarity * min(len(sa), len(sb)) + shingle
    runs, out = [], []
    for j, i in matched:
        dj, di = (j - runs[-1][-1][-1][0], i - runs[-1][-1][-1][1]) if runs else (0, 0)
        if runs and (dj, di) == (1, 1):
            runs[-1][-1].append((j, i))
        elif runs and 0 < dj <= gap and 0 < di <= gap:
            runs[-1].append([(j, i)])
        else:
            runs.append([[(j, i)]])
    for pieces in runs:
        if sum(map(len, pieces)) < similarity * (min_words - shingle + 1) - 1e-9:
            continue
        at = 0
        while at < len(pieces):
            for last in reversed(range(at, len(pieces))):
                (b0, a0), (b1, a1) = pieces[at][0], (x + 1 for x in pieces[last][-1])
                shares = sum(map(len, pieces[at:last + 1]))
                if shares < similarity * (b1 - b0 + a1 - a0 - shares) - 1e-9 or min(b1 - b0, a1 - a0) + shingle - 1 < min_words:
                    continue
                x, y = set(sa[a0:a1]), set(sb[b0:b1])
                if len(x & y) / len(x | y) >= similarity:
                    out.append((a0, a1 + shingle - 1, b0, b1 + shingle - 1, len(x & y) / len(x | y)))
                    at = last
                    break
            at += 1
    return out


def test_pairs_verified_together_have_the_passages_of_each(monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 40)  # several blocks of pieces in a run
    rng, pairs = random.Random(23), []
    for trial in range(200):
        pool = [f"w{k}" for k in range(rng.choice([3, 40, 400, 4000]))]
        a, rate = [rng.choice(pool) for _ in range(rng.randint(0, 200))], rng.choice([0, 0.01, 0.03, 0.1])
        b = [x if rng.random() > rate else rng.choice(pool) for x in a][rng.randint(0, 20):]
        pairs.append((a + a[:70] if trial % 3 else a, b + b[:70] if trial % 5 == 0 else b))
    hashed = [tuple(substring_dedup._shingles(x, 5) for x in pair) for pair in pairs]
    got = [x for k in range(0, 200, 8) for x in substring_dedup._passages(hashed[k:k + 8], 50, 0.8, 5)]
    assert got == [_plain_passages(x.tolist(), y.tolist(), 50, 0.8, 5) for x, y in hashed]
    assert sum(map(len, got)) > 50


def test_repeated_lines_are_not_looked_up_place_by_place(monkeypatch):
    looked, real = [], substring_dedup._nearest
    monkeypatch.setattr(substring_dedup, "_nearest", lambda *a: looked.append(1) or real(*a))
    line = [f"w{k}" for k in range(12)]
    text = [f"x{k}" for k in range(60)] + line * 200
    assert [x[:4] for x in substring_dedup.verified(text, text)] == [(0, len(text), 0, len(text))]
    assert len(looked) < 10


def test_windows_meet_after_one_shuffle(spark):
    rnd = random.Random(7)
    passage = [f"p{k}" for k in range(90)]
    texts = [[f"u{rnd.randrange(10 ** 6)}" for _ in range(80)] + (passage if i % 3 == 0 else []) for i in range(12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(0, " ".join(texts[0])), (50, "short")]
    frame = spark.createDataFrame(rows, "tid long, text string")
    met = substring_dedup.meetings(substring_dedup.windows(frame))
    assert met._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1
    got = met.collect()
    assert {(r.tid, r.c) for r in got if r.kind == 2} == {(i, len(t)) for i, t in enumerate(texts)}
    found = [(r.x, r.tid, r.c) for r in got if r.kind == 0]
    assert len(set(found)) == len(found) and {x[1] for x in found} == {0, 3, 6, 9}
    assert all(len({t for s, t, _ in found if s == sig}) > 1 for sig, _, _ in found)
    assert {frozenset((r.x, r.tid)) for r in got if r.kind == 1} >= {frozenset((0, k)) for k in (3, 6, 9)}


def test_texts_are_sent_once_to_be_compared(spark, monkeypatch):
    """Open places of the same texts under many keys: their words are sent together, not key by key."""
    rnd, sent, real = random.Random(29), [], substring_dedup._compare
    monkeypatch.setattr(substring_dedup, "_compare", lambda rows, *a: sent.append(rows) or real(rows, *a))
    base = [f"b{k}" for k in range(500)]
    texts = [[w if rnd.random() > 0.04 else f"x{rnd.randrange(10 ** 6)}" for w in base] for _ in range(20)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(20))
    words = sum(len(r.w.split(" ")) for r in sent[0].select("w").collect())
    assert 0 < words <= 4 * 20 * 500  # every key's cut by itself: several times that


def test_comparison_leaves_out_no_words():
    """Every two stretches of a group verified, or only those that can add words: the same words are covered."""
    rng, covered = random.Random(31), 0
    for trial in range(60):
        pool = [f"w{k}" for k in range(60 if trial % 4 == 0 else 10 ** 6)]
        base = [rng.choice(pool) for _ in range(rng.randint(60, 260))]
        rate = rng.choice([0.0, 0.02, 0.04, 0.08])
        texts = [[w if rng.random() > rate else rng.choice(pool) for w in base][rng.randint(0, 30):] for _ in range(rng.randint(2, 7))]
        if trial % 3 == 0:
            texts = [t[len(t) // 2:] + t[:len(t) // 2] if rng.random() < 0.5 else t for t in texts]
        hashes = [substring_dedup._shingles(t, 5) for t in texts]
        rows = [{"tid": k, "chunk": 0, "alo": 0, "keys": [1], "lo": [20], "hi": [25], "open": [True], "start": [], "end": []} for k in range(len(texts))]
        got, want = ([set() for _ in texts] for _ in range(2))
        for tid, start, end, other, score in substring_dedup._compared(rows, hashes, 50, 0.8, 5):
            assert end - start >= 50 and score >= 0.8 and other != tid
            got[tid].update(range(start, end))
        for i in range(len(texts)):
            for j in range(i):
                for a0, a1, b0, b1, _ in substring_dedup._passages([(hashes[j], hashes[i])], 50, 0.8, 5, True)[0]:
                    want[j].update(range(a0, a1))
                    want[i].update(range(b0, b1))
        assert all(x >= y for x, y in zip(got, want)) and (trial % 4 == 0 or got == want)
        covered += sum(map(len, want))
        for (a, b) in zip(hashes, hashes[1:]):  # passages that may overlap hold those that may not
            every = substring_dedup._passages([(a, b)], 50, 0.8, 5, True)[0]
            assert all(any(x[0] <= y[0] and y[1] <= x[1] for x in every) for y in substring_dedup._passages([(a, b)], 50, 0.8, 5)[0])
    assert covered > 5000
