"""SimHash near-duplicates with pivot distance tables.

Fingerprints are made in Arrow batches (free style). Distinct fingerprints, not
documents, are linked: exact copies cost one row.

Every fingerprint has a table of Hamming distances to 33 reference fingerprints: zero
and, for each of the 32 cells of two bits, the cell's mask. Distances obey the
triangle inequality, so two fingerprints within ``max_bits`` differ by at most that
much in every coordinate. Against random references the 64-bit distances crowd
around 32 and a coordinate keeps about half of all pairs; these references were
chosen because differences of their coordinates (the bits set in each cell) differ in
at most ``max_bits`` cells. Cut into ``max_bits + 3`` groups of cells, two close
fingerprints agree in at least three whole groups: each choice of three groups is an
equality key, and fingerprints meet through shared keys. Inside a key, pairs with a
coordinate difference over ``max_bits`` are discarded and survivors verified bit by
bit.

Keys held by one fingerprint go before anything else. A key with more than ``BLOCK``
fingerprints is split by hash into chunks and its pairs of chunks are separate groups,
so no task sees more than two chunks of a key; from each group comes a spanning
forest of its links (fewer rows than members), never its pairs. Components are found
by alternating star steps on written edges in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.llm._text import fresh, materialized, whole

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1024
CELLS = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a text (0 without words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        flat, at, ends = b" ".join(words), 0, []
        for w in words:
            at += len(w)
            ends.append(at)
            at += 1
        starts = [0] + [e + 1 for e in ends[:-1]]
        digest, view = xxhash.xxh64_intdigest, memoryview(flat)
        hashes = [digest(view[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    n, counts = len(hashes), np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for i in range(0, n, 65536):  # bounded memory for very long texts
        bits = np.unpackbits(values[i:i + 65536].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in range(64) if 2 * counts[b] > n))


def fingerprints(docs: DataFrame, columns: dict[str, str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``columns`` (SQL expression by name) of every document and its fingerprint ``fp``
    (as a signed long)."""
    slim = docs.select(*(F.expr(e).alias(n) for n, e in columns.items()), whole(F.col(text)).alias("text_"))
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names))
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))),
                                              pa.array(values.view(np.int64))], names=[*names, "fp"])

    schema = slim.drop("text_").schema.add("fp", "long")
    return slim.mapInArrow(run, schema)


def pivot_coordinates(fps: np.ndarray) -> np.ndarray:
    """Distances of fingerprints (uint64) to zero and to the mask of each cell."""
    pivots = np.array([0] + [3 << (2 * c) for c in range(CELLS)], dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)


def _keys(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Equality keys, one column per choice of groups of cells: the bits set in each
    cell of those groups, read off the distance table."""
    d = pivot_coordinates(fps)
    set_bits = ((d[:, :1] + 2 - d[:, 1:]) // 2).astype(np.int64)  # 0, 1 or 2 in each cell
    groups = np.array_split(np.arange(CELLS), max_bits + 3)
    keys = []
    for number, chosen in enumerate(combinations(range(len(groups)), 3)):
        key = np.full(len(fps), number, np.int64)
        for cell in np.concatenate([groups[g] for g in chosen]):
            key = key * 3 + set_bits[:, cell]
        keys.append(key)
    return np.stack(keys, axis=1) if len(fps) else np.zeros((0, 1), np.int64)


def keyed(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): every distinct fingerprint under each of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0))
            for i in range(0, len(values), 4096):
                part = values[i:i + 4096]
                keys = _keys(part.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(part, keys.shape[1]))], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _forest(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal ``group`` as (member, least member of its part)."""
    label = np.arange(len(fps))
    table = pivot_coordinates(fps)
    left, right = [], []
    at, step = np.arange(len(fps)), 0
    while len(at):
        step += 1
        at = at[at + step < len(fps)]
        at = at[group[at] == group[at + step]]
        for i in range(0, len(at), 65536):
            a = at[i:i + 65536]
            near = np.abs(table[a] - table[a + step]).max(axis=1) <= max_bits
            a = a[near]
            a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= max_bits]
            left.append(a)
            right.append(a + step)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    while True:  # least position of each part, by repeated minima over the links
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.nonzero(label != np.arange(len(fps)))[0]
    return linked, label[linked]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(src, dst): edges whose components are those of all links between distinct ``fp``."""
    members = keyed(fps, max_bits)
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = members.join(shared, "key").withColumn("chunks", chunks)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    rows = rows.select("key", "fp", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    rows = rows.select(F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("grp"), "fp")
    rows = rows.repartition("grp").sortWithinPartitions("grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def emit(group: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = _forest(group, fp.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["src", "dst"])

        for batch in batches:
            group = np.concatenate([group, np.asarray(batch.column(0))])
            fp = np.concatenate([fp, np.asarray(batch.column(1))])
            whole_until = int(np.searchsorted(group, group[-1])) if len(group) else 0  # the last run may go on
            if whole_until:
                yield emit(group[:whole_until], fp[:whole_until])
                group, fp = group[whole_until:], fp[whole_until:]
        yield emit(group, fp)

    return rows.mapInArrow(run, "src long, dst long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the least node of the component of every node that has an edge.

    Alternating large-star and small-star steps; each round is written to the shared
    folder, and it ends when the edges stay the same (count and sum of hashes).
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst") % 1_000_003)).first())

    def star(e: DataFrame, both: bool) -> DataFrame:
        """Neighbours of a node (of both directions, or the smaller ones) to their least."""
        pairs = e.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        if both:
            pairs = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        moved = pairs.join(least, "u")
        if both:
            out = moved.where("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        else:
            own = least.where("m != u").select(F.col("u").alias("src"), F.col("m").alias("dst"))
            out = moved.where("v != m").select(F.col("v").alias("src"), F.col("m").alias("dst")).unionByName(own)
        return out.where("src != dst").distinct()

    edges = materialized(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                         .where("src != dst"), name)
    before = state(edges)
    while before[0]:
        edges = materialized(star(materialized(star(edges, True), name), False), name)
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every document: one row per row of
    ``docs``; ``root`` is the component's least fingerprint.

    component_id is the smallest id reachable over links of at most ``max_bits`` bits
    (null only if no document of the component has an id). Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows share a component;
    an empty table gives no rows.
    """
    slim = materialized(fingerprints(docs, {"doc_id": f"`{doc_id}`", "text_hash": f"xxhash64(`{text}`)"},
                                     text, shingle), "simhash_fingerprints")
    classes = materialized(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_classes")
    roots = components(links(classes, max_bits), "simhash_components")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = materialized(rooted.join(smallest, "root").select("fp", "root", "component_id"), "simhash_labels")
    return slim.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return cluster(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, of
    several rows with that id the one with the smallest text hash, one of equal rows.
    """
    found = cluster(docs, doc_id, text, **options)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    winners = found.groupBy("root").agg(F.min(first).alias("w")).select(
        F.col("w.doc_id").alias("w_id"), F.col("w.text_hash").alias("w_hash"))
    w_id, w_hash = fresh(docs, "w_id", "w_hash")
    winners = materialized(winners.toDF(w_id, w_hash), "simhash_winners")
    kept = docs.join(winners, F.col(doc_id).eqNullSafe(F.col(w_id)) & (F.xxhash64(F.col(text)) == F.col(w_hash)))
    return kept.dropDuplicates([doc_id, w_hash]).drop(w_id, w_hash)
