"""Hard negatives by exact integer scores, tile by tile.

Anchors are taken in blocks of bounded bytes. A block goes to every task, and a task
multiplies it with tile after tile of the candidates it reads, by Strassen's recursion
on int64 tiles padded with zeros: seven products of half the size in place of eight,
only additions and multiplications of integers. Those wrap modulo 2^64, so a score that
fits a long is exact whatever its intermediate sums. Of every tile the best positives of
each anchor enter a heap of the task, and the heaps of all tasks merge into the anchor's
positives. These fix a window of scores for each (anchor, positive), and a second pass
keeps the best candidates inside each window the same way. No task or row ever holds
more than the heaps of a block; candidates never move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baobab.llm.ranks import ranked
from baobab.session import scratch_path

BLOCK_BYTES = 4 * 2 ** 20
TILE_ROWS = 2048
CUTOFF = 32
POSITIVES = 5
NEGATIVES = 10
SCALE = 256
LOW, HIGH = 30, 90  # a negative scores 30 % to 90 % of the positive
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2^64."""
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= cutoff:
        return a @ b
    hm, hd, hn = -(-m // 2), -(-d // 2), -(-n // 2)
    p, q = np.zeros((2 * hm, 2 * hd), np.int64), np.zeros((2 * hd, 2 * hn), np.int64)
    p[:m, :d], q[:d, :n] = a, b
    p11, p12, p21, p22 = p[:hm, :hd], p[:hm, hd:], p[hm:, :hd], p[hm:, hd:]
    q11, q12, q21, q22 = q[:hd, :hn], q[:hd, hn:], q[hd:, :hn], q[hd:, hn:]
    # The seven products, each added to the quadrants that it belongs to.
    out = np.zeros((2 * hm, 2 * hn), np.int64)
    c11, c12, c21, c22 = out[:hm, :hn], out[:hm, hn:], out[hm:, :hn], out[hm:, hn:]
    for left, right, plus, minus in (
            (p11 + p22, q11 + q22, (c11, c22), ()), (p21 + p22, q11, (c21,), (c22,)), (p11, q12 - q22, (c12, c22), ()),
            (p22, q21 - q11, (c11, c21), ()), (p11 + p12, q22, (c12,), (c11,)), (p21 - p11, q11 + q12, (c22,), ()),
            (p12 - p22, q21 + q22, (c11,), ())):
        product = strassen(left, right, cutoff)
        for c in plus:
            c += product
        for c in minus:
            c -= product
    return out[:m, :n]


def to_integers(vectors: pa.Array) -> np.ndarray:
    """floor(256 x) of every component modulo 2^64, shorter vectors padded with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    big = np.abs(scaled) >= 2.0 ** 63
    whole = np.where(big, 0.0, scaled).astype(np.int64)
    # Beyond a long a component is an integer, so the remainder is exact.
    for k in np.flatnonzero(big):
        whole[k] = np.uint64(int(values[k]) * SCALE % 2 ** 64).astype(np.int64)
    width = int(lengths.max(initial=0))
    if len(lengths) and (lengths == width).all():
        return whole.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1], 1)
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (a, b))


class Heaps:
    """The best ``k`` (score, id) of each of ``rows`` rows: higher scores first, ties by
    smaller id, null ids last. Heaps merge by offering one's content to the other."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.score = np.zeros((rows, k), np.int64)
        self.id = np.zeros((rows, k), np.int64)
        self.kind = np.full((rows, k), 2, np.int8)  # 0: with id, 1: without, 2: empty place

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, allowed: np.ndarray) -> None:
        """Candidates (columns), in order of id with null ids last, where ``allowed``."""
        k, (rows, n) = self.k, scores.shape
        if not n or not allowed.any():
            return
        # Nothing below a full heap's last score can enter it, so most tiles offer few.
        full = self.kind[:, -1] < 2
        allowed = allowed & ~(full[:, None] & (scores < self.score[:, -1:]))
        row, col = np.nonzero(allowed)
        if not len(row):
            return
        value = scores[row, col]
        by = np.lexsort((col, -value.astype(object) if (value == _NONE).any() else -value, row))
        row, col, value = row[by], col[by], value[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        row, col, value, place = row[keep], col[keep], value[keep], place[keep]
        score, ident, kind = (np.zeros((rows, k), x.dtype) for x in (self.score, self.id, self.kind))
        kind += 2
        score[row, place], ident[row, place], kind[row, place] = value, ids[col], nulls[col]
        score, ident, kind = (np.concatenate(x, axis=1) for x in ((self.score, score), (self.id, ident), (self.kind, kind)))
        touched = np.unique(row)
        self._cut(touched, score[touched], ident[touched], kind[touched])

    def _cut(self, rows: np.ndarray, score: np.ndarray, ident: np.ndarray, kind: np.ndarray) -> None:
        # Three stable sorts, the least significant key first; ~score reverses the order without overflow.
        by = np.argsort(ident, axis=1, kind="stable")
        for key in (kind, ~score, kind == 2):
            by = np.take_along_axis(by, np.argsort(np.take_along_axis(key, by, 1), axis=1, kind="stable"), 1)
        by = by[:, :self.k]
        self.score[rows], self.id[rows], self.kind[rows] = (np.take_along_axis(x, by, 1) for x in (score, ident, kind))


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, null flags, labels, vectors) of at most TILE_ROWS candidates in order of id."""
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_ROWS):
            tile = batch.slice(start, TILE_ROWS)
            nulls = tile.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = tile.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            by = np.lexsort((ids, nulls))
            labels = tile.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            yield ids[by], nulls[by].astype(np.int8), labels[by], to_integers(tile.column(2))[by]


def _emit(heaps: list[Heaps]) -> Iterator[pa.RecordBatch]:
    for j, heap in enumerate(heaps):
        row, place = np.nonzero(heap.kind < 2)
        kind = heap.kind[row, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int64)), pa.array(np.full(len(row), j, np.int32)),
             pa.array(heap.id[row, place], mask=kind == 1), pa.array(heap.score[row, place])], ["anchor", "j", "id", "score"])


_FOUND = "anchor long, j int, id long, score long"


def _positives(anchors: dict):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = Heaps(len(anchors["ids"]), POSITIVES)
        for ids, nulls, labels, vectors in _tiles(batches):
            a, b = _same_width(anchors["vectors"], vectors)
            other = (anchors["ids"][:, None] != ids[None, :]) | (nulls[None, :] == 1)
            heap.offer(strassen(a, b.T), ids, nulls, other & (anchors["labels"][:, None] == labels[None, :]))
        yield from _emit([heap])
    return run


def _negatives(anchors: dict, low: np.ndarray, high: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heaps(len(anchors["ids"]), NEGATIVES) for _ in range(low.shape[1])]
        for ids, nulls, labels, vectors in _tiles(batches):
            a, b = _same_width(anchors["vectors"], vectors)
            scores = strassen(a, b.T)
            differs = anchors["labels"][:, None] != labels[None, :]
            for j, heap in enumerate(heaps):
                heap.offer(scores, ids, nulls, differs & (scores >= low[:, j:j + 1]) & (scores <= high[:, j:j + 1]))
        yield from _emit(heaps)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The heaps of all tasks merged: the best ``k`` of each (anchor, j)."""
    order = Window.partitionBy("anchor", "j").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def windows(positives: list, rows: int) -> tuple[np.ndarray, np.ndarray, dict]:
    """Score windows [low, high] of each (anchor, place of its positive); empty where there is none."""
    low, high = np.full((rows, POSITIVES), 1, np.int64), np.zeros((rows, POSITIVES), np.int64)
    lowest, highest = _NONE, np.iinfo(np.int64).max
    for r in positives:
        a, b = -(-LOW * r["score"] // 100), HIGH * r["score"] // 100
        if a <= b:
            low[r["anchor"], r["rank"] - 1], high[r["anchor"], r["rank"] - 1] = max(a, lowest), min(b, highest)
    return low, high


def valid(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null label, a null vector or a null or non-finite component take no part;
    those with a null id do, after all others in a tie. Vectors are compared as far as the
    shorter one goes. Repeated rows count each: a repeated anchor gives its rows again, and
    rows with the anchor's own id are none of its positives. Further columns are ignored,
    an empty table gives no rows. Anchors are gathered on the driver block by block, each
    of at most ``block_bytes`` (one anchor at least), never all of them.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
                       F.col(f"`{vector}`").alias("vector"), is_anchor.alias("is_anchor"))
    rows = rows.where(F.col("label").isNotNull() & valid(F.col("vector")))
    candidates = rows.select("id", "label", "vector")
    anchors = ranked(rows.where("is_anchor").select("id", "label", "vector"), [], ["id"], "at")
    size = anchors.agg(F.max("total").alias("n"), F.max(F.size("vector")).alias("width")).first()
    many = max(1, block_bytes // (8 * max(1, size["width"] or 1)))
    path = scratch_path(spark, "hard_negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for start in range(0, size["n"] or 0, many):
        block = anchors.where((F.col("at") >= start) & (F.col("at") < start + many)).orderBy("at").toArrow()
        known = {"ids": block["id"].to_numpy(), "labels": block["label"].to_numpy(), "vectors": to_integers(block["vector"])}
        positives = _best(candidates.mapInArrow(_positives(known), _FOUND), POSITIVES).collect()
        low, high = windows(positives, len(known["ids"]))
        found = _best(candidates.mapInArrow(_negatives(known, low, high), _FOUND), NEGATIVES)
        pairs = pa.table({"p_anchor": [r["anchor"] for r in positives], "p_j": pa.array([r["rank"] - 1 for r in positives], pa.int32()),
                          "anchor_id": [int(known["ids"][r["anchor"]]) for r in positives],
                          "positive_id": pa.array([r["id"] for r in positives], pa.int64()),
                          "positive_score": [r["score"] for r in positives]}) if positives else None
        if pairs is None:
            continue
        told = spark.createDataFrame(pairs)
        (found.join(told, (F.col("anchor") == F.col("p_anchor")) & (F.col("j") == F.col("p_j")))
         .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(path))
    return spark.read.schema(schema).parquet(path)


def digest(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings``: anchors have an id divisible by 100, rows with one
    divisible by 7 have their label moved on."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(embeddings.select("vec_id", moved.alias("label"), "embedding"), F.coalesce(vec_id % 100 == 0, F.lit(False)))
