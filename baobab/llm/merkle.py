"""Merkle manifest: a three-way hash tree per source, one over the sources' roots,
and for every document the siblings that prove it.

A document's rank in its source is written in base 3. Inside a block of 3^DEPTH
consecutive ranks the digit columns are grouped away one after another, the last
first: each step turns up to three nodes into their parent, whose struct holds them
as children. What remains of a block is one row, its root with the whole subtree
nested below it. Block roots are ranked nodes themselves, so the same step carries on
above them until one node a source is left, and once more over the sources. On the way
down a transform over the nested children gives each its left and right siblings, and
an explode emits them; inside a block nothing is joined. Between two heights of blocks
the proof of a block root (one row for 3^DEPTH leaves) meets its block by a join, since
nesting a whole source in one row would have no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm._text import materialized
from baobab.llm.ranks import ranked

FAN = 3
DEPTH = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return digest_of(F.concat(*(field(f) for f in fields)))


def _nodes(total: Column, level: int) -> Column:
    """Nodes that a tree over ``total`` leaves has at a level: ceil(total / 3^level)."""
    step = FAN ** level
    return F.floor((total + (step - 1)) / F.lit(step)) if step > 1 else total


def _nest(nodes: DataFrame) -> DataFrame:
    """(key, block, total, h, kids): the blocks of ``nodes`` (key, i, total, h, item).

    A level that has one node in its whole group is passed on unhashed: the tree ends
    there, and blocks of a group with more than one block are full height.
    """
    digits = {f"d{j}": (F.floor(F.col("i") / F.lit(FAN ** j)) % FAN).cast("int") for j in range(DEPTH)}
    level = (nodes.withColumn("block", F.floor(F.col("i") / F.lit(FAN ** DEPTH))).withColumns(digits)
             .select("key", "block", "total", *digits, F.struct("h", "item").alias("node")).repartition("key", "block"))
    for j in range(DEPTH):
        above = [f"d{x}" for x in range(j + 1, DEPTH)]
        kids = F.transform(F.array_sort(F.collect_list(F.struct(F.col(f"d{j}").alias("d"), "node"))), lambda k: k["node"])
        level = level.groupBy("key", "block", "total", *above).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda k: k["h"]), "")
        h = F.when(_nodes(F.col("total"), j) > 1, digest_of(joined)).otherwise(F.get("kids", F.lit(0))["h"])
        level = level.select("key", "block", "total", *above, F.struct(h.alias("h"), "kids").alias("node"))
    return level.select("key", "block", "total", "node.h", "node.kids")


def _unfold(kids: Column, level: int, total: Column, above: Column) -> Column:
    """Array of (h, item, path) of the leaves below ``kids``; ``path`` has a (left, right)
    pair for each hashing step, from the leaf upwards."""
    def hashes(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda k: k["h"]), "")

    def of(kid: Column, at: Column) -> Column:
        step = F.struct(hashes(F.slice(kids, F.lit(1), at)).alias("left"),
                        hashes(F.slice(kids, at + 2, F.lit(FAN))).alias("right"))
        path = F.when(_nodes(total, level) > 1, F.concat(F.array(step), above)).otherwise(above)
        if level == 0:
            return F.struct(kid["h"].alias("h"), kid["item"].alias("item"), path.alias("path"))
        return _unfold(kid["kids"], level - 1, total, path)

    found = F.transform(kids, of)
    return found if level == 0 else F.flatten(found)


def _heights(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots and so on, up to one block a group."""
    heights = [_nest(nodes)]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > FAN ** DEPTH:
        roots = materialized(heights[-1].select("key", F.col("block").alias("i"), _nodes(F.col("total"), DEPTH).alias("total"), "h"),
                             "merkle")
        heights.append(_nest(roots.withColumn("item", F.col("i"))))
        most = -(-most // FAN ** DEPTH)
    return heights


def _descend(heights: list[DataFrame], top: DataFrame | None = None) -> DataFrame:
    """(key, h, item, path, and the further columns of ``top``) of every leaf, from the
    ``path`` of every group in ``top`` (t_key, path, further columns). Without ``top`` a
    group's root is the end of all paths, and the further column ``root``."""
    more = [c for c in top.columns if c not in ("t_key", "path")] if top is not None else ["root"]
    above, rows = top.withColumn("t_block", F.lit(0).cast("bigint")) if top is not None else None, None
    for blocks in reversed(heights):
        if above is None:
            met = blocks.withColumns({"path": F.array().cast("array<struct<left:string,right:string>>"), "root": F.col("h")})
        else:
            met = blocks.join(above, (blocks["key"] == above["t_key"]) & (blocks["block"] == above["t_block"]))
        rows = (met.select("key", *more, F.explode(_unfold(F.col("kids"), DEPTH - 1, F.col("total"), F.col("path"))).alias("leaf"))
                .select("key", *more, "leaf.*"))
        above = rows.select(F.col("key").alias("t_key"), F.col("item").alias("t_block"), "path", *more) if blocks is not heights[0] else None
    return rows


def proofs(leaves: DataFrame, leaf: str, source: str, order: list[str]) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``: for every hashing step from the
    leaf to the root, the hashes joined left and right of it.

    Leaves of a source stand in the order of ``order``, then by hash, so repeated rows
    and equal ids have a defined place; nulls come first and a null source is one of its
    own. An empty table has no root and gives no rows. Any other columns are kept; those
    named as the new ones are replaced.
    """
    columns = [c for c in leaves.columns if c.lower() not in ("subroot", "root", "path")]
    rows = ranked(leaves.select(F.struct(F.col(f"`{source}`").alias("source")).alias("key"), F.col(f"`{leaf}`").alias("h"),
                                F.struct(*(F.col(f"`{c}`") for c in columns)).alias("item"),
                                *(F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order))),
                  ["key"], [*(f"o{k}" for k in range(len(order))), "h"], "i")
    trees = _heights(rows.select("key", "i", "total", "h", "item"))
    subroots = ranked(trees[-1].select(F.col("key").alias("item"), "h"), [], ["item"], "i")
    roots = _heights(subroots.select(F.struct(F.lit(0).alias("all")).alias("key"), "i", "total", "h", "item"))
    top = _descend(roots).select(F.col("item").alias("t_key"), "path", F.col("h").alias("subroot"), "root")
    return _descend(trees, top).select("item.*", "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf hash and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest_of(F.concat(s["left"], h, s["right"])))


def proof_hash(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest_of(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its newlines where 2 divides the CRC-32 of the decimal id, the
    text as it is elsewhere (and where the id is null)."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """Proof of every row of ``documents``, and what it proves after the tampering.

    Nulls are ``-`` in a leaf, apart from empty values; a null id is not tampered with.
    Very long texts are hashed where they are read and never moved. Repeated rows are
    leaves of their own. Columns beyond those of ``documents`` are ignored.
    """
    fields = [F.col(c) for c in FIELDS[:-1]]
    leaves = docs.select("doc_id", "source", leaf_hash([*fields, F.col("text")]).alias("leaf"),
                         leaf_hash([*fields, tampered(F.col("doc_id"), F.col("text"))]).alias("now"))
    found = proofs(leaves, "leaf", "source", ["doc_id"])
    return (found.withColumn("folded_root", fold(F.col("now"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
