"""Homomorphic multiset hash of a document's paragraphs.

Every paragraph (line) is hashed to a vector of LANES numbers modulo 2^32, and a text's
fingerprint is the lane-wise sum over its paragraphs. The sum doesn't depend on their
order, equal multisets of paragraphs have equal fingerprints, and a paragraph is
inserted or deleted by adding or subtracting its vector (:func:`combine`). The lanes:

* EQUAL lanes drawn from the paragraph's SHA-256: they tell texts apart;
* one lane with the paragraph's number of shingles (SHINGLE consecutive words);
* SIGNS lanes with the number of shingles whose hash has that bit set. Twice the count
  less the number of shingles is a sum of random signs, so the product of two
  fingerprints estimates how many shingles they share: :func:`likeness`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baobab.llm._text import bound, positions, whole
from baobab.llm.ranks import ranked

MODULUS = 2 ** 32
EQUAL = 16
SIGNS = 128
LANES = EQUAL + 1 + SIGNS
SHINGLE = 3
BLOCK = 512
PARAGRAPH = "\n"
GAP = r"[\x20\x09-\x0D]+"
CHUNK = 2 ** 7 - 1  # the topmost of eight counts in a long must not reach its sign
_EIGHTHS = sum(1 << 8 * k for k in range(8))


def paragraphs(text: Column) -> Column:
    return F.split(whole(text), PARAGRAPH)


def shingles(text: Column) -> Column:
    """Hashes of the runs of SHINGLE words inside each paragraph; a shorter paragraph is
    one run, one without words has none."""
    words = F.transform(paragraphs(text), lambda p: F.array_remove(F.split(p, GAP), ""))

    def of(w: Column) -> Column:
        at = F.when(F.size(w) >= SHINGLE, positions(F.size(w), SHINGLE)).otherwise(positions(F.least(F.size(w), F.lit(1))))
        return F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(SHINGLE))))

    return F.flatten(F.transform(words, of))


def equal_lanes(text: Column) -> Column:
    """Sum of the paragraphs' EQUAL lanes, as an array of longs below 2^32."""
    def vector(p: Column) -> Column:
        longs = [F.xxhash64(F.lit(i), p) for i in range(EQUAL // 2)]
        halves = [h for x in longs for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(MODULUS - 1)))]
        return F.array(*halves)

    hashed = F.transform(paragraphs(text), lambda p: F.sha2(p.cast("binary"), 256))
    return _sum(F.transform(hashed, vector), EQUAL)


def _zeros(n: int) -> Column:
    return F.array(*[F.lit(0).cast("bigint")] * n)


def _sum(vectors: Column, n: int) -> Column:
    return F.aggregate(vectors, _zeros(n), lambda a, v: F.zip_with(a, v, lambda x, y: (x + y) % F.lit(MODULUS)))


def _bit_counts(hashes: Column) -> Column:
    """How many of ``hashes`` (CHUNK at most) have each bit set: 64 longs."""
    # Eight bits a long, 8 places apart, so that 8 additions count all 64 bits.
    packed = F.aggregate(hashes, _zeros(8), lambda a, h: F.array(
        *[F.get(a, F.lit(j)) + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_EIGHTHS)) for j in range(8)]))

    def eighth(p: Column, k: int) -> Column:
        return F.transform(p, lambda x: F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(CHUNK)))

    return bound(packed, lambda p: F.concat(*(eighth(p, k) for k in range(8))))


def _all_bit_counts(hashes: Column) -> Column:
    chunks = F.transform(positions(F.ceil(F.size(hashes) / CHUNK).cast("int")), lambda c: _bit_counts(F.slice(hashes, c * CHUNK + 1, F.lit(CHUNK))))
    return _sum(chunks, 64)


def lanes(text: Column) -> Column:
    """The LANES lanes of a whole text, as longs below 2^32. Null counts as empty, which
    is one empty paragraph."""
    def further(hashes: Column, k: int) -> Column:
        return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k)))

    def counts(hashes: Column) -> Column:
        return F.concat(F.array(F.size(hashes).cast("bigint") % F.lit(MODULUS)), _all_bit_counts(hashes),
                        *(bound(further(hashes, k), _all_bit_counts) for k in range(1, SIGNS // 64)))

    return F.concat(equal_lanes(text), bound(shingles(text), counts))


def as_text(lanes: Column) -> Column:
    """Lanes as a string of 8 hex digits each."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def lanes_of(fingerprint: Column) -> Column:
    """The lanes of a fingerprint as longs."""
    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)),
                       lambda i: F.conv(F.substring(fingerprint, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint"))


def combine(lanes: Column, other: Column, sign: int = 1) -> Column:
    """Lanes after inserting (``sign`` 1) or deleting (-1) the paragraphs of ``other``."""
    return F.zip_with(lanes, other, lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))


def signs(lanes: Column) -> Column:
    """The signed sums behind the counting lanes."""
    return F.transform(F.slice(lanes, EQUAL + 2, SIGNS), lambda c: (2 * c - F.get(lanes, F.lit(EQUAL))).cast("double"))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Estimated share of common shingles from the signed sums of two fingerprints,
    2 ab / (aa + bb): 1 for equal fingerprints, about 0 where nothing is shared."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    both = dot(a, a) + dot(b, b)
    share = F.when(both > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * dot(a, b) / both))).otherwise(F.lit(0.0))
    return F.when(equal, F.lit(1.0)).otherwise(share)


def neighbours(docs: DataFrame, doc_id: str, text: str, block: int = BLOCK) -> DataFrame:
    """(block, at, extra, doc_id, copies, text): the documents in order of id, dealt into
    blocks of consecutive ones, each with the first document of the next block as an
    extra row at its end (after the last comes the first).

    Rows equal in id and text are one document with a number of copies. Ranks are found
    on keys alone; texts move twice: to their copies, and to their block.
    """
    # One string is both the grouping and the join key, so the join finds the texts where
    # the grouping has put them.
    text_of, id_of = whole(F.col(f"`{text}`")), F.col(f"`{doc_id}`")
    rows = docs.select(F.concat(F.coalesce(id_of.cast("string"), F.lit("-")), F.lit(":"), F.md5(text_of)).alias("own"),
                       id_of.alias("id"), text_of.alias("t"))
    single = rows.groupBy("own").agg(F.any_value("t").alias("t"), F.count(F.lit(1)).alias("copies"))
    keys = rows.groupBy("own").agg(F.max("id").alias("id")).withColumnRenamed("own", "pair")
    placed = single.join(ranked(keys, [], ["id", "pair"], "at"), F.col("own") == F.col("pair"))
    here = F.struct(F.floor(F.col("at") / block).alias("block"), F.col("at").alias("at"), F.lit(False).alias("extra"))
    last = F.pmod(F.col("at") - 1, F.col("total"))
    before = F.struct(F.floor(last / block).alias("block"), (last + 1).alias("at"), F.lit(True).alias("extra"))
    both = F.when((F.col("at") % block == 0), F.array(here, before)).otherwise(F.array(here))
    return (placed.select(F.explode(both).alias("where"), "id", "copies", "t")
            .select("where.block", "where.at", "where.extra", F.col("id").alias("doc_id"), "copies", F.col("t").alias("text")))


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``documents`` and of its edited text, and how like they
    are to each other and to the next document's.

    Ids ascend with nulls first, equal ids in the order of their texts' MD5. Rows equal in
    id and text are one document (its next is the next different one; a single document is
    its own next) and are all returned. Null text is empty; a text of any length is summed
    shingle by shingle. Columns beyond ``doc_id`` and ``text`` are ignored.
    """
    rows = neighbours(docs, "doc_id", "text")
    order = Window.partitionBy("block").orderBy("at", "extra")
    n = F.char_length("text").cast("bigint")
    tail = F.floor(n / 2)
    edited = F.concat(F.expr("left(text, cast(n_chars - tail as int))"), F.expr("left(following, cast(tail as int))"))
    pairs = (rows.withColumn("following", F.lead("text").over(order)).withColumns({"n_chars": n, "tail": tail})
             .withColumn("edited", F.when(~F.col("extra"), edited)))
    hashed = pairs.select("block", "at", "extra", "doc_id", "copies", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                          lanes(F.col("text")).alias("own"), F.when(~F.col("extra"), lanes(F.col("edited"))).alias("edited"))
    found = (hashed.withColumn("next", F.lead("own").over(order)).where(~F.col("extra"))
             .withColumns({f"{c}_signs": signs(F.col(c)) for c in ("own", "edited", "next")}))
    near = {f"near_{c}": likeness(F.col("own_signs"), F.col(f"{c}_signs"), F.col("own") == F.col(c)) for c in ("edited", "next")}
    return (found.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                         as_text(F.col("edited")).alias("edited_fingerprint"), *(c.alias(n) for n, c in near.items()),
                         F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")).drop("copy"))
