"""Secret scan with multipart credential linking.

Strong findings stand alone: assignments of a secret, access identifiers and long
hex runs (the base kinds). Weak candidates (a user or key identifier, a short or
unnamed secret, an endpoint) are reported only when complementary parts stand within
one scope, ``SCOPE`` code points:

* identifier: a secret nearby,
* secret: an identifier or an endpoint nearby,
* endpoint: an identifier and a secret nearby.

Strong findings are evidence for weak ones: an assignment is a secret, an access
identifier is an identifier, and a hex run is a secret where a secret's name stands
right before it (otherwise it may be any checksum, and is none of the three).

The interval join is by order: per text, sorted parts carry the end of the last and
the start of the next part of each role, which decides whether one lies in scope
without pairing parts. Each distinct text (128-bit key) is searched once; its findings
are written before they meet the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm._text import bound, fresh, materialized, positions, text_key, whole

SCOPE = 300
RUN = 256

# The base patterns; group 2 of an assignment is its value.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""^(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
# A whole run matches or none of it does, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6

_IS = r"""["']?\x20*[:=]\x20*["']?"""
IDENTIFIER = rf"(?i:\b(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)){_IS}[A-Za-z0-9@._+-]{{3,}}"
SECRET = rf"(?i:\b(?:pass(?:phrase|code)?|pwd|pin|credential|signature|private_?key|auth)){_IS}[A-Za-z0-9+/_.=-]{{4,}}"
ENDPOINT = (r"(?i:https?|ftps?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[A-Za-z0-9._~:/?@!$&*+,;=%-]+"
            rf"|(?i:\b(?:host(?:name)?|endpoint|server|url)){_IS}[A-Za-z0-9.-]+(?::[0-9]+)?")
# What makes the hex run behind it a secret.
NAMED = r"(?i:secret|token|passw(?:or)?d|credential|api_?key|(?:private|access|auth|signing)_?key)[A-Za-z_]{0,16}[\"'\x20]{0,3}[:=]?[\"'\x20]{0,3}$"
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")


def matches(text: Column, pattern: str) -> Column:
    """(start, end, found, before) of the leftmost non-overlapping matches, in code points;
    ``before`` is the text between a match and the one before it.

    The pieces between matches come from splitting, so a start is the length of all
    that precedes it: summed inside runs of RUN matches, and over the runs.
    """
    Pair = "array<struct<before:string,found:string,gap:int,size:int>>"
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda b, f: F.struct(
        b.alias("before"), f.alias("found"), F.char_length(b).alias("gap"), F.char_length(f).alias("size")))
    pairs = F.filter(pairs, lambda p: p["found"].isNotNull()).cast(Pair)

    def runs(all_: Column) -> Column:
        return F.transform(positions(F.ceil(F.size(all_) / RUN).cast("int")), lambda k: F.slice(all_, k * RUN + 1, F.lit(RUN)))

    def placed(parts: Column) -> Column:
        sizes = F.transform(parts, lambda r: F.aggregate(r, F.lit(0), lambda n, p: n + p["gap"] + p["size"]))
        starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), run))

    def run(part: Column, start: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,found:string,before:string>>")
        return F.aggregate(part, F.struct(start.alias("end"), empty.alias("list")), add, lambda acc: acc["list"])

    def add(acc: Column, p: Column) -> Column:
        at, end = acc["end"] + p["gap"], acc["end"] + p["gap"] + p["size"]
        span = F.struct(at.alias("start"), end.alias("end"), p["found"].alias("found"), p["before"].alias("before"))
        return F.struct(end.alias("end"), F.concat(acc["list"], F.array(span)).alias("list"))

    return bound(pairs, lambda p: bound(runs(p), placed))


def _named(spans: Column, kind: str, role: str | None, when=None) -> Column:
    """(start, kind, end, role) of ``spans``; with ``when``, the role only where that holds."""
    def of(s: Column) -> Column:
        part = F.lit(role).cast("string") if when is None else F.when(when(s), role)
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"), part.alias("role"))

    return F.transform(spans, of)


def parts_of(text: Column) -> Column:
    """(start, kind, end, role) of base findings and weak candidates; an assignment is the
    one or the other by the length of its value."""
    def assigned(found: Column) -> Column:
        def long(s: Column) -> Column:
            return F.char_length(F.regexp_replace(s["found"], ASSIGN_VALUE, "")) >= MIN_VALUE

        return F.concat(_named(F.filter(found, long), "assign", "secret"),
                        _named(F.filter(found, lambda s: ~long(s)), "secret", "secret"))

    return F.concat(bound(matches(text, ASSIGN), assigned), _named(matches(text, ACCESS), "access", "identifier"),
                    _named(matches(text, HEX), "hex", "secret", lambda s: F.right(s["before"], F.lit(64)).rlike(NAMED)),
                    _named(matches(text, IDENTIFIER), "identifier", "identifier"), _named(matches(text, SECRET), "secret", "secret"),
                    _named(matches(text, ENDPOINT), "endpoint", "endpoint"))


STRONG = [KINDS.index(k) for k in ("assign", "access", "hex")]


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """``parts`` (key, start, kind, end, role) without the weak candidates that no
    complementary part is near."""
    ahead = W.partitionBy("key").orderBy("start", "kind", "end").rowsBetween(W.unboundedPreceding, -1)
    behind = (W.partitionBy("key").orderBy(F.desc("start"), F.desc("kind"), F.desc("end"))
              .rowsBetween(W.unboundedPreceding, -1))
    near = {}
    for role in ("identifier", "secret", "endpoint"):
        before = F.max(F.when(F.col("role") == role, F.col("end"))).over(ahead)
        after = F.min(F.when(F.col("role") == role, F.col("start"))).over(behind)
        near[role] = (F.coalesce(F.col("start") - before <= scope, F.lit(False))
                      | F.coalesce(after - F.col("end") <= scope, F.lit(False)))
    parts = parts.withColumns({f"near_{role}": c for role, c in near.items()})
    joined = (F.when(F.col("kind").isin(STRONG), True).when(F.col("kind") == 3, F.col("near_secret"))
              .when(F.col("kind") == 4, F.col("near_identifier") | F.col("near_endpoint"))
              .when(F.col("kind") == 5, F.col("near_identifier") & F.col("near_secret")))
    return parts.where(joined)


def findings(docs: DataFrame, text: str, scope: int = SCOPE) -> DataFrame:
    """(key, base, spans) of each distinct text with a finding."""
    some = "|".join(f"(?:{p})" for p in (ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT))
    texts = docs.select(whole(F.col(text)).alias("t")).where(F.col("t").rlike(some))
    # Copies are searched where they are read and put together by their findings. (The outer
    # form: for explode, Spark would filter by the array's size and so make it twice.)
    parts = (texts.select(text_key(F.col("t")).alias("key"), parts_of(F.col("t")).alias("parts")).select("key", F.explode_outer("parts").alias("p"))
             .where("p is not null").select("key", "p.start", "p.kind", "p.end", "p.role").distinct())
    span = F.struct("start", "kind", "end")
    return (linked(parts, scope).groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("kind").isin(STRONG), span))).alias("base"),
                                                    F.array_sort(F.collect_set(span)).alias("spans")))


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with base and spans: arrays of (start, kind number, end), code points,
    end exclusive, by start, then kind.

    Null text is empty and has no spans; equal texts and repeated rows get equal
    spans; parts at the same place count as near each other; a text of any length is
    searched whole, in time that grows with it; an empty table gives no rows; names that
    clash get an underscore.
    """
    base, spans, key, own = fresh(docs, "base", "spans", "text_key", "own_key")
    # Written, so that their size is known: findings are broadcast to the texts while they
    # are small, and joined by a shuffle that Spark can split where they aren't. The key is
    # a column before the join, so that texts nobody asks for aren't shuffled.
    found = materialized(findings(docs, text, scope), "secret_findings").toDF(key, base, spans)
    rows = docs.withColumn(own, text_key(F.col(text))).join(found, F.col(own) == F.col(key), "left").drop(own, key)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.withColumns({c: F.coalesce(F.col(c), none) for c in (base, spans)})


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    def of(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return scan(docs.select("doc_id", "text")).select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
