"""Quality rules: base counts and distribution divergence from the language.

Two histograms of a document are compared to its language's reference by
Jensen-Shannon distance (base 2, 0 to 1): character classes (letters by case, digits,
marks, symbols and spaces of ASCII, and the same of all other scripts), and the
language's ``COMMON`` most common words with all others as one bin. References are sums
over all documents of a language with ``MIN_WORDS`` words, each document weighing the
same. A reference of n documents is itself a sample, and its error falls with the root
of n: both limits are wider by ``ERROR`` / sqrt(n), so a language with a few documents is
judged mildly, one alone hardly at all, and no number of documents changes the rule.
Short texts scatter, so each comparison has a least length.

Words of any length and script count; they are told apart by 64-bit hashes. References
of the ``MAX_LANGUAGES`` largest languages (a few MB) are collected and shipped with the
tasks; further ones are joined to their documents, one small row a language. The rest
is free style: Arrow batches and numpy per text, no shuffle of texts.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baobab.llm._text import fresh, materialized

COMMON = 64
MAX_LANGUAGES = 1000
MIN_WORDS = 20
MIN_WORDS_CHARS = 20
MAX_CHARS_DISTANCE = 0.35
MIN_WORDS_COMMON = 100
MAX_COMMON_DISTANCE = 0.40
ERROR = 0.5
WINDOW = 8
WEIGHT = 1_000_000

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other", "other lower", "other upper", "other letter",
           "other mark", "other digit", "other sign")


def _byte_classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"))
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1], out[ord("0"):ord("9") + 1] = 0, 1, 2
    out[list(_SPACE)] = 3
    ascii_rest = [c for c in range(33, 127) if not chr(c).isalnum()]
    out[ascii_rest] = 5
    out[list(b".,;:!?'\"()-")] = 4
    return out


_CLASS = _byte_classes()
_IN_WORD = np.array([c not in _SPACE and not 0x80 <= c < 0xC0 for c in range(256)])  # one byte of each code point


@cache
def _other_classes() -> np.ndarray:
    """Class of every code point beyond ASCII, by its Unicode category."""
    by_category = {"Ll": 7, "Lu": 8, "Lt": 8, "Lm": 9, "Lo": 9, "M": 10, "N": 11}
    out = np.full(0x110000, CLASSES.index("other sign"), np.uint8)
    for c in range(128, 0x110000):
        category = unicodedata.category(chr(c))
        if (known := by_category.get(category, by_category.get(category[0]))) is not None:
            out[c] = known
    return out


def class_histogram(data: bytes, bytes_seen: np.ndarray) -> np.ndarray:
    """Characters by class, from the text and its counts by byte value."""
    ascii_ = np.bincount(_CLASS[:128], weights=bytes_seen[:128], minlength=len(CLASSES))
    if not bytes_seen[128:].any():
        return ascii_
    points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return ascii_ + np.bincount(_other_classes()[points[points >= 128]], minlength=len(CLASSES))


def word_hash(word: bytes) -> int:
    """64 bits, signed as a long."""
    h = xxhash.xxh64_intdigest(word)
    return h - 2 ** 64 if h >= 2 ** 63 else h


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms (0 if one is empty)."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    parts = [float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0]))) for x in (p, q)]
    return max(0.0, sum(parts) / 2) ** 0.5


def _window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """Hashes of all windows (wrapping sums of word hashes times powers of an odd number)."""
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out, n, power = np.zeros(len(words) - window + 1, np.uint64), len(words) - window + 1, 1
    for j in range(window):
        out += h[j:j + n] * np.uint64(power)
        power = power * 0x9E3779B97F4A7C15 % 2 ** 64
    return out


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. Equal windows have equal hashes, so
    texts without equal hashes are done; else windows get exact numbers by doubling:
    numbers of pairs of windows half as long."""
    n = len(words)
    if n <= window:
        return 0
    hashes = np.sort(_window_hashes(words, window))
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    size = 1
    while size < window:
        step = min(size, window - size)
        ids = np.unique(ids[:len(ids) - step] * (ids.max() + 1) + ids[step:], return_inverse=True)[1]
        size += step
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[:len(again)] += again
    edges[window:] -= again
    return int((np.cumsum(edges[:n]) > 0).sum())


def repeated_lines(data: bytes) -> int:
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[dict, DataFrame | None]:
    """{language: (class histogram, {word hash: bin}, word histogram, documents)} of the
    largest languages, and (lang, docs, ref) with the rows of each further one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: Counter = Counter()
            for t, language in zip(_column(batch, "text"), _column(batch, "lang"), strict=True):
                data = _bytes(t)
                words = data.lower().split()
                if len(words) < MIN_WORDS:
                    continue
                language = language or ""
                seen = class_histogram(data, np.bincount(np.frombuffer(data, np.uint8), minlength=256))
                for k, value in enumerate((seen * (WEIGHT / seen.sum())).tolist()):
                    sums[language, "c", k] += round(value)
                sums[language, "n", 0] += 1
                for w, n in Counter(words).items():
                    sums[language, "w", word_hash(w)] += round(n * WEIGHT / len(words))
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.int64()), pa.array([sums[k] for k in keys], pa.int64())],
                names=["lang", "kind", "name", "n"])

    slim = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sums = materialized(slim.mapInArrow(run, "lang string, kind string, name long, n long")
                        .groupBy("lang", "kind", "name").agg(F.sum("n").alias("n")), "quality_references")
    own = sums.where("kind = 'n'").select("lang", F.col("n").alias("docs"))
    ranked = sums.where("kind != 'n'").withColumn("rank", F.row_number().over(
        W.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))).where(F.col("rank") <= COMMON)
    tables = ranked.join(own, "lang").groupBy("lang", "docs").agg(
        F.sort_array(F.collect_list(F.struct("kind", "rank", "name", "n"))).alias("ref"))
    tables = materialized(tables, "quality_tables")
    order = [F.desc("docs"), F.col("lang")]
    first = tables.orderBy(*order).limit(MAX_LANGUAGES + 1).collect()
    out = {r["lang"]: reference(r["ref"], r["docs"]) for r in first[:MAX_LANGUAGES]}
    if len(first) <= MAX_LANGUAGES:
        return out, None
    n, name = first[MAX_LANGUAGES]["docs"], first[MAX_LANGUAGES]["lang"]
    rest = tables.where((F.col("docs") < n) | ((F.col("docs") == n) & (F.col("lang") >= name)))
    return out, rest.select("lang", "docs", "ref")


def reference(rows: list, n_docs: int) -> tuple:
    """(class histogram, {word hash: bin}, word histogram, documents) of a language's (kind, rank, name, n)."""
    classes, bins, heights = np.zeros(len(CLASSES)), {}, []
    for r in rows:
        if r["kind"] == "c":
            classes[r["name"]] = r["n"]
        else:
            bins[r["name"]] = len(heights)
            heights.append(r["n"])
    return classes, bins, np.array([*heights, max(0, n_docs * WEIGHT - sum(heights))], float), n_docs


def judge_text(text: str | None, lang: str | None, refs: dict) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    chars_distance, words_distance)."""
    data = _bytes(text)
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, repeat = len(words), repeated_words(words)
    failed = n < 20 or 100 * repeat > 30 * n
    classes, bins, common, n_docs = refs.get(lang or "", (np.zeros(len(CLASSES)), {}, np.zeros(1), 1))
    chars = common_words = 0.0
    if n >= MIN_WORDS_CHARS:
        chars = distance(class_histogram(data, seen), classes)
    if n >= MIN_WORDS_COMMON:
        heights = np.zeros(len(common))
        for w, count in Counter(data.lower().split()).items():
            heights[bins.get(word_hash(w), -1)] += count
        common_words = distance(heights, common)
    wider = ERROR / n_docs ** 0.5
    kept = not failed and chars <= MAX_CHARS_DISTANCE + wider and common_words <= MAX_COMMON_DISTANCE + wider
    return (n, int(seen[_IN_WORD].sum()), int(seen[list(_SYMBOLS)].sum()), repeated_lines(data), repeat,
            failed, kept, chars, common_words)


FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("chars_distance", T.DoubleType()), T.StructField("words_distance", T.DoubleType())])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the columns of ``FIELDS``.

    Null text has no words and fails; a null language is that without a name (empty);
    texts of any length are judged whole; repeated rows are judged alike, ties between common words go to the smaller hash;
    an empty table gives no rows; names that clash get an underscore.
    """
    refs, rest = references(docs, text, lang)
    names = fresh(docs, *FIELDS.names)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, FIELDS))])
    types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2

    held, joined = len(docs.columns), rest is not None
    if joined:
        rest = rest.toDF(*fresh(docs, "ref_lang", "ref_docs", "ref"))
        docs = docs.join(rest, F.coalesce(F.col(lang).cast("string"), F.lit("")) == F.col(rest.columns[0]), "left")
    own: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (t, x) in enumerate(zip(_column(batch, text), _column(batch, lang), strict=True)):
                x, use = "" if x is None else str(x), refs
                if joined and x not in refs and batch.column(held)[i].is_valid:
                    if x not in own:
                        own.clear()  # one at a time: a task's memory doesn't grow with the languages
                        own[x] = reference(batch.column(held + 2)[i].as_py(), batch.column(held + 1)[i].as_py())
                    use = own
                rows.append(judge_text(t, x, use))
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:held], *made], names=[*batch.schema.names[:held], *names])

    return docs.mapInArrow(run, schema)


def keep_documents(docs: DataFrame, **columns) -> DataFrame:
    """``docs`` without the documents that fail."""
    kept = fresh(docs, *FIELDS.names)[FIELDS.names.index("kept")]
    return judge(docs, **columns).where(F.col(kept)).select(*(f"`{c}`" for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, and both distances."""
    return judge(docs.select("doc_id", "text", "lang")).drop("text", "lang")
