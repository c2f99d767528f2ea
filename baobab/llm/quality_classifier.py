"""Quality classifier by hierarchical empirical Bayes.

Evidence of a document: naive Bayes over the words it holds and bins of a few shape
measures, fitted on at most ``SAMPLE`` labelled documents (a hash sample of the
labelled rows), the ``FEATURES`` features with the surest association kept, and
calibrated by a logistic fit on the quarter of the sample left out of the counts.

Prior of a document: the labelled share of its host and of its path. Counts of all
labelled documents are grouped by host and path; a host's posterior mean is shrunk
toward the global share and a path's toward its host's, by strengths estimated from
the spread between groups (method of moments), so sparse sites stay near their
parents. Posterior odds are path odds times the document's likelihood ratio.

The sample and the model are bounded by parameters and shipped with the tasks; all
documents are scored, and no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm._text import materialized

SAMPLE = 20_000
FEATURES = 2_000
MIN_COUNT = 3
MIN_Z = 3.3  # rare words associated by chance stay out
MAX_WORD = 24
MAX_EVIDENCE = 8.0
MAX_STRENGTH = 1000.0
_ENDS = b".,;:!?\"'()[]"


def features(text: str | None) -> set[bytes]:
    """Words without marks around them, and bins of shape measures (named with a zero byte)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = data.split()
    words = {w.strip(_ENDS) for w in data.lower().split()}
    out = {w for w in words if 0 < len(w) <= MAX_WORD}
    n, size = max(1, len(raw)), max(1, len(data))
    upper = sum(data.count(c) for c in (b"A", b"E", b"I", b"N", b"O", b"R", b"S", b"T"))
    symbols = sum(data.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    adjacent = sum(a == b for a, b in zip(raw, raw[1:]))
    for name, value in (("upper", 20 * upper / size), ("symbols", 10 * symbols / n), ("same", 10 * adjacent / n),
                        ("lines", 10 * (len(lines) - len(set(lines))) / max(1, len(lines))),
                        ("distinct", 5 * len(words) / n), ("length", math.log2(n)), ("mean", size / n / 3)):
        out.add(b"\0%s=%d" % (name.encode(), min(9, int(value))))
    return out


def _slim(docs: DataFrame, doc_id: str, text: str, host: str, path: Column) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))


def _labels(labels: DataFrame, target: str) -> DataFrame:
    """One 0/1 label per document: the mean of repeated rows, a tie counting as 0."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
            .groupBy("doc_id").agg((F.avg(F.col(target).cast("double")) > 0.5).cast("int").alias("y")))


def fit_evidence(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = FEATURES) -> dict:
    """{"weights": {feature: log-likelihood ratio}, "slope", "shift"} from the sample."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` small rows
    # One text an id, however often the id is there: the one of the least hash.
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.md5(F.coalesce("text", F.lit(""))).alias("key"), "text")).alias("one"))
    rows = materialized(rows.select("doc_id", "one.text", "y"), "classifier_sample")
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(4)) == 0
    rows = rows.withColumn("held", held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[bytes, list[int]] = {}
            for t, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                for f in (*features(t), b"\0all"):
                    sums.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.binary()), pa.array([v[0] for v in sums.values()], pa.int64()),
                 pa.array([v[1] for v in sums.values()], pa.int64())], names=["f", "n0", "n1"])

    sums = (rows.where(~F.col("held")).select("text", "y").mapInArrow(count, "f binary, n0 long, n1 long")
            .groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    sums = materialized(sums.where(F.col("n0") + F.col("n1") >= MIN_COUNT), "classifier_counts")
    all_ = sums.where(F.col("f") == F.lit(b"\0all")).first()
    n0, n1 = (all_["n0"], all_["n1"]) if all_ else (0, 0)
    if not n0 or not n1:  # one class or no labels: no evidence
        return {"weights": {}, "slope": 0.0, "shift": 0.0}
    ratio = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = (sums.where(F.col("f") != F.lit(b"\0all")).select("f", ratio.alias("w"), F.abs(ratio / error).alias("z"))
            .where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "f").limit(n_features).collect())
    model = {"weights": {bytes(r["f"]): r["w"] for r in best}, "slope": 1.0, "shift": 0.0}
    scored = score(rows.where("held").select("doc_id", "text", "y"), {"s": model}).select("s", "y").collect()
    x, y = (np.array([r[i] for r in scored], float) for i in (0, 1))
    if len(x) < 20 or y.min() == y.max():
        return model
    slope, shift = _logistic(x, y)
    share = y.mean()
    return model | {"slope": slope, "shift": shift - math.log(share / (1 - share))}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with a small ridge (Newton's steps)."""
    a, at = np.stack([x, np.ones_like(x)], axis=1), np.array([0.1, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ at, -30, 30)))
        gradient = a.T @ (y - p) - 1e-3 * at
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), gradient)
        at = at + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(0.0, at[0])), float(at[1])


def score(rows: DataFrame, models: dict[str, dict]) -> DataFrame:
    """``rows`` without their text, with the log-likelihood ratio of each model."""
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema
    for name in models:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values: dict[str, list[float]] = {name: [] for name in models}
            for t in batch.column("text").to_pylist():
                held = features(t)
                for name, m in models.items():
                    # Sorted, so that the sum doesn't depend on the order of a set.
                    total = math.fsum(m["weights"][f] for f in held if f in m["weights"])
                    values[name].append(max(-MAX_EVIDENCE, min(MAX_EVIDENCE, m["slope"] * total + m["shift"]))
                                        if m["slope"] != 1.0 or m["shift"] else total)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(values[n]) for n in models)],
                                             names=[*kept, *models])

    return rows.mapInArrow(run, schema)


def _strength(groups: DataFrame, parent: Column) -> Column:
    """Prior strength (in documents) from the spread of group shares around their
    parents: p(1-p)/tau2 - 1 with tau2 the spread beyond sampling noise."""
    share = F.col("good") / F.col("n")
    noise = parent * (1 - parent)
    tau2 = F.sum(F.col("n") * (F.pow(share - parent, 2) - noise / F.col("n"))) / F.sum("n")
    level = F.sum(F.col("n") * noise) / F.sum("n")
    best = F.when(tau2 > 0, F.least(F.lit(MAX_STRENGTH), F.greatest(F.lit(1.0), level / tau2 - 1)))
    return groups.agg(F.coalesce(best, F.lit(MAX_STRENGTH))).scalar()


def site_priors(sites: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(host, path, ``name``): the shrunk share of good documents of every path of
    ``sites`` (doc_id, host, path)."""
    marked = sites.join(labels, "doc_id", "left")
    paths = materialized(marked.groupBy("host", "path").agg(
        F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("good")), "classifier_paths")
    total = paths.agg((F.sum("good") + 1.0) / (F.sum("n") + 2.0)).scalar()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = hosts.withColumn("mean", total)
    k = _strength(hosts.where("n > 0"), F.col("mean"))
    hosts = hosts.select("host", ((F.col("good") + k * F.col("mean")) / (F.col("n") + k)).alias("mean"))
    paths = paths.join(materialized(hosts, "classifier_hosts"), "host")
    k = _strength(paths.where("n > 0"), F.col("mean"))
    return paths.select("host", "path", ((F.col("good") + k * F.col("mean")) / (F.col("n") + k)).alias(name))


def classify(docs: DataFrame, labels: DataFrame, targets: dict[str, Column], doc_id: str = "doc_id",
             text: str = "text", host: str = "source", path: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, p_<target>...): posterior probability that each target (a 0/1 column over
    ``labels``) holds, for every row of ``docs``.

    Null text is empty; null hosts and paths are sites of their own; unlabelled sites
    take their parent's share; without labels of both classes the prior decides;
    repeated rows score alike; an empty table gives no rows.
    """
    slim = _slim(docs, doc_id, text, host, F.col("lang") if path is None else path)
    sites = materialized(slim.drop("text"), "classifier_sites")
    models, priors = {}, None
    for name, column in targets.items():
        y = materialized(_labels(labels.withColumn("y_", column), "y_"), "classifier_labels")
        models[name] = fit_evidence(slim, y, sample)
        own = site_priors(sites, y, f"prior_{name}")
        priors = own if priors is None else priors.join(own, ["host", "path"])
    priors = materialized(priors, "classifier_priors")
    out = score(slim, models).join(priors, ["host", "path"])
    for name in targets:
        prior = F.col(f"prior_{name}")
        out = out.withColumn(f"p_{name}", 1 / (1 + F.exp(-(F.log(prior / (1 - prior)) + F.col(name)))))
    return out.select("doc_id", *(f"p_{name}" for name in targets))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_quality, p_toxic, kept: good and not toxic."""
    targets = {"quality": F.col("quality"), "toxic": F.col("toxic")}
    return classify(docs, labels, targets).withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5))
