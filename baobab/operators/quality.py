"""Data-quality audits. Each returns a small metrics frame computed on executors.

Several independent measures are assembled into one row with scalar subqueries
(``DataFrame.scalar()``): each is computed once, in parallel over the whole input,
and no join or cross product is needed to put them side by side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.functions.text import missing_to_null, strip_accents
from baobab.operators.windows import latest_per_key


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def fingerprint(columns: list[Column]) -> Column:
    """128 bits of a row: two hashes with different beginnings over the values and, since
    the hash skips NULLs, over which of them are NULL. Rows of one fingerprint are taken
    as equal; among 10^12 different rows any two meet with a probability of 10^-15."""
    nulls = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in columns))
    return F.struct(F.xxhash64(nulls, *columns).alias("a"), F.xxhash64(F.lit("b"), *columns, nulls).alias("b"))


def surplus_rows(df: DataFrame, cols: list[Column | str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group: ``count - count(distinct)``,
    in one aggregation (A36) over the rows' fingerprints: what is shuffled doesn't grow
    with the width of the table."""
    sel = [F.col(f"`{c}`") if isinstance(c, str) else c for c in cols or df.columns]
    return (df.groupBy(fingerprint(sel).alias("f")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("nb_doublons")))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count of every column in a single pass."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns])


def measure_profile(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Several distinct/duplicate measures of one table, in their own types.

    Rows and NULLs of all measures come from one aggregate. Each distinct count is a
    scalar subquery over the columns of its measure alone: the rows are never expanded,
    and a dominant value is reduced on every mapper. Returns one row with, per measure
    ``m``: ``m_rows``, ``m_nulls``, ``m_distinct`` (non-null values) and ``m_surplus``
    (rows beyond the first of each non-null value).
    """
    known = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_{m}") for m, c in measures.items()])
    # distinct() and not count_distinct: Spark would merge the latter into one aggregate,
    # which expands every row by the number of measures.
    known = known.withColumns({f"{m}_distinct": df.select(c.alias("_v")).distinct().agg(F.count("_v")).scalar()
                               for m, c in measures.items()})
    out = []
    for m in measures:
        out += [F.col("_rows").alias(f"{m}_rows"), (F.col("_rows") - F.col(f"_{m}")).alias(f"{m}_nulls"),
                F.col(f"{m}_distinct"), (F.col(f"_{m}") - F.col(f"{m}_distinct")).alias(f"{m}_surplus")]
    return known.select(*out)


def row_groups(df: DataFrame, normalized: dict[str, Column], keep: list[str] | None = None, **counted: Column) -> DataFrame:
    """One row per distinct row of ``df`` after the ``normalized`` columns are replaced:
    ``rows``, the distinct rows before that (``exact``), the rows for which each condition
    in ``counted`` holds, and the columns ``keep`` (none of the ``normalized``).

    Two grouping steps over the rows' fingerprints, before and after; rows are counted on
    the mappers first. A row moves as its two fingerprints and the kept columns, however
    wide the table is.
    """
    keep = keep or []
    flags = {name: F.coalesce(cond, F.lit(False)) for name, cond in counted.items()}
    rows = df.select(fingerprint([F.col(f"`{c}`") for c in df.columns]).alias("_exact"),
                     fingerprint([normalized.get(c, F.col(f"`{c}`")) for c in df.columns]).alias("_after"),
                     *keep, *(flag.alias(name) for name, flag in flags.items()))
    exact = rows.groupBy("_exact", "_after", *keep, *flags).agg(F.count(F.lit(1)).alias("rows"))
    return exact.groupBy("_after", *keep).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("exact"),
        *[F.sum(F.when(F.col(name), F.col("rows")).otherwise(0)).alias(name) for name in flags])


def cleaning_report(raw: DataFrame, email: str = "email", city: str = "ville",
                    key: str = "customer_id") -> DataFrame:
    """Raw rows, missing e-mails (after C1), distinct cities before and after
    normalisation, exact duplicates, duplicates once e-mails are normalised, rows
    after de-duplication (one per key) -- one scan of the raw table.

    Rows move as fingerprints with their city and key; only distinct ones are told apart
    by city, normalised city and key, as three short values in their own types."""
    groups = row_groups(raw, {email: F.lower(F.trim(F.col(email)))}, keep=[key, city], missing=missing_to_null(email).isNull())
    c, k = F.col(city), F.col(key)
    no_text, no_key = F.lit(None).cast("string"), F.lit(None).cast(raw.schema[key].dataType)

    def seen(measure: int, text: Column, number: Column, first: bool) -> Column:
        counts = [(F.col(n) if first else F.lit(0)).cast("bigint").alias(n) for n in ("rows", "exact", "missing")]
        return F.struct(F.lit(measure).alias("measure"), text.alias("text"), number.alias("key"),
                        F.lit(int(first)).cast("bigint").alias("groups"), *counts)

    values = groups.select(F.explode(F.array(
        seen(0, no_text, k, True), seen(1, c, no_key, False),
        seen(2, F.lower(strip_accents(F.trim(c))), no_key, False))).alias("v")).select("v.*")
    values = values.groupBy("measure", "text", "key").agg(
        *[F.sum(n).alias(n) for n in ("groups", "rows", "exact", "missing")])

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    def distinct(measure: int, value: str) -> Column:
        return F.count(F.when(F.col("measure") == measure, F.col(value)))

    return values.agg(
        total("rows").alias("nb_lignes_brutes"), total("missing").alias("nb_emails_manquants"),
        distinct(1, "text").alias("nb_villes_avant"), distinct(2, "text").alias("nb_villes_apres"),
        (total("rows") - total("exact")).alias("nb_doublons_exacts"),
        (total("rows") - total("groups")).alias("nb_doublons_apres_normalisation"),
        distinct(0, "key").alias("nb_lignes_apres"))


def padded_values(df: DataFrame, col: str) -> DataFrame:
    """Values carrying leading or trailing spaces."""
    return df.agg(F.count(F.when(F.col(col) != F.trim(F.col(col)), F.lit(1))).alias("nb_espaces_parasites"))


def near_duplicates(df: DataFrame, normalized: dict[str, Column]) -> DataFrame:
    """R2: exact duplicate rows vs rows that only become duplicates once the
    ``normalized`` columns are normalised (one scan)."""
    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return row_groups(df, normalized).agg(
        total(F.col("rows")).alias("nb_lignes"),
        total(F.col("rows") - F.col("exact")).alias("nb_doublons_exacts"),
        total(F.col("exact") - 1).alias("nb_quasi_doublons"))


def key_concentration(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The heaviest key, its share of rows and the share of the top ``k`` keys.

    Per-key counts use a partial aggregation (a key holding a third of the rows is
    pre-counted on every mapper); the top-k is a TakeOrderedAndProject.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = _count(df)
    top = counts.orderBy(F.col("n").desc(), F.col(key)).limit(k)
    best = top.orderBy(F.col("n").desc(), F.col(key)).limit(1)
    return best.select(
        F.col(key).alias("cle_dominante"),
        F.col("n").alias("nb_lignes_cle"),
        F.round(F.lit(100.0) * F.col("n") / total, 2).alias("part_cle_pct"),
        F.round(F.lit(100.0) * top.agg(F.sum("n")).scalar() / total, 2).alias(f"part_top{k}_pct"),
    )


def status_normalized(c: Column | str, success: list[str], failure: list[str]) -> Column:
    """lower/trim/no-accent spelling mapped to 'success' / 'failure' / 'unknown'."""
    col = F.col(c) if isinstance(c, str) else c
    n = F.lower(strip_accents(F.trim(col)))
    return (F.when(n.isin(*success), F.lit("success"))
             .when(n.isin(*failure), F.lit("failure"))
             .otherwise(F.lit("unknown")))


def payment_audit(payments: DataFrame, orders: DataFrame, pay_key: str = "order_id",
                  order_key: str = "order_id", amount: str = "montant_fcfa",
                  order_amount: str = "montant_fcfa") -> DataFrame:
    """Negative amounts, partial payments (paid != ordered) and payments whose
    order is unknown, in one left join (orders are unique on their key)."""
    o = orders.select(F.col(order_key).alias("_ok"), F.col(order_amount).alias("_oa"))
    j = payments.join(o, F.col(pay_key) == F.col("_ok"), "left")
    orphan = F.col("_ok").isNull()
    neg = F.col(amount) < 0
    partial = ~orphan & ~neg & (F.col(amount) != F.col("_oa"))
    return j.agg(
        F.count(F.lit(1)).alias("nb_paiements"),
        F.count(F.when(neg, F.lit(1))).alias("nb_negatifs"),
        F.count(F.when(partial, F.lit(1))).alias("nb_partiels"),
        F.count(F.when(orphan, F.lit(1))).alias("nb_orphelins"),
        F.coalesce(F.sum(F.when(orphan, F.col(amount))), F.lit(0)).alias("montant_orphelins"),
    )


def dedup_on_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key (latest ``order_col``; identical copies collapse)."""
    return latest_per_key(df, [key], [order_col])


def age_anomalies(df: DataFrame, col: str, as_of: str | _dt.date) -> DataFrame:
    """Parse birth dates leniently, age in years = days / 365.25; count
    unparseable, negative and > 120 years, and report min/max age."""
    d = F.try_to_date(F.col(col), "yyyy-MM-dd")
    age = F.datediff(F.lit(str(as_of)).cast("date"), d) / F.lit(365.25)
    return df.select(d.alias("_d"), age.alias("_age")).agg(
        F.count(F.when(F.col("_d").isNull(), F.lit(1))).alias("nb_illisibles"),
        F.count(F.when(F.col("_age") < 0, F.lit(1))).alias("nb_futur"),
        F.count(F.when(F.col("_age") > 120, F.lit(1))).alias("nb_plus_120_ans"),
        F.round(F.min("_age"), 2).alias("age_min"),
        F.round(F.max("_age"), 2).alias("age_max"),
    )
