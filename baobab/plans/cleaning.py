"""Cleaning-module queries (C1-C7) and the before/after quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.functions.text import EMAIL_PATTERN, PHONE_PATTERN
from baobab.operators import clean, quality
from baobab.plans import model as M
from baobab.plans.base import AS_OF, query, staged, wh
from baobab.plans.oracle_model import with_views as V

_MISSING = "('', 'N/A', 'n/a', 'NULL')"
_EMAIL_RE = EMAIL_PATTERN.replace("'", "''")
_PHONE_RE = PHONE_PATTERN

# The C1..C5 chain in SQL, one CTE per step (same names as the Spark steps).
SQL_C1 = f"""
SELECT customer_id, prenom, nom,
       CASE WHEN trim(email) IN {_MISSING} THEN NULL ELSE trim(email) END AS email,
       telephone, ville, region, date_naissance, date_inscription
FROM customers_raw"""
SQL_C2 = f"""
SELECT customer_id, prenom, nom, lower(trim(email)) AS email, telephone, ville, region,
       date_naissance, date_inscription,
       regexp_matches(lower(trim(email)), '{_EMAIL_RE}') AS email_valide
FROM c1"""
SQL_C3 = """
SELECT customer_id, prenom, nom, email, telephone,
       upper(substr(trim(ville), 1, 1)) || lower(substr(trim(ville), 2)) AS ville,
       region, date_naissance, date_inscription, email_valide,
       lower(strip_accents(trim(ville))) AS ville_norm
FROM c2"""
SQL_C4 = f"""
SELECT *, regexp_matches(tel_norm, '{_PHONE_RE}') AS tel_valide
FROM (SELECT *, regexp_replace(regexp_replace(telephone, '[^0-9]', '', 'g'), '^221', '') AS tel_norm
      FROM c3)"""
SQL_C5 = f"""
SELECT customer_id, prenom, nom, email, telephone, ville, region,
       CASE WHEN try_strptime(date_naissance, '%Y-%m-%d')::DATE
                 BETWEEN DATE '1920-01-01' AND DATE '{AS_OF}'
            THEN try_strptime(date_naissance, '%Y-%m-%d')::DATE END AS date_naissance,
       date_inscription, email_valide, ville_norm, tel_norm, tel_valide
FROM c4"""


def _latest_sql(src: str, cols: list[str], key: str = "customer_id",
                order: str = "date_inscription") -> str:
    """Latest row per key, ties broken by the remaining columns (desc, NULLs last)."""
    rest = [c for c in cols if c not in (key, order)]
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in [order, *rest])
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {ob}) AS _rn FROM {src}) WHERE _rn = 1")


RAW_COLS = ["customer_id", "prenom", "nom", "email", "telephone", "ville", "region",
            "date_naissance", "date_inscription"]
CLEAN_COLS = RAW_COLS + ["email_valide", "ville_norm", "tel_norm", "tel_valide"]
SQL_C6_ALONE = _latest_sql("customers_raw", RAW_COLS)
SQL_C7 = _latest_sql("c5", CLEAN_COLS)
CHAIN = [("c1", SQL_C1), ("c2", SQL_C2), ("c3", SQL_C3), ("c4", SQL_C4), ("c5", SQL_C5)]


def _chain(upto: int) -> list[tuple[str, str]]:
    return CHAIN[:upto]


def _raw(spark, sf_dir) -> DataFrame:
    return M.customers_raw(wh(spark, sf_dir))


@query("clean_missing", V("SELECT customer_id, email FROM c1", "customers_raw", extra=_chain(1)))
def clean_missing_q(spark, sf_dir):
    return clean.unify_missing(_raw(spark, sf_dir)).select("customer_id", "email")


@query("clean_email", V(f"""
SELECT customer_id, lower(trim(email)) AS email,
       regexp_matches(lower(trim(email)), '{_EMAIL_RE}') AS email_valide
FROM customers_raw""", "customers_raw"))
def clean_email_q(spark, sf_dir):
    return clean.normalize_email(_raw(spark, sf_dir)).select("customer_id", "email", "email_valide")


@query("clean_city", V("""
SELECT customer_id, upper(substr(trim(ville), 1, 1)) || lower(substr(trim(ville), 2)) AS ville,
       lower(strip_accents(trim(ville))) AS ville_norm
FROM customers_raw""", "customers_raw"))
def clean_city_q(spark, sf_dir):
    return clean.normalize_city(_raw(spark, sf_dir)).select("customer_id", "ville", "ville_norm")


@query("clean_phone", V(f"""
SELECT customer_id, tel_norm, regexp_matches(tel_norm, '{_PHONE_RE}') AS tel_valide
FROM (SELECT customer_id,
             regexp_replace(regexp_replace(telephone, '[^0-9]', '', 'g'), '^221', '') AS tel_norm
      FROM customers_raw)""", "customers_raw"))
def clean_phone_q(spark, sf_dir):
    return clean.normalize_phone(_raw(spark, sf_dir)).select("customer_id", "tel_norm", "tel_valide")


@query("clean_birthdate", V(f"""
SELECT customer_id,
       strftime(CASE WHEN try_strptime(date_naissance, '%Y-%m-%d')::DATE
                          BETWEEN DATE '1920-01-01' AND DATE '{AS_OF}'
                     THEN try_strptime(date_naissance, '%Y-%m-%d')::DATE END, '%Y-%m-%d')
         AS date_naissance
FROM customers_raw""", "customers_raw"))
def clean_birthdate_q(spark, sf_dir):
    out = clean.validate_birthdate(_raw(spark, sf_dir), as_of=AS_OF)
    return out.select("customer_id", F.date_format("date_naissance", "yyyy-MM-dd").alias("date_naissance"))


@query("dedup_customers", V(SQL_C6_ALONE, "customers_raw"))
def dedup_customers_q(spark, sf_dir):
    return clean.dedup_customers(_raw(spark, sf_dir))


@query("clean_customers", V(
    "SELECT * REPLACE (strftime(date_naissance, '%Y-%m-%d') AS date_naissance) FROM c7",
    "customers_raw", extra=_chain(5) + [("c7", SQL_C7)]))
def clean_customers_q(spark, sf_dir):
    out = clean.clean_customers(_raw(spark, sf_dir), as_of=AS_OF)
    return out.withColumn("date_naissance", F.date_format("date_naissance", "yyyy-MM-dd"))


_NORM_COLS = ", ".join(["customer_id", "prenom", "nom", "lower(trim(email)) AS email", "telephone",
                        "ville", "region", "date_naissance", "date_inscription"])


@query("quality_report", V(f"""
SELECT (SELECT COUNT(*) FROM customers_raw) AS nb_lignes_brutes,
       (SELECT COUNT(*) FROM c1 WHERE email IS NULL) AS nb_emails_manquants,
       (SELECT COUNT(DISTINCT ville) FROM customers_raw) AS nb_villes_avant,
       (SELECT COUNT(DISTINCT lower(strip_accents(trim(ville)))) FROM customers_raw) AS nb_villes_apres,
       (SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customers_raw
            GROUP BY ALL_COLS)) AS nb_doublons_exacts,
       (SELECT CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM (SELECT {_NORM_COLS} FROM customers_raw)
            GROUP BY ALL_COLS)) AS nb_doublons_apres_normalisation,
       (SELECT COUNT(DISTINCT customer_id) FROM customers_raw) AS nb_lignes_apres
""".replace("ALL_COLS", ", ".join(RAW_COLS)), "customers_raw", extra=_chain(1)))
def quality_report_q(spark, sf_dir):
    """The before/after cleaning report as one row."""
    return quality.cleaning_report(_raw(spark, sf_dir))


# Clean customers (C7) as CTEs for other oracles, and the Spark counterpart.
CLEAN_CUSTOMERS_CTES = _chain(5) + [("customers_clean", SQL_C7)]


def customers_clean(w) -> DataFrame:
    """C7 over the raw export (the de-duplicated dimension used by the joins)."""
    return staged(w, "customers_clean", lambda: clean.clean_customers(M.customers_raw(w), as_of=AS_OF))
