"""Customer and order cleaning: ``DataFrame -> DataFrame`` steps, no actions.

Steps compose with ``DataFrame.transform``; each only adds projections except
:func:`dedup_customers`, which is one aggregation (the only shuffle of the chain).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.functions.amounts import amount_is_suspicious, clean_amount
from baobab.functions.text import (EMAIL_PATTERN, PHONE_COUNTRY_PREFIX, PHONE_PATTERN,
                                   digits_only, missing_to_null, strip_accents)
from baobab.operators.windows import latest_per_key

# Fixed value: earliest plausible birth date.
BIRTH_MIN = "1920-01-01"


def _as_of(as_of: str | _dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def unify_missing(df: DataFrame, col: str = "email") -> DataFrame:
    """Trim; '', 'N/A', 'n/a', 'NULL' -> NULL (case-sensitive list)."""
    return df.withColumn(col, missing_to_null(col))


def normalize_email(df: DataFrame, col: str = "email", flag: str = "email_valide") -> DataFrame:
    """lower(trim(email)); validity flag, NULL when the e-mail is NULL."""
    e = F.lower(F.trim(F.col(col)))
    return df.withColumns({
        col: e,
        flag: F.when(e.isNull(), F.lit(None).cast("boolean")).otherwise(e.rlike(EMAIL_PATTERN)),
    })


def normalize_city(df: DataFrame, col: str = "ville", key: str = "ville_norm") -> DataFrame:
    """Display city initcap(trim); grouping key lower(no-accent(trim))."""
    t = F.trim(F.col(col))
    return df.withColumns({col: F.initcap(t), key: F.lower(strip_accents(t))})


def normalize_phone(df: DataFrame, col: str = "telephone", norm: str = "tel_norm",
                    flag: str = "tel_valide") -> DataFrame:
    """C4: digits only without the country prefix; validity flag (NULL stays NULL)."""
    tel = F.regexp_replace(digits_only(col), PHONE_COUNTRY_PREFIX, "")
    return df.withColumns({norm: tel, flag: tel.rlike(PHONE_PATTERN)})


def validate_birthdate(df: DataFrame, col: str = "date_naissance",
                       as_of: str | _dt.date | None = None) -> DataFrame:
    """Parse yyyy-MM-dd (unparseable -> NULL); keep only 1920-01-01..as_of."""
    d = F.try_to_date(F.col(col), "yyyy-MM-dd")
    ok = (d >= F.lit(BIRTH_MIN).cast("date")) & (d <= _as_of(as_of))
    return df.withColumn(col, F.when(ok, d))


def dedup_customers(df: DataFrame, key: str = "customer_id",
                    order_col: str = "date_inscription") -> DataFrame:
    """One row per key, the latest ``order_col``.

    Exact duplicates are identical rows, so keeping the maximum of
    (order_col, every other column) per key gives the same rows as "drop exact
    duplicates then keep the latest" with a deterministic tie-break, in a single
    aggregation that pre-aggregates on the map side (a hot key is never gathered
    into one task).
    """
    return latest_per_key(df, [key], [order_col])


def clean_customers(df: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6."""
    return (df.transform(unify_missing)
              .transform(normalize_email)
              .transform(normalize_city)
              .transform(normalize_phone)
              .transform(validate_birthdate, as_of=as_of)
              .transform(dedup_customers))


def clean_orders(df: DataFrame, raw: str = "montant_total_fcfa", out: str = "montant_fcfa",
                 keep_raw: str | None = "montant_raw", strict: bool = False) -> DataFrame:
    """Amount text -> BIGINT (non-digits dropped, safe cast).

    Adds ``montant_suspect`` (true when the text is not a plain amount, so digit
    stripping may have changed its value); ``strict=True`` makes those NULL.
    """
    cols = {out: clean_amount(raw, strict=strict),
            "montant_suspect": amount_is_suspicious(raw)}
    if keep_raw:
        cols[keep_raw] = F.col(raw)
    res = df.withColumns(cols)
    return res.drop(raw) if keep_raw and keep_raw != raw else res
