"""Amount parsing for money stored as text (currency without decimals)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A well-formed amount text is digits with an optional currency suffix (any case).
WELL_FORMED_AMOUNT = r"^\s*[0-9]+(\s*(?i:FCFA))?\s*$"
# A "pure number" (digits with an optional decimal part).
NUMERIC_TEXT = r"^[0-9]+(\.[0-9]+)?$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def naive_amount(c: Column | str) -> Column:
    """What a plain numeric cast gives: NULL for every non-numeric text."""
    return _c(c).try_cast("double")


def clean_amount(c: Column | str, strict: bool = False) -> Column:
    """Text amount -> BIGINT by dropping every non-digit, then a safe cast.

    This is the course semantics: ``12 500 FCFA`` -> 12500, but also ``-12.50`` ->
    1250 (sign and decimal point are lost). ``strict=True`` returns NULL for texts
    that are not :data:`WELL_FORMED_AMOUNT` instead of guessing.
    """
    col = _c(c)
    parsed = F.regexp_replace(F.trim(col), r"[^0-9]", "").try_cast("bigint")
    if strict:
        return F.when(col.rlike(WELL_FORMED_AMOUNT), parsed)
    return parsed


def amount_is_suspicious(c: Column | str) -> Column:
    """True when digit stripping may have changed the value (not well formed)."""
    col = _c(c)
    return col.isNotNull() & ~col.rlike(WELL_FORMED_AMOUNT)
