"""Cleaning steps on the reference's unit-test cases."""

import datetime as dt

from pyspark.sql.types import StringType, StructField, StructType
from pyspark.testing import assertDataFrameEqual

from baobab.operators import clean


def _one(spark, col, values):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField(col, StringType())]))


def test_unify_missing(spark):
    src = ["", "N/A", "n/a", "NULL", "  N/A  ", "  NULL  ", None, "user@test.com",
           "  user@test.com  ", "N/A@test.com", "   "]
    exp = [None] * 7 + ["user@test.com", "user@test.com", "N/A@test.com", None]
    out = clean.unify_missing(_one(spark, "email", src))
    assertDataFrameEqual(out, _one(spark, "email", exp), checkRowOrder=True)


def test_unify_missing_is_case_sensitive(spark):
    out = clean.unify_missing(_one(spark, "email", ["null", "N/a"])).collect()
    assert [r.email for r in out] == ["null", "N/a"]


def test_normalize_email(spark):
    df = spark.createDataFrame(
        [("1", "  USER@EXAMPLE.COM  "), ("2", "test@gmail.com"), ("3", "email-invalide"),
         ("4", "test@domaine"), ("5", None)], "customer_id string, email string")
    got = {r.customer_id: (r.email, r.email_valide) for r in clean.normalize_email(df).collect()}
    assert got == {"1": ("user@example.com", True), "2": ("test@gmail.com", True),
                   "3": ("email-invalide", False), "4": ("test@domaine", False), "5": (None, None)}


def test_missing_then_email_chain(spark):
    df = _one(spark, "email", ["  N/A  ", "  EXEMPLE@DOMAIN.SN  "])
    rows = df.transform(clean.unify_missing).transform(clean.normalize_email).collect()
    assert (rows[0].email, rows[0].email_valide) == (None, None)
    assert (rows[1].email, rows[1].email_valide) == ("exemple@domain.sn", True)


def test_normalize_city(spark):
    df = spark.createDataFrame([("C1", " Thiès "), ("C2", "THIES"), ("C3", "thiès"),
                                ("C4", " Dakar "), ("C5", None), ("C6", "SAINT-LOUIS"),
                                ("C7", "Sédhiou"), ("C8", "Kédougou"), ("C9", "Guédiawaye")],
                               "customer_id string, ville string")
    got = {r.customer_id: (r.ville, r.ville_norm) for r in clean.normalize_city(df).collect()}
    assert {got[k][1] for k in ("C1", "C2", "C3")} == {"thies"}
    assert got["C4"] == ("Dakar", "dakar")
    assert got["C5"] == (None, None)
    assert got["C6"] == ("Saint-louis", "saint-louis")  # initcap splits on spaces only
    assert got["C7"][1] == "sedhiou" and got["C8"][1] == "kedougou" and got["C9"][1] == "guediawaye"


def test_strip_accents_is_nfkd_on_the_latin_blocks(spark):
    import unicodedata

    from baobab.functions.text import strip_accents, strip_accents_nfkd
    letters = [f"a{chr(c)}b" for c in range(0x00C0, 0x0250)]
    marks = [f"e{chr(c)}s" for c in range(0x0300, 0x0370)]
    texts = letters + marks + ["Thiès Sédhiou", unicodedata.normalize("NFD", "Thiès Sédhiou"), "Ĳsselmeer Ǆ ŀ", "", None]
    df = _one(spark, "s", texts)
    want = {t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts if t is not None}
    for r in df.select("s", strip_accents("s").alias("a"), strip_accents_nfkd("s").alias("b")).collect():
        assert r.a == want.get(r.s) and r.b == want.get(r.s), r


def test_normalize_phone(spark):
    df = spark.createDataFrame([("1", "+221 77 123 45 67"), ("2", "77-123-45-67"), ("3", "77 123 45 67"),
                                ("4", "33 820 00 00"), ("5", "abc"), ("6", None)],
                               "customer_id string, telephone string")
    got = {r.customer_id: r.tel_valide for r in clean.normalize_phone(df).collect()}
    assert got == {"1": True, "2": True, "3": True, "4": False, "5": False, "6": None}


def test_validate_birthdate(spark):
    df = spark.createDataFrame([("1", "2000-05-10"), ("2", "1920-01-01"), ("3", "1919-12-31"),
                                ("4", "2999-01-01"), ("5", "abc"), ("6", None)],
                               "customer_id string, date_naissance string")
    got = {r.customer_id: r.date_naissance
           for r in clean.validate_birthdate(df, as_of="2026-01-01").collect()}
    assert got == {"1": dt.date(2000, 5, 10), "2": dt.date(1920, 1, 1), "3": None, "4": None,
                   "5": None, "6": None}


def test_dedup_customers(spark):
    rows = [("C001", "ancien@exemple.sn", "2025-01-01"), ("C001", "nouveau@exemple.sn", "2026-01-01"),
            ("C001", "ancien@exemple.sn", "2025-01-01"), ("C002", "autre@exemple.sn", "2026-01-15"),
            ("C002", "autre@exemple.sn", "2026-01-15"), ("C003", "recent3@exemple.sn", "2026-02-01")]
    df = spark.createDataFrame(rows, "customer_id string, email string, date_inscription string")
    out = clean.dedup_customers(df)
    exp = spark.createDataFrame([("C001", "nouveau@exemple.sn", "2026-01-01"),
                                 ("C002", "autre@exemple.sn", "2026-01-15"),
                                 ("C003", "recent3@exemple.sn", "2026-02-01")], df.schema)
    assertDataFrameEqual(out, exp)


def test_dedup_tie_is_deterministic(spark):
    rows = [("C1", "b@x.sn", "2025-01-01"), ("C1", "a@x.sn", "2025-01-01"), ("C1", None, "2025-01-01")]
    df = spark.createDataFrame(rows, "customer_id string, email string, date_inscription string")
    for _ in range(2):
        assert clean.dedup_customers(df.repartition(3)).collect()[0].email == "b@x.sn"


def test_clean_orders_amounts(spark):
    df = spark.createDataFrame([("12500",), ("12500 FCFA",), (" 7 000 ",), ("-12.50",), ("",), (None,)],
                               "montant_total_fcfa string")
    rows = clean.clean_orders(df).collect()
    assert [r.montant_fcfa for r in rows] == [12500, 12500, 7000, 1250, None, None]
    assert [r.montant_suspect for r in rows] == [False, False, True, True, True, False]
    strict = clean.clean_orders(df, strict=True).collect()
    assert [r.montant_fcfa for r in strict] == [12500, 12500, None, None, None, None]


def test_currency_suffix_any_case_is_well_formed(spark):
    df = spark.createDataFrame([("12500 fcfa",), ("12500 Fcfa",), ("12.500",)], "montant_total_fcfa string")
    rows = clean.clean_orders(df, strict=True).collect()
    assert [r.montant_fcfa for r in rows] == [12500, 12500, None]
    assert [r.montant_suspect for r in rows] == [False, False, True]
