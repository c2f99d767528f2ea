"""Logical e-commerce tables derived from the star-schema input tables.

The analytics operate on six logical tables (customer file, orders, order lines,
products, payments, navigation events). The input warehouse holds TPC-H-like
tables, so each logical table is a projection of them, computed by Spark at read
time; the whole input is always used. The customer file, orders and payments feeds
carry deterministic data-quality defects (the defects a raw export has: missing and
malformed e-mails, heterogeneous phone formats, inconsistent city spelling,
implausible birth dates, exact and near duplicate rows, amounts stored as text,
unknown keys, at-least-once duplicates). Each defect is a fixed rule of the row key,
so the same rows can be rebuilt in any SQL engine (see ``plans.oracle``).

Keys stay numeric (``customer_id`` = ``c_custkey`` ...): joins and shuffles on
BIGINT are cheaper than on formatted strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# ---------------------------------------------------------------------------
# Fixed values of the defect rules (shared with the SQL oracle)
# ---------------------------------------------------------------------------
EMAIL_DOMAINS = [f"courrier{i}.example" for i in range(5)]
NEW_DOMAIN = "nouveau.example"
# What stands before a phone number and between its groups (k % 4).
PHONE_STYLES = [("+221", ""), ("", ""), ("+221 ", " "), ("", "-")]
MOBILE_PREFIXES = ["70", "75", "76", "77", "78"]
PAYMENT_METHODS = {  # order priority -> payment method
    "1-URGENT": "Orange Money",
    "2-HIGH": "Wave",
    "3-MEDIUM": "Carte bancaire",
    "4-NOT SPECIFIED": "Paiement à la livraison",
}
PAYMENT_METHOD_OTHER = "Free Money"
MOBILE_MONEY = ["Orange Money", "Wave", "Free Money"]
# payment status spelling by order_id % 20
PAYMENT_STATUS_RULE = [(8, "REUSSI"), (12, "reussi"), (15, "Réussi"), (17, "OK"),
                       (19, "succes"), (20, "ECHEC")]
MOBILE_CHANNEL_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
EVENT_TYPES = {"view": "view_product", "click": "add_to_cart", "purchase": "purchase",
               "signup": "page_view", "error": "search"}
DELIVERED, IN_PROGRESS, CANCELLED, RETURNED = "livrée", "en_cours", "annulée", "retournée"
# ---------------------------------------------------------------------------


@dataclass
class Warehouse:
    """Lazy access to the input parquet tables of one scale factor."""

    spark: SparkSession
    root: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


# Added to the customer number of orders whose customer is unknown.
ORPHAN_SHIFT = 1_000_000_000_000


def _mod(c: Column | str, m: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col % F.lit(m)


def _s(c: Column) -> Column:
    return c.cast("string")


def _case_list(key: Column, values: list[str]) -> Column:
    """values[key % len(values)]"""
    k = _mod(key, len(values))
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(k == i, F.lit(values[i])).otherwise(out)
    return out


def _date_text(start: str, offset: Column) -> Column:
    return F.date_format(F.date_add(F.lit(start).cast("date"), offset.cast("int")), "yyyy-MM-dd")


# --------------------------------------------------------------------------- customers
def customers_clean_reference(w: Warehouse) -> DataFrame:
    """Master customer reference (no defects), one row per customer."""
    c = w("customer").select("c_custkey", "c_name", "c_nationkey")
    n = w("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = w("region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    prefix = _case_list(k, MOBILE_PREFIXES)
    suffix = F.lpad(_s((k * F.lit(7919)) % F.lit(10_000_000)), 7, "0")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(
                 k.alias("customer_id"),
                 F.substring_index("c_name", "#", 1).alias("prenom"),
                 F.substring_index("c_name", "#", -1).alias("nom"),
                 F.concat(F.lit("client"), _s(k), F.lit("@"),
                          _case_list(k, EMAIL_DOMAINS)).alias("email"),
                 prefix.alias("_prefix"), suffix.alias("_suffix"),
                 F.col("n_name").alias("ville"),
                 F.col("r_name").alias("region"),
                 _date_text("1958-01-01", (k * F.lit(37)) % F.lit(17500)).alias("date_naissance"),
                 _date_text("2022-01-01", (k * F.lit(13)) % F.lit(1600)).alias("date_inscription"),
             ))


def customers_raw(w: Warehouse) -> DataFrame:
    """The raw customer export with its defects.

    Defect rules (k = customer_id):
      nom padded when k%50=3; email '' (k%100=11), 'N/A' (23), NULL (37), upper-cased
      and padded (41), no TLD (59), 'n/a' (67), 'NULL' (73); phone in four formats
      by k%4, landline when k%100=13, 'abc' (29), NULL (97); city lower-cased
      (k%50=2), padded (4), accented (6, 8, 9); birth date 2031-05-14 (k%200=17),
      1900-01-01 (91), 'abc' (133), dd/MM/yyyy (151). Every customer is exported. Rows
      with k%300=19 are sent twice, rows with k%500=21 again with an upper-cased
      e-mail, and rows with k%400=33 again with a newer registration and e-mail.
    """
    base = customers_clean_reference(w)
    k = F.col("customer_id")
    m100, m50, m200 = _mod(k, 100), _mod(k, 50), _mod(k, 200)
    email = (F.when(m100 == 11, F.lit(""))
              .when(m100 == 23, F.lit("N/A"))
              .when(m100 == 37, F.lit(None).cast("string"))
              .when(m100 == 41, F.concat(F.lit("  "), F.upper("email"), F.lit(" ")))
              .when(m100 == 59, F.concat(F.lit("client"), _s(k), F.lit("@domaine")))
              .when(m100 == 67, F.lit("n/a"))
              .when(m100 == 73, F.lit("NULL"))
              .otherwise(F.col("email")))
    groups = [F.col("_prefix"), *(F.substring("_suffix", at, n) for at, n in ((1, 3), (4, 2), (6, 2)))]
    styled = F.get(F.array(*(F.concat(F.lit(lead), F.concat_ws(sep, *groups)) for lead, sep in PHONE_STYLES)),
                   _mod(k, len(PHONE_STYLES)).cast("int"))
    phone = (F.when(m100 == 13, F.lit("33 820 00 00"))
              .when(m100 == 29, F.lit("abc"))
              .when(m100 == 97, F.lit(None).cast("string"))
              .otherwise(styled))
    city = (F.when(m50 == 2, F.lower("ville"))
             .when(m50 == 4, F.concat(F.lit(" "), F.col("ville"), F.lit(" ")))
             .when(m50 == 6, F.replace(F.col("ville"), F.lit("A"), F.lit("À")))
             .when(m50 == 8, F.replace(F.lower("ville"), F.lit("a"), F.lit("â")))
             .when(m50 == 9, F.replace(F.col("ville"), F.lit("N"), F.lit("Ñ")))
             .otherwise(F.col("ville")))
    birth = (F.when(m200 == 17, F.lit("2031-05-14"))
              .when(m200 == 91, F.lit("1900-01-01"))
              .when(m200 == 133, F.lit("abc"))
              .when(m200 == 151, F.date_format(F.to_date("date_naissance"), "dd/MM/yyyy"))
              .otherwise(F.col("date_naissance")))
    nom = F.when(m50 == 3, F.concat(F.lit("  "), F.col("nom"), F.lit(" "))).otherwise(F.col("nom"))
    # One scan: every exported row carries the list of copies it is sent as
    # (0 = original, 1 = exact copy, 2 = upper-cased e-mail, 3 = re-registration),
    # exploded in place instead of a union that would re-read the table per copy.
    copies = F.filter(F.array(F.lit(0),
                              F.when(_mod(k, 300) == 19, F.lit(1)),
                              F.when(_mod(k, 500) == 21, F.lit(2)),
                              F.when(_mod(k, 400) == 33, F.lit(3))), lambda v: v.isNotNull())
    raw = (base.select("customer_id", "prenom", nom.alias("nom"), email.alias("email"),
                       phone.alias("telephone"), city.alias("ville"), "region",
                       birth.alias("date_naissance"), "date_inscription",
                       F.explode(copies).alias("_copy")))
    v = F.col("_copy")
    return raw.select(
        "customer_id", "prenom", "nom",
        F.when(v == 2, F.upper("email"))
         .when(v == 3, F.concat(F.lit("nouveau"), _s(k), F.lit("@" + NEW_DOMAIN)))
         .otherwise(F.col("email")).alias("email"),
        "telephone", "ville", "region", "date_naissance",
        F.when(v == 3, F.date_format(F.date_add(F.to_date("date_inscription"), 30), "yyyy-MM-dd"))
         .otherwise(F.col("date_inscription")).alias("date_inscription"))


# --------------------------------------------------------------------------- orders
def status_of(orderstatus: Column, key: Column) -> Column:
    return (F.when(orderstatus == "F", F.lit(DELIVERED))
             .when(orderstatus == "O", F.lit(IN_PROGRESS))
             .when(_mod(key, 5) == 0, F.lit(RETURNED))
             .otherwise(F.lit(CANCELLED)))


def amount_of(totalprice: Column) -> Column:
    return F.round(totalprice).cast("bigint")


def orders_raw(w: Warehouse, delivered_only: bool = False) -> DataFrame:
    """Orders export: amount as text; ' FCFA' suffix when k%100=0, ' fcfa' when
    k%1000=250, a spurious '.00' decimal part when k%1000=625 (k = order_id). Orphans:
    the customer number is shifted by ``ORPHAN_SHIFT`` when k%12=5 and for every order
    of customers with number%97=13, who so have no order of their own.
    ``delivered_only`` keeps delivered orders, by a filter that reaches the scan."""
    o = w("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "o_orderpriority")
    if delivered_only:
        o = o.where(F.col("o_orderstatus") == "F")
    k = F.col("o_orderkey")
    amt = _s(amount_of(F.col("o_totalprice")))
    text = (F.when(_mod(k, 100) == 0, F.concat(amt, F.lit(" FCFA")))
             .when(_mod(k, 1000) == 250, F.concat(amt, F.lit(" fcfa")))
             .when(_mod(k, 1000) == 625, F.concat(amt, F.lit(".00")))
             .otherwise(amt))
    return o.select(
        k.alias("order_id"),
        F.when((_mod(k, 12) == 5) | (_mod("o_custkey", 97) == 13), F.col("o_custkey") + F.lit(ORPHAN_SHIFT))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").alias("date_commande"),
        status_of(F.col("o_orderstatus"), k).alias("statut"),
        F.when(F.col("o_orderpriority").isin(*MOBILE_CHANNEL_PRIORITIES), F.lit("mobile_app"))
         .otherwise(F.lit("web")).alias("canal"),
        (F.lit(500) * (F.lit(1) + _mod(k, 5))).cast("int").alias("frais_livraison_fcfa"),
        text.alias("montant_total_fcfa"),
        F.col("o_orderpriority").alias("priorite"),
    )


def order_items(w: Warehouse) -> DataFrame:
    """Order lines: quantity and unit price (extended price / quantity, rounded)."""
    li = w("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                              "l_extendedprice")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("ligne"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantite"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint").alias("prix_unitaire_fcfa"),
    )


def products(w: Warehouse) -> DataFrame:
    p = w("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("nom_produit"),
        F.col("p_type").alias("categorie"),
        F.col("p_brand").alias("marque"),
        F.round("p_retailprice").cast("bigint").alias("prix_unitaire_fcfa"),
        F.col("p_size").alias("stock"),
    )


# --------------------------------------------------------------------------- payments
def payment_method(priority: Column) -> Column:
    out = F.lit(PAYMENT_METHOD_OTHER)
    for prio, method in reversed(list(PAYMENT_METHODS.items())):
        out = F.when(priority == prio, F.lit(method)).otherwise(out)
    return out


def payments_raw(w: Warehouse) -> DataFrame:
    """Payments feed for every order that isn't cancelled (returned ones were paid).

    Defects (k = order_id): status spelling by k%20; negative amount when
    k%1000=7; half amount when k%200=3; unknown order_id (k + 10^12) when k%300=5;
    rows with k%125=7 delivered twice (at-least-once).
    """
    o = w("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    amt = amount_of(F.col("o_totalprice"))
    amount = (F.when(_mod(k, 1000) == 7, -amt)
               .when(_mod(k, 200) == 3, F.floor(amt / F.lit(2)).cast("bigint"))
               .otherwise(amt))
    m20 = _mod(k, 20)
    status = F.lit(PAYMENT_STATUS_RULE[-1][1])
    for bound, label in reversed(PAYMENT_STATUS_RULE[:-1]):
        status = F.when(m20 < bound, F.lit(label)).otherwise(status)
    base = o.where(status_of(F.col("o_orderstatus"), k) != CANCELLED).select(
        k.alias("payment_id"),
        F.when(_mod(k, 300) == 5, k + F.lit(1_000_000_000_000)).otherwise(k).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        amount.alias("montant_fcfa"),
        payment_method(F.col("o_orderpriority")).alias("methode"),
        status.alias("statut"),
        F.timestamp_add("SECOND", (F.lit(30) + _mod(k, 7170)).cast("int"),
                        F.col("o_orderdate")).alias("paid_at"),
    )
    # at-least-once delivery: the rows concerned are emitted twice (single scan)
    twice = F.when(_mod(F.col("payment_id"), 125) == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.withColumn("_copy", F.explode(twice)).drop("_copy")


# --------------------------------------------------------------------------- events
def events_nav(w: Warehouse) -> DataFrame:
    """Navigation events: one session per user and day (``session_id`` =
    user_id * 10^6 + days since 1970-01-01); device by event_id%50
    (0-38 mobile, 39-48 desktop, 49 tablette); purchases carry ``order_id`` =
    event_id."""
    e = w("events").select("event_id", "ts", "user_id", "event_type")
    etype = F.lit(None).cast("string")
    for src, dst in reversed(list(EVENT_TYPES.items())):
        etype = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(etype)
    m50 = _mod("event_id", 50)
    return e.select(
        "event_id",
        F.col("ts").alias("event_time"),
        "user_id",
        # one session per user and calendar day, as a BIGINT (cheap to hash and shuffle)
        (F.col("user_id") * F.lit(1_000_000) + F.unix_date(F.to_date("ts"))).alias("session_id"),
        etype.alias("event_type"),
        F.when(m50 < 39, F.lit("mobile")).when(m50 < 49, F.lit("desktop"))
         .otherwise(F.lit("tablette")).alias("device"),
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("order_id"),
    )


def user_cities(w: Warehouse) -> DataFrame:
    """City of each user (the nation of the customer with the same key)."""
    c = w("customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    n = w("nation").select("n_nationkey", F.col("n_name").alias("ville"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("user_id", "ville")


def events_arrivals(w: Warehouse) -> DataFrame:
    """Events in arrival order (``event_id``) where every 100th event arrives 30
    minutes late: its event time is 30 minutes before its capture time."""
    e = events_nav(w)
    return e.withColumn(
        "event_time",
        F.when(_mod("event_id", 100) == 0,
               F.col("event_time") - F.expr("INTERVAL 30 MINUTES"))
         .otherwise(F.col("event_time")))


def documents_text(w: Warehouse) -> DataFrame:
    return w("documents").select("doc_id", F.col("text").alias("value"))
