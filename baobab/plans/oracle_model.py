"""The logical tables of ``plans.model`` written as DuckDB SQL (CTE bodies).

Used only to build the independent SQL oracle of each registered query; the rules
are the same fixed values as in ``plans.model``.
"""

from __future__ import annotations

from baobab.plans import model as M


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_list(key: str, values: list[str]) -> str:
    n = len(values)
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values[:-1]))
    return f"(CASE ({key}) % {n} {whens} ELSE {_q(values[-1])} END)"


def _date_text(start: str, offset: str) -> str:
    return f"strftime(DATE '{start}' + CAST({offset} AS INTEGER), '%Y-%m-%d')"


CUSTOMERS_REF = f"""
SELECT c.c_custkey AS customer_id,
       split_part(c.c_name, '#', 1) AS prenom,
       split_part(c.c_name, '#', 2) AS nom,
       'client' || CAST(c.c_custkey AS VARCHAR) || '@' || {_case_list('c.c_custkey', M.EMAIL_DOMAINS)} AS email,
       {_case_list('c.c_custkey', M.MOBILE_PREFIXES)} AS _prefix,
       lpad(CAST((c.c_custkey * 7919) % 10000000 AS VARCHAR), 7, '0') AS _suffix,
       n.n_name AS ville,
       r.r_name AS region,
       {_date_text('1958-01-01', '(c.c_custkey * 37) % 17500')} AS date_naissance,
       {_date_text('2022-01-01', '(c.c_custkey * 13) % 1600')} AS date_inscription
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_PHONES = " ".join(
    f"WHEN {i} THEN {_q(lead)} || concat_ws({_q(sep)}, _prefix, _suffix[1:3], _suffix[4:5], _suffix[6:7])"
    for i, (lead, sep) in enumerate(M.PHONE_STYLES))

CUSTOMERS_RAW_BASE = f"""
SELECT customer_id, prenom,
  CASE WHEN customer_id % 50 = 3 THEN '  ' || nom || ' ' ELSE nom END AS nom,
  CASE WHEN customer_id % 100 = 11 THEN ''
       WHEN customer_id % 100 = 23 THEN 'N/A'
       WHEN customer_id % 100 = 37 THEN NULL
       WHEN customer_id % 100 = 41 THEN '  ' || upper(email) || ' '
       WHEN customer_id % 100 = 59 THEN 'client' || CAST(customer_id AS VARCHAR) || '@domaine'
       WHEN customer_id % 100 = 67 THEN 'n/a'
       WHEN customer_id % 100 = 73 THEN 'NULL'
       ELSE email END AS email,
  CASE WHEN customer_id % 100 = 13 THEN '33 820 00 00'
       WHEN customer_id % 100 = 29 THEN 'abc'
       WHEN customer_id % 100 = 97 THEN NULL
       ELSE CASE customer_id % {len(M.PHONE_STYLES)} {_PHONES} END END AS telephone,
  CASE WHEN customer_id % 50 = 2 THEN lower(ville)
       WHEN customer_id % 50 = 4 THEN ' ' || ville || ' '
       WHEN customer_id % 50 = 6 THEN replace(ville, 'A', 'À')
       WHEN customer_id % 50 = 8 THEN replace(lower(ville), 'a', 'â')
       WHEN customer_id % 50 = 9 THEN replace(ville, 'N', 'Ñ')
       ELSE ville END AS ville,
  region,
  CASE WHEN customer_id % 200 = 17 THEN '2031-05-14'
       WHEN customer_id % 200 = 91 THEN '1900-01-01'
       WHEN customer_id % 200 = 133 THEN 'abc'
       WHEN customer_id % 200 = 151 THEN strftime(CAST(date_naissance AS DATE), '%d/%m/%Y')
       ELSE date_naissance END AS date_naissance,
  date_inscription
FROM customers_ref
"""

CUSTOMERS_RAW = f"""
SELECT * FROM customers_base
UNION ALL SELECT * FROM customers_base WHERE customer_id % 300 = 19
UNION ALL SELECT customer_id, prenom, nom, upper(email) AS email, telephone, ville, region,
                 date_naissance, date_inscription
          FROM customers_base WHERE customer_id % 500 = 21
UNION ALL SELECT customer_id, prenom, nom,
                 'nouveau' || CAST(customer_id AS VARCHAR) || '@' || '{M.NEW_DOMAIN}' AS email,
                 telephone, ville, region, date_naissance,
                 strftime(CAST(date_inscription AS DATE) + 30, '%Y-%m-%d') AS date_inscription
          FROM customers_base WHERE customer_id % 400 = 33
"""


def _status(orderstatus: str, key: str) -> str:
    return (f"CASE WHEN {orderstatus} = 'F' THEN {_q(M.DELIVERED)} "
            f"WHEN {orderstatus} = 'O' THEN {_q(M.IN_PROGRESS)} "
            f"WHEN {key} % 5 = 0 THEN {_q(M.RETURNED)} ELSE {_q(M.CANCELLED)} END")


_MOBILE = ", ".join(_q(p) for p in M.MOBILE_CHANNEL_PRIORITIES)

ORDERS_RAW = f"""
SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 12 = 5 OR o_custkey % 97 = 13 THEN o_custkey + {M.ORPHAN_SHIFT} ELSE o_custkey END AS customer_id,
  o_orderdate AS date_commande,
  {_status('o_orderstatus', 'o_orderkey')} AS statut,
  CASE WHEN o_orderpriority IN ({_MOBILE}) THEN 'mobile_app' ELSE 'web' END AS canal,
  CAST(500 * (1 + o_orderkey % 5) AS INTEGER) AS frais_livraison_fcfa,
  CASE WHEN o_orderkey % 100 = 0 THEN CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) || ' FCFA'
       WHEN o_orderkey % 1000 = 250 THEN CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) || ' fcfa'
       WHEN o_orderkey % 1000 = 625 THEN CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) || '.00'
       ELSE CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) END AS montant_total_fcfa,
  o_orderpriority AS priorite
FROM orders
"""

# C8 in SQL: digits only then a safe cast; flag for texts that are not plain amounts.
ORDERS_CLEAN = r"""
SELECT order_id, customer_id, date_commande, statut, canal, frais_livraison_fcfa, priorite,
  TRY_CAST(regexp_replace(trim(montant_total_fcfa), '[^0-9]', '', 'g') AS BIGINT) AS montant_fcfa,
  (montant_total_fcfa IS NOT NULL
     AND NOT regexp_matches(montant_total_fcfa, '^\s*[0-9]+(\s*(?i:FCFA))?\s*$')) AS montant_suspect,
  montant_total_fcfa AS montant_raw
FROM orders_raw
"""

ORDER_ITEMS = """
SELECT l_orderkey AS order_id, l_linenumber AS ligne, l_partkey AS product_id,
  CAST(l_quantity AS BIGINT) AS quantite,
  CAST(round(l_extendedprice / l_quantity) AS BIGINT) AS prix_unitaire_fcfa
FROM lineitem
"""

PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS nom_produit, p_type AS categorie, p_brand AS marque,
  CAST(round(p_retailprice) AS BIGINT) AS prix_unitaire_fcfa, p_size AS stock
FROM part
"""


def _method(priority: str) -> str:
    whens = " ".join(f"WHEN {priority} = {_q(k)} THEN {_q(v)}" for k, v in M.PAYMENT_METHODS.items())
    return f"CASE {whens} ELSE {_q(M.PAYMENT_METHOD_OTHER)} END"


def _pay_status(key: str) -> str:
    whens = " ".join(f"WHEN {key} % 20 < {b} THEN {_q(lbl)}" for b, lbl in M.PAYMENT_STATUS_RULE[:-1])
    return f"CASE {whens} ELSE {_q(M.PAYMENT_STATUS_RULE[-1][1])} END"


PAYMENTS_BASE = f"""
SELECT o_orderkey AS payment_id,
  CASE WHEN o_orderkey % 300 = 5 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS order_id,
  o_custkey AS customer_id,
  CASE WHEN o_orderkey % 1000 = 7 THEN -CAST(round(o_totalprice) AS BIGINT)
       WHEN o_orderkey % 200 = 3 THEN CAST(floor(CAST(round(o_totalprice) AS BIGINT) / 2) AS BIGINT)
       ELSE CAST(round(o_totalprice) AS BIGINT) END AS montant_fcfa,
  {_method('o_orderpriority')} AS methode,
  {_pay_status('o_orderkey')} AS statut,
  o_orderdate + to_seconds(CAST(30 + o_orderkey % 7170 AS BIGINT)) AS paid_at
FROM orders WHERE {_status('o_orderstatus', 'o_orderkey')} <> {_q(M.CANCELLED)}
"""

PAYMENTS_RAW = """
SELECT * FROM payments_base
UNION ALL SELECT * FROM payments_base WHERE payment_id % 125 = 7
"""


def _etype(col: str) -> str:
    whens = " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in M.EVENT_TYPES.items())
    return f"CASE {whens} ELSE NULL END"


EVENTS_NAV = f"""
SELECT event_id, ts AS event_time, user_id,
  user_id * 1000000 + (CAST(ts AS DATE) - DATE '1970-01-01') AS session_id,
  {_etype('event_type')} AS event_type,
  CASE WHEN event_id % 50 < 39 THEN 'mobile' WHEN event_id % 50 < 49 THEN 'desktop'
       ELSE 'tablette' END AS device,
  CASE WHEN event_type = 'purchase' THEN event_id END AS order_id
FROM events
"""

EVENTS_CITY = """
SELECT e.*, n.n_name AS ville
FROM events_nav e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

EVENTS_ARRIVALS = """
SELECT event_id,
  CASE WHEN event_id % 100 = 0 THEN event_time - INTERVAL 30 MINUTE ELSE event_time END AS event_time,
  user_id, session_id, event_type, device, order_id
FROM events_nav
"""

# name -> (body, dependencies)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "customers_ref": (CUSTOMERS_REF, []),
    "customers_base": (CUSTOMERS_RAW_BASE, ["customers_ref"]),
    "customers_raw": (CUSTOMERS_RAW, ["customers_base"]),
    "orders_raw": (ORDERS_RAW, []),
    "orders_clean": (ORDERS_CLEAN, ["orders_raw"]),
    "order_items": (ORDER_ITEMS, []),
    "products": (PRODUCTS, []),
    "payments_base": (PAYMENTS_BASE, []),
    "payments_raw": (PAYMENTS_RAW, ["payments_base"]),
    "events_nav": (EVENTS_NAV, []),
    "events_city": (EVENTS_CITY, ["events_nav"]),
    "events_arrivals": (EVENTS_ARRIVALS, ["events_nav"]),
}


def with_views(sql: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (dependencies first), then ``extra``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({VIEWS[n][0]})" for n in order]
    ctes += [f"{n} AS ({body})" for n, body in (extra or [])]
    if not ctes:
        return sql
    if sql.lstrip().startswith("WITH"):  # a body with CTEs of its own
        sql = f"SELECT * FROM ({sql})"
    return "WITH " + ",\n".join(ctes) + "\n" + sql
