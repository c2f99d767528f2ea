"""Registry of named queries: a Spark callable and, where SQL can express it, the
equivalent DuckDB oracle text over the same input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baobab.operators.clean import clean_orders
from baobab.plans import model as M
from baobab.sources.catalog import register

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed reference date for the birth-date and age rules, so results are reproducible.
AS_OF = "2026-01-01"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Staging of shared intermediates (opt-in, used by the cluster job runner): input
# folder -> (shared folder, names already written).
_STAGING: dict[str, tuple[str, set[str]]] = {}


def stage_intermediates(sf_dir: str, stage_dir: str) -> None:
    """Write the intermediates shared by many queries (cleaned orders, cleaned
    customers) once under ``stage_dir`` and let later queries read them back: less
    recomputation across queries and a short lineage (a lost executor re-reads the
    staged files instead of re-running the cleaning)."""
    _STAGING[sf_dir] = (stage_dir.rstrip("/"), set())


def wh(spark: SparkSession, sf_dir: str) -> M.Warehouse:
    return M.Warehouse(spark, sf_dir)


def staged(w: M.Warehouse, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, or its staged copy when staging is on for this input."""
    if w.root not in _STAGING:
        return build()
    folder, done = _STAGING[w.root]
    path = f"{folder}/{name}"
    if name not in done:
        build().write.mode("overwrite").parquet(path)
        done.add(name)
    return w.spark.read.parquet(path)


def orders_clean(w: M.Warehouse) -> DataFrame:
    """C8 applied to the orders export (raw text kept as ``montant_raw``)."""
    return staged(w, "orders_clean", lambda: clean_orders(M.orders_raw(w)))


def orders_delivered(w: M.Warehouse) -> DataFrame:
    """Delivered orders. The status is a CASE over the input's status, which no scan can
    filter on, so the input's own status is asked for where the orders are derived."""
    if w.root in _STAGING:
        return orders_clean(w).where(F.col("statut") == M.DELIVERED)
    return clean_orders(M.orders_raw(w, delivered_only=True))


# Temporary views of the SQL queries.
VIEWS: dict[str, Callable[[M.Warehouse], DataFrame]] = {
    "clients": M.customers_raw, "commandes": M.orders_raw, "commandes_clean": orders_clean,
    "produits": M.products, "paiements": M.payments_raw, "lignes_commande": M.order_items,
    "evenements": M.events_nav}


def register_views(spark: SparkSession, sf_dir: str, *names: str, **others: DataFrame) -> None:
    """Register the named views and ``others``; tables nobody names aren't opened."""
    register({n: VIEWS[n](wh(spark, sf_dir)) for n in names} | others)
