"""Named queries (Spark) and their SQL oracles, registered on import."""

from baobab.plans import audits, cleaning, funnel, joins, kpis, streams  # noqa: F401  (registration)
from baobab.plans.base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
