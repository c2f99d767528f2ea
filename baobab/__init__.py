"""E-commerce analytics on Spark: cleaning, KPIs, join audits, funnels, windows,
data-quality audits and streaming counterparts, as DataFrame/SQL jobs.

Entry points: :mod:`baobab.session` (session and shared folder),
:mod:`baobab.operators` (DataFrame -> DataFrame operators), :mod:`baobab.plans`
(registered queries and their SQL oracles), :mod:`baobab.job` (spark-submit runner).
"""

__version__ = "0.1.0"
