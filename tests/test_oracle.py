"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import os

import pytest

from tools.oracle_check import check

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    assert check(spark, SF, verbose=False) == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert set(df.columns) == {"canal", "nb_commandes", "ca_fcfa", "panier_moyen_fcfa"}
    assert df.count() >= 1
    assert set(E.oracle_sql()) <= set(E.queries())
