"""Registered queries against their DuckDB oracle on the sf0.001 tables."""

import os

import pytest

from ledgerline.plans import registry

SF = "/root/testdata/sf0.001"
EVERY = sorted(registry.oracle_sql())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", EVERY)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    from tools.oracle_check import compare, duck_conn
    df = E.queries()[name](spark, SF)
    cur = duck_conn(SF).execute(E.oracle_sql()[name])
    ok, msg = compare(df.collect(), df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert ok, msg


def test_every_oracle_key_is_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_entry_runs(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
