"""Every registered query with a SQL twin equals DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry
from segmint.plans.queries import QUERIES as OWN
from oracle_compare import compare, duck

from conftest import SF_SMALL

QUERIES = entry.queries()
SQL = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_every_query_of_the_library_has_sql():
    from segmint.plans.oracle import SQL as own
    from segmint.plans.queries import QUERIES as registered

    assert set(registered) == set(own)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"cluster_id", "cluster_member_count", "private", "cluster_diameter", "cluster_wssse", "dimensions"} <= set(df.columns)
