"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from kestrel.plans import catalog, oracle
from tests.compare import diff, duck_rows, spark_rows
from tests.conftest import SF_DIR

QUERIES = catalog.all_queries()
ORACLES = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    assert name in QUERIES, f"oracle without query: {name}"
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    want = duck_rows(duck, ORACLES[name])
    problems = diff(got, want)
    assert not problems, "\n".join(problems)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["day_name", "count", "percentage"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_lists_every_catalog_query():
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(ORACLES) <= set(entry_mod.oracle_sql())
