"""Registered queries against their DuckDB SQL, and the registry itself."""

import re

import pytest

from kestrel.llm import queries
from tests.compare import diff, duck_rows, spark_rows
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = spark_rows(queries.queries()[name](spark, SF_DIR))
    assert got[1]
    problems = diff(got, duck_rows(duck, queries.oracle_sql()[name]))
    assert not problems, "\n".join(problems)


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 14))
