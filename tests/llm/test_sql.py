"""Queries that SQL can state, against DuckDB."""

import pytest

from carelake.compare import compare, duck
from carelake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, small_dir, name):
    res = compare(registry.queries()[name](spark, small_dir), duck(small_dir), registry.oracle_sql()[name])
    assert res["columns_match"] and res["spark_rows"] == res["duck_rows"] and res["match"], res


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 14)]
