"""Every registered query against its DuckDB SQL on the driver tables (sf0.001)."""

import pytest

from __spark_entry__ import entry
from carelake.compare import compare, duck
from carelake.oracle import all_sql as oracle_sql
from carelake.plans.registry import all_queries as queries

NAMES = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, small_dir, con, name):
    res = compare(queries()[name](spark, small_dir), con, oracle_sql()[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["match"], res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "member_cumulative_paid" in df.columns


def test_raw_feed_exercises_every_rule(spark, small_dir):
    from pyspark.sql import functions as F

    errs = queries()["e2_validation_errors"](spark, small_dir)
    rules = {r.rule for r in errs.select("rule").distinct().collect()}
    assert rules == {"NULL_VALUE", "UNKNOWN_CLAIM_TYPE", "UNKNOWN_CLAIM_STATUS", "NON_NUMERIC", "BAD_DATE"}
    # some rows carry two failed checks
    per_row = errs.groupBy("claim_id").count().agg(F.max("count")).first()[0]
    assert per_row >= 2
