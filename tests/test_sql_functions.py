"""Report functions called from SQL text give the rows of the Python forms, at any parameters."""

import pytest

from carelake.operators.readmission import readmission_pairs
from carelake.plans import analytics as A
from carelake.schema import RAW_FIELDS
from carelake.sources.layer import claims_layer
from carelake.sources.sql_functions import create_report_functions


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def claims(spark, small_dir):
    df = claims_layer(spark, small_dir).select(*RAW_FIELDS)
    df.createOrReplaceTempView("claims_here")
    create_report_functions(spark, "claims_here", prefix="t_")
    return df


@pytest.mark.parametrize("days", [1, 7, 30, 90])
def test_readmissions(spark, claims, days):
    assert rows_of(spark.sql(f"SELECT * FROM t_readmission_pairs({days})")) == rows_of(readmission_pairs(claims, days))


@pytest.mark.parametrize("threshold,top", [(5000, 20), (800000, 3), (10**12, 5)])
def test_high_cost_members(spark, claims, threshold, top):
    assert rows_of(spark.sql(f"SELECT * FROM t_high_cost_members({threshold}, {top})")) == rows_of(A.high_cost_members(claims, threshold, top))
    assert rows_of(spark.sql(f"SELECT * FROM t_all_high_cost_members({threshold})")) == rows_of(A.high_cost_members(claims, threshold, None))


def test_within_other_sql(spark, claims):
    want = sum(r.total_paid for r in A.top_diagnoses_by_spend(claims, 4).collect())
    assert spark.sql("SELECT sum(total_paid) AS s FROM t_top_diagnoses_by_spend(top => 4)").first().s == pytest.approx(want)
    df = spark.sql("SELECT d.* FROM t_denial_rate_by_provider() d WHERE provider_type = 'NURSING'")
    assert rows_of(df) == rows_of(A.denial_rate_by_provider(claims).filter("provider_type = 'NURSING'"))
    # the top rows are taken by each task before one task orders them
    plan = spark.sql("SELECT * FROM t_high_cost_members(top => 7)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=7" in plan
