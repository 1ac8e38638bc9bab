"""Reports from rollups equal the direct forms after any loads; sketches merge; medians by counts are exact."""

from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from carelake.operators.distinct import GRAIN, estimate_members, member_sketches, merge_sketches, standard_error
from carelake.operators.ranking import exact_median
from carelake.operators.select_rank import median_by_counts, values_at
from carelake.plans import analytics as A
from carelake.plans import etl as E
from carelake.plans import rollup as R
from carelake.plans.transform import derive
from carelake.schema import RAW_FIELDS
from carelake.sources.layer import claims_layer

DIRECT = {
    "q1_baseline_kpis": A.baseline_kpis,
    "q2_monthly_spend_trend": A.monthly_spend_trend,
    "q3_spend_by_state_plan": A.spend_by_state_plan,
    "q4_high_cost_members": A.high_cost_members,
    "q5_behavioral_utilization": A.behavioral_utilization,
    "q6_denial_rate_by_provider": A.denial_rate_by_provider,
    "q7_top_diagnoses_by_spend": A.top_diagnoses_by_spend,
    "q12_analytics_summary": lambda c: E.analytics_summary(derive(c)),
}


@pytest.fixture(scope="module")
def claims(spark, small_dir):
    rows = claims_layer(spark, small_dir).select(*RAW_FIELDS)
    null = lambda c, n: F.when(F.pmod(F.xxhash64("claim_id", F.lit(c)), F.lit(n)) != 0, F.col(c))
    return rows.withColumns({c: null(c, 11) for c in ("state_code", "provider_type", "diagnosis_code", "paid_amount", "plan_id")})


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_reports_equal_the_direct_forms(spark, claims, tmp_path):
    root = str(tmp_path / "rollup")
    with pytest.raises(FileNotFoundError):
        R.read_rollup(spark, root)
    part = F.pmod(F.xxhash64("claim_id"), F.lit(5))
    loads = [claims.filter(part < 3), claims.limit(0), claims.filter(part == 3), claims.filter(part == 4)]
    for load in loads:
        R.append_rollup(spark, root, load)
    want = {name: rows_of(fn(claims)) for name, fn in DIRECT.items()}
    types = {name: fn(claims).dtypes for name, fn in DIRECT.items()}
    for compacted in (False, True):
        parts = R.read_rollup(spark, root)
        for name, report in R.REPORTS.items():
            got = report(*parts)
            assert (rows_of(got), got.dtypes) == (want[name], types[name]), name
        if not compacted:
            n = parts[0].count()
            R.compact(spark, root)
            assert R.read_rollup(spark, root)[0].count() < n
    assert rows_of(R.high_cost_members(*R.read_rollup(spark, root), threshold=200000, limit=None)) == rows_of(A.high_cost_members(claims, 200000, None))


def test_sketches_merge_to_the_sketch_of_all(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("m"), (F.col("id") % 30_000).cast("string")).alias("member_id"), F.lit("OH").alias("state_code"), F.concat(F.lit("p"), (F.col("id") % 2).cast("string")).alias("plan_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("service_date"), F.lit("PAID").alias("claim_status"),
    )
    parts = member_sketches(rows.filter("id % 3 = 0")).unionByName(member_sketches(rows.filter("id % 3 > 0")))
    for keys, exact in ((["state_code"], 30_000), (["state_code", "plan_id"], 15_000)):
        for r in estimate_members(parts, keys).collect():
            assert abs(r.unique_members - exact) <= 5 * standard_error() * exact
    again = merge_sketches(merge_sketches(parts, GRAIN), ["state_code"]).select(F.hll_sketch_estimate("members")).first()[0]
    assert again == estimate_members(parts, ["state_code"]).first().unique_members
    few = member_sketches(rows.filter("member_id IN ('m1', 'm2', 'm3')"))
    assert estimate_members(few, ["state_code"]).first().unique_members == 3
    assert member_sketches(rows.withColumn("claim_status", F.lit("DENIED"))).count() == 0


@pytest.mark.parametrize("bins", [2, 3, 4096])
def test_median_by_counts(spark, bins):
    cases = [[5], [1, 2], [3, 3, 3], [-7, 0, 0, 9], [-(10**13), 10**13, 4], list(range(-50, 51)), [7] * 40 + [1, 2, 3], [1, 10**14]]
    for values in cases:
        df = spark.createDataFrame([(Decimal(v) / 100,) for v in values] + [(None,)], "v decimal(28,4)")
        assert median_by_counts(df, "v", bins) == median([Decimal(v) / 100 for v in values])
    longs = spark.createDataFrame([(v,) for v in (4, -2, 9, 9, 30)], "v bigint")
    assert median_by_counts(longs, "v", bins) == 9
    assert values_at(longs, "v", [0, 1, 2, 3, 4], bins) == [-2, 4, 9, 9, 30]
    assert median_by_counts(longs.limit(0), "v", bins) is None
    with pytest.raises(TypeError):
        median_by_counts(longs.select(F.col("v").cast("double").alias("v")), "v", bins)


def test_median_equals_the_ranked_one(spark, claims):
    df = claims.select("claim_id", "paid_amount")
    assert float(median_by_counts(df, "paid_amount")) == float(exact_median(df, "paid_amount", "claim_id").first().median)
