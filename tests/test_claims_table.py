"""The bucketed claims table: plans without a shuffle, hot members apart, equal to the general forms."""

import pytest
from pyspark.sql import functions as F

from carelake.operators.member_windows import plain_member_windows
from carelake.operators.readmission import readmission_pairs
from carelake.schema import RAW_FIELDS
from carelake.sources import claims_table as C
from carelake.sources.layer import claims_layer


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def claims(spark, small_dir):
    base = claims_layer(spark, small_dir).select(*RAW_FIELDS)
    hot = F.when(F.pmod(F.xxhash64("claim_id"), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("member_id"))
    return base.withColumn("member_id", hot)  # one member holds a third of all claims


@pytest.fixture(scope="module")
def table(spark, claims, tmp_path_factory):
    C.load_claims_table(spark, claims, "claims_test", str(tmp_path_factory.mktemp("table")), buckets=8, hot_rows=500)
    return "claims_test"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_members_of_very_many_claims_lie_apart(spark, claims, table):
    assert {r.member_id for r in spark.table(f"{table}_hot").select("member_id").distinct().collect()} == {"HOT"}
    assert spark.table(table).filter("member_id = 'HOT'").isEmpty()
    assert rows_of(spark.table(f"{table}_all").select(*RAW_FIELDS)) == rows_of(claims)
    assert spark.table(table).schema["paid_amount"].dataType.simpleString() == "decimal(18,4)"


def test_reports_equal_the_general_forms(spark, claims, table):
    want = plain_member_windows(claims)
    assert rows_of(C.table_member_windows(spark, table).select(want.columns)) == rows_of(want)
    for days in (1, 30, 400):
        assert rows_of(C.table_readmissions(spark, table, days)) == rows_of(readmission_pairs(claims, days))
    totals = claims.filter("claim_status = 'PAID'").groupBy("member_id").agg(F.sum("paid_amount").alias("t")).filter("t > 900000").select("member_id")
    got = C.table_claims_of_members(spark, table, 900000)
    assert rows_of(got) == rows_of(claims.filter("claim_status = 'PAID'").join(totals, "member_id", "left_semi").select(*RAW_FIELDS)) and not got.isEmpty()


def test_per_member_work_reads_buckets_without_a_shuffle(spark, claims, tmp_path):
    C.load_claims_table(spark, claims, "claims_cold", str(tmp_path), buckets=8)
    for df in (C.table_member_windows(spark, "claims_cold"), C.table_readmissions(spark, "claims_cold"), C.table_claims_of_members(spark, "claims_cold", 900000)):
        assert exchanges(df) == 0
    # a second load replaces the first
    C.load_claims_table(spark, claims.limit(10), "claims_cold", str(tmp_path), buckets=8)
    assert spark.table("claims_cold_all").count() == 10
    C.load_claims_table(spark, claims.limit(0), "claims_cold", str(tmp_path), buckets=8)
    assert C.table_member_windows(spark, "claims_cold").count() == 0
    with pytest.raises(ValueError):
        C.table_readmissions(spark, "claims_cold", 0)
