"""Reports from rollups: partial aggregates kept load by load.

A load adds two parts, both far smaller than its claims, and reports sum up the
parts instead of reading claims:

* ``cube``: counts and money sums per month, state, plan, claim type, provider
  type, diagnosis and status; no member in it.
* ``members``: the same for PAID claims per member, state, plan, provider type
  and diagnosis, with the last date. Distinct members are exact: a member of a
  group is a row, however many loads it came in.

Sums, counts and maxima of parts merge by summing and taking the maximum, money
is DECIMAL, and ratios are formed once at the end, so every report equals its
direct form in ``analytics`` and ``etl`` exactly. ``append_rollup`` commits the
parts of a load at once (``sources.published``); ``compact`` merges the parts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.functions.dates import month_label
from carelake.functions.money import MONEY_UNIT, money_per, payment_rate, pct, sum_money
from carelake.plans.etl import SUMMARY_DIMENSIONS, summary_of_fine
from carelake.session import sized_shuffles, stored_bytes
from carelake.sources import published

CUBE = ["service_month", "state_code", "plan_id", "claim_type", "provider_type", "diagnosis_code", "claim_status"]
MEMBERS = ["member_id", "state_code", "plan_id", "provider_type", "diagnosis_code"]
SUM = "decimal(38,4)"
_CUBE_SUMS = ["n", "id_n", "billed_s", "paid_s", "paid_c", "rate_s", "rate_n"]
_MEMBER_SUMS = ["n", "ip_n", "paid_s", "paid_c"]


def cube_part(claims: DataFrame) -> DataFrame:
    rate = payment_rate().cast(SUM)
    return claims.groupBy(month_label(F.col("service_date")).alias("service_month"), *CUBE[1:]).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("claim_id").alias("id_n"),
        F.sum("billed_amount").cast(SUM).alias("billed_s"),
        F.sum("paid_amount").cast(SUM).alias("paid_s"),
        F.count("paid_amount").alias("paid_c"),
        F.sum(rate).cast(SUM).alias("rate_s"),
        F.count(rate).alias("rate_n"),
    )


def member_part(claims: DataFrame) -> DataFrame:
    return claims.filter("claim_status = 'PAID'").groupBy(*MEMBERS).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("claim_type") == "IP").alias("ip_n"),
        F.sum("paid_amount").cast(SUM).alias("paid_s"),
        F.count("paid_amount").alias("paid_c"),
        F.max("service_date").alias("last_date"),
    )


def merged(cube: DataFrame | None, members: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Parts of several loads as the parts of one."""
    one = cube and cube.groupBy(*CUBE).agg(*[F.sum(c).cast(cube.schema[c].dataType).alias(c) for c in _CUBE_SUMS])
    two = members and members.groupBy(*MEMBERS).agg(*[F.sum(c).cast(members.schema[c].dataType).alias(c) for c in _MEMBER_SUMS], F.max("last_date").alias("last_date"))
    return one, two


def _parts(spark: SparkSession, root: str) -> list[str]:
    manifest = published.latest(spark, root)
    return manifest["facts"]["parts"] if manifest else []


def read_rollup(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """cube and members: the parts of all loads (rows of a group may repeat; the reports sum them up)."""
    parts = _parts(spark, root)
    if not parts:
        raise FileNotFoundError(f"no rollup under {root}")
    return tuple(spark.read.parquet(*[f"{root.rstrip('/')}/{p}/{t}" for p in parts]) for t in ("cube", "members"))


def _commit(spark: SparkSession, root: str, cube: DataFrame, members: DataFrame, earlier: list[str]) -> str:
    load_id = uuid.uuid4().hex
    out = published.load_folder(root, load_id)
    for df, table in ((cube, "cube"), (members, "members")):
        with sized_shuffles(spark, stored_bytes(df)):
            df.write.parquet(f"{out}/{table}")
    part = f"{published.LOADS}/{load_id}"
    published.commit(spark, root, load_id, {"cube": f"{part}/cube", "members": f"{part}/members"}, {"parts": [*earlier, part]})
    return load_id


def append_rollup(spark: SparkSession, root: str, claims: DataFrame) -> str:
    """Add the claims of a load (each claim in one load)."""
    return _commit(spark, root, cube_part(claims), member_part(claims), _parts(spark, root))


def compact(spark: SparkSession, root: str) -> str:
    """All parts merged into one; readers of the old parts go on."""
    return _commit(spark, root, *merged(*read_rollup(spark, root)), [])


# ---------------------------------------------------------------------------
# reports: (cube, members) -> the rows of the direct form
# ---------------------------------------------------------------------------
_DENIED = "sum(CASE WHEN claim_status = 'DENIED' THEN n ELSE 0 END)"


def _count(condition: str = "true"):
    return F.expr(f"CAST(coalesce(sum(CASE WHEN {condition} THEN n ELSE 0 END), 0) AS BIGINT)")


def _paid(cube: DataFrame) -> DataFrame:
    return cube.filter("claim_status = 'PAID'")


def baseline_kpis(cube: DataFrame, members: DataFrame) -> DataFrame:
    return cube.agg(
        _count().alias("total_claims"),
        _count("claim_status = 'PAID'").alias("paid_claims"),
        _count("claim_status = 'DENIED'").alias("denied_claims"),
        pct(_DENIED, "sum(n)").alias("denial_rate_pct"),
        sum_money("billed_s").alias("total_billed"),
        sum_money("paid_s").alias("total_paid"),
        pct("sum(paid_s)", "sum(billed_s)", unit=MONEY_UNIT).alias("avg_payment_rate_pct"),
    )


def monthly_spend_trend(cube: DataFrame, members: DataFrame) -> DataFrame:
    return (
        _paid(cube).groupBy("service_month", "claim_type")
        .agg(F.sum("n").alias("claim_count"), sum_money("paid_s").alias("total_paid"), money_per("sum(paid_s)", "sum(paid_c)").alias("avg_paid_per_claim"))
        .orderBy("service_month", "claim_type")
    )


def _by_members(members: DataFrame, *keys: str) -> DataFrame:
    """Per group: claims, paid sum and count, and exact distinct members, from one row a group and member."""
    each = members.groupBy(*keys, "member_id").agg(*[F.sum(c).alias(c) for c in _MEMBER_SUMS])
    return each.groupBy(*keys).agg(F.count("member_id").alias("unique_members"), *[F.sum(c).alias(c) for c in _MEMBER_SUMS])


def spend_by_state_plan(cube: DataFrame, members: DataFrame) -> DataFrame:
    g = _by_members(members, "state_code", "plan_id")
    return g.select(
        "state_code", "plan_id", "unique_members", F.col("n").alias("total_claims"), F.round("paid_s", 2).cast("double").alias("total_paid"),
        money_per(F.col("paid_s"), F.col("unique_members")).alias("pmpm_proxy"),
    ).orderBy(F.desc("total_paid"), "state_code", "plan_id")


def high_cost_members(cube: DataFrame, members: DataFrame, threshold: float = 5000, limit: int | None = 20) -> DataFrame:
    each = members.groupBy("member_id", "state_code").agg(*[F.sum(c).alias(c) for c in _MEMBER_SUMS], F.max("last_date").alias("most_recent_claim"))
    out = each.filter(F.col("paid_s") > F.lit(threshold).cast("decimal(20,4)")).select(
        "member_id", "state_code", F.col("n").alias("total_claims"), F.col("ip_n").alias("inpatient_visits"), F.round("paid_s", 2).cast("double").alias("total_paid"),
        money_per(F.col("paid_s"), F.col("paid_c")).alias("avg_per_claim"), "most_recent_claim",
    ).orderBy(F.desc("total_paid"), "member_id", "state_code")
    return out.limit(limit) if limit is not None else out


def behavioral_utilization(cube: DataFrame, members: DataFrame) -> DataFrame:
    g = _by_members(members.filter("provider_type = 'BEHAVIORAL'"), "state_code", "provider_type")
    share = pct(F.col("n"), F.sum("n").over(Window.partitionBy("state_code")))
    return g.select(
        "state_code", "provider_type", F.col("n").alias("claim_count"), "unique_members", F.round("paid_s", 2).cast("double").alias("total_paid"),
        money_per(F.col("paid_s"), F.col("paid_c")).alias("avg_paid"), share.alias("pct_of_state_claims"),
    ).orderBy(F.desc("total_paid"), "state_code", "provider_type")


def denial_rate_by_provider(cube: DataFrame, members: DataFrame) -> DataFrame:
    return (
        cube.groupBy("provider_type")
        .agg(
            F.sum("n").alias("total_claims"),
            _count("claim_status = 'DENIED'").alias("denied"),
            pct(_DENIED, "sum(n)").alias("denial_rate_pct"),
            F.round(F.sum("billed_s") - F.sum("paid_s"), 2).cast("double").alias("total_underpaid"),
        )
        .orderBy(F.desc("denial_rate_pct"), "provider_type")
    )


def top_diagnoses_by_spend(cube: DataFrame, members: DataFrame, limit: int = 15) -> DataFrame:
    g = _by_members(members, "diagnosis_code")
    return g.select(
        "diagnosis_code", F.col("n").alias("claim_count"), "unique_members", F.round("paid_s", 2).cast("double").alias("total_paid"),
        money_per(F.col("paid_s"), F.col("paid_c")).alias("avg_per_claim"),
    ).orderBy(F.desc("total_paid"), F.asc_nulls_last("diagnosis_code")).limit(limit)


def analytics_summary(cube: DataFrame, members: DataFrame, top_n: int = 5) -> DataFrame:
    when = lambda condition, c: F.sum(F.expr(f"CASE WHEN {condition} THEN {c} END"))
    count = lambda condition, c="n": F.coalesce(when(condition, c), F.lit(0))
    fine = cube.groupBy(*SUMMARY_DIMENSIONS).agg(
        F.sum("n").alias("n"),
        count("claim_status = 'PAID'").alias("paid_n"),
        count("claim_status = 'DENIED'").alias("denied_n"),
        F.sum("billed_s").alias("billed_s"),
        F.sum("paid_s").alias("paid_s"),
        when("claim_status = 'PAID'", "rate_s").alias("rate_s"),
        count("claim_status = 'PAID'", "rate_n").alias("rate_n"),
        when("claim_type = 'IP'", "paid_s").alias("ip_s"),
        count("claim_type = 'IP'", "paid_c").alias("ip_n"),
        when("provider_type = 'BEHAVIORAL'", "paid_s").alias("bh_s"),
        F.sum("id_n").alias("id_n"),
    )
    return summary_of_fine(fine, top_n)


REPORTS = {
    "q1_baseline_kpis": baseline_kpis,
    "q2_monthly_spend_trend": monthly_spend_trend,
    "q3_spend_by_state_plan": spend_by_state_plan,
    "q4_high_cost_members": high_cost_members,
    "q5_behavioral_utilization": behavioral_utilization,
    "q6_denial_rate_by_provider": denial_rate_by_provider,
    "q7_top_diagnoses_by_spend": top_diagnoses_by_spend,
    "q12_analytics_summary": analytics_summary,
}
