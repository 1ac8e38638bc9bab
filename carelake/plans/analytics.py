"""The claims analytics: KPIs, trends, plan spend, high-cost members,
behavioural health, denials, diagnoses, data-quality anomalies, readmissions.

Every function takes a typed claims DataFrame and returns a lazy DataFrame.
``fn.fields`` lists the claim columns it reads, so a caller building claims
from wide sources can project (and skip joins) before calling it.

Ordering: results carry the ORDER BY of the original report, with the group
key as the last sort key so that ties, and therefore LIMITs, are
deterministic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.dates import month_label
from carelake.functions.money import (
    MONEY_UNIT,
    avg_money,
    avg_money_sql,
    count_where,
    money_per,
    pct,
    sum_money,
    sum_money_sql,
)
from carelake.operators.readmission import readmission_pairs as _readmission_pairs
from carelake.schema import ANOMALY_LABEL


def needs(*fields: str) -> Callable:
    def wrap(fn: Callable) -> Callable:
        fn.fields = list(fields)
        return fn

    return wrap


def _status(s: str) -> Column:
    return F.col("claim_status") == s


def _paid_only(claims: DataFrame) -> DataFrame:
    return claims.filter(_status("PAID"))


DENIED_N = "count_if(claim_status = 'DENIED')"


# Q1 ---------------------------------------------------------------------------
@needs("claim_status", "billed_amount", "paid_amount")
def baseline_kpis(claims: DataFrame) -> DataFrame:
    """Counts by status, denial rate, billed and paid totals, weighted pay rate."""
    total = F.count(F.lit(1))
    denied = count_where(_status("DENIED"))
    return claims.agg(
        total.alias("total_claims"),
        count_where(_status("PAID")).alias("paid_claims"),
        denied.alias("denied_claims"),
        pct(DENIED_N, "count(1)").alias("denial_rate_pct"),
        sum_money("billed_amount").alias("total_billed"),
        sum_money("paid_amount").alias("total_paid"),
        pct("sum(paid_amount)", "sum(billed_amount)", unit=MONEY_UNIT).alias(
            "avg_payment_rate_pct"
        ),
    )


# Q2 ---------------------------------------------------------------------------
@needs("claim_status", "service_date", "claim_type", "paid_amount")
def monthly_spend_trend(claims: DataFrame) -> DataFrame:
    """PAID claims by service month and claim type."""
    return (
        _paid_only(claims)
        .groupBy(month_label(F.col("service_date")).alias("service_month"), "claim_type")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            sum_money("paid_amount").alias("total_paid"),
            avg_money("paid_amount").alias("avg_paid_per_claim"),
        )
        .orderBy("service_month", "claim_type")
    )


# Q3 ---------------------------------------------------------------------------
@needs("claim_status", "state_code", "plan_id", "member_id", "paid_amount")
def spend_by_state_plan(claims: DataFrame) -> DataFrame:
    """PAID spend per state and plan, with spend per distinct member."""
    members = F.count_distinct("member_id")
    return (
        _paid_only(claims)
        .groupBy("state_code", "plan_id")
        .agg(
            members.alias("unique_members"),
            F.count(F.lit(1)).alias("total_claims"),
            sum_money("paid_amount").alias("total_paid"),
            money_per("sum(paid_amount)", "count(DISTINCT member_id)").alias("pmpm_proxy"),
        )
        .orderBy(F.desc("total_paid"), "state_code", "plan_id")
    )


# Q4 ---------------------------------------------------------------------------
@needs("claim_status", "member_id", "state_code", "claim_type", "paid_amount", "service_date")
def high_cost_members(
    claims: DataFrame, threshold: float = 5000, limit: int | None = 20
) -> DataFrame:
    """Members (per state) whose PAID total is strictly above ``threshold``.

    ``limit=None`` gives the full list (the notebook form); the report form
    keeps the top ``limit`` by total paid, ties broken by member and state.
    """
    out = (
        _paid_only(claims)
        .groupBy("member_id", "state_code")
        .agg(
            F.count(F.lit(1)).alias("total_claims"),
            count_where(F.col("claim_type") == "IP").alias("inpatient_visits"),
            F.sum("paid_amount").alias("_paid"),
            avg_money("paid_amount").alias("avg_per_claim"),
            F.max("service_date").alias("most_recent_claim"),
        )
        .filter(F.col("_paid") > F.lit(threshold).cast("decimal(20,4)"))
        .select(
            "member_id",
            "state_code",
            "total_claims",
            "inpatient_visits",
            F.round("_paid", 2).cast("double").alias("total_paid"),
            "avg_per_claim",
            "most_recent_claim",
        )
        .orderBy(F.desc("total_paid"), "member_id", "state_code")
    )
    return out.limit(limit) if limit is not None else out


# Q5 ---------------------------------------------------------------------------
def _behavioral_paid(claims: DataFrame) -> DataFrame:
    return claims.filter(_status("PAID") & (F.col("provider_type") == "BEHAVIORAL"))


@needs("claim_status", "provider_type", "state_code", "member_id", "paid_amount")
def behavioral_utilization(claims: DataFrame) -> DataFrame:
    """PAID behavioural-health claims by state and provider type.

    ``pct_of_state_claims`` is each group's share of the state's claims
    *after* the filter, as the original report computes it (so it is 100
    whenever one provider type remains); see ``behavioral_share_of_state``
    for the share of all PAID claims.
    """
    grouped = (
        _behavioral_paid(claims)
        .groupBy("state_code", "provider_type")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.count_distinct("member_id").alias("unique_members"),
            sum_money("paid_amount").alias("total_paid"),
            avg_money("paid_amount").alias("avg_paid"),
        )
    )
    # window over the (small) aggregate, not over claims
    state_total = F.sum("claim_count").over(Window.partitionBy("state_code"))
    return grouped.withColumn(
        "pct_of_state_claims", pct(F.col("claim_count"), state_total)
    ).orderBy(F.desc("total_paid"), "state_code", "provider_type")


@needs("claim_status", "provider_type", "state_code", "member_id", "paid_amount")
def behavioral_by_state(claims: DataFrame) -> DataFrame:
    """PAID behavioural-health claims by state (no share column)."""
    return (
        _behavioral_paid(claims)
        .groupBy("state_code")
        .agg(
            F.count(F.lit(1)).alias("bh_claims"),
            F.count_distinct("member_id").alias("unique_members"),
            sum_money("paid_amount").alias("total_paid"),
            avg_money("paid_amount").alias("avg_paid"),
        )
        .orderBy(F.desc("total_paid"), "state_code")
    )


@needs("claim_status", "provider_type", "state_code")
def behavioral_share_of_state(claims: DataFrame) -> DataFrame:
    """Behavioural-health PAID claims as a share of all PAID claims per state.

    One pass: conditional counts inside a single group-by, no window.
    """
    is_bh = F.col("provider_type") == "BEHAVIORAL"
    bh = count_where(is_bh)
    return (
        _paid_only(claims)
        .groupBy("state_code")
        .agg(
            bh.alias("bh_claims"),
            F.count(F.lit(1)).alias("paid_claims"),
            pct("count_if(provider_type = 'BEHAVIORAL')", "count(1)").alias(
                "bh_pct_of_state_claims"
            ),
        )
        .orderBy(F.desc("bh_pct_of_state_claims"), "state_code")
    )


# Q6 ---------------------------------------------------------------------------
@needs("provider_type", "claim_status", "billed_amount", "paid_amount")
def denial_rate_by_provider(claims: DataFrame) -> DataFrame:
    """All statuses: denials and billed-minus-paid per provider type."""
    total = F.count(F.lit(1))
    denied = count_where(_status("DENIED"))
    return (
        claims.groupBy("provider_type")
        .agg(
            total.alias("total_claims"),
            denied.alias("denied"),
            pct(DENIED_N, "count(1)").alias("denial_rate_pct"),
            F.round(F.sum("billed_amount") - F.sum("paid_amount"), 2)
            .cast("double")
            .alias("total_underpaid"),
        )
        .orderBy(F.desc("denial_rate_pct"), "provider_type")
    )


# Q7 ---------------------------------------------------------------------------
@needs("claim_status", "diagnosis_code", "member_id", "paid_amount")
def top_diagnoses_by_spend(claims: DataFrame, limit: int = 15) -> DataFrame:
    return (
        _paid_only(claims)
        .groupBy("diagnosis_code")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.count_distinct("member_id").alias("unique_members"),
            sum_money("paid_amount").alias("total_paid"),
            avg_money("paid_amount").alias("avg_per_claim"),
        )
        .orderBy(F.desc("total_paid"), F.asc_nulls_last("diagnosis_code"))
        .limit(limit)
    )


# Q8 ---------------------------------------------------------------------------
@needs(
    "claim_status",
    "claim_id",
    "member_id",
    "service_date",
    "claim_type",
    "billed_amount",
    "paid_amount",
)
def denied_with_payment(claims: DataFrame) -> DataFrame:
    """Data-quality rows: DENIED claims that still show a payment."""
    return claims.filter(_status("DENIED") & (F.col("paid_amount") > 0)).select(
        "claim_id",
        "member_id",
        "service_date",
        "claim_type",
        F.col("billed_amount").cast("double").alias("billed_amount"),
        F.col("paid_amount").cast("double").alias("paid_amount"),
        "claim_status",
        F.lit(ANOMALY_LABEL).alias("anomaly_flag"),
    )


# Q9 ---------------------------------------------------------------------------
@needs("claim_status", "claim_type", "member_id", "claim_id", "service_date")
def readmission_pairs(claims: DataFrame, days: int = 30) -> DataFrame:
    """All ordered pairs of PAID inpatient claims of a member, the second
    strictly later and at most ``days`` days after the first."""
    return _readmission_pairs(claims, days).orderBy("member_id", "days_between", "first_admit", "readmit_claim")


# Q10 --------------------------------------------------------------------------
@needs("claim_status", "claim_type", "member_id")
def repeat_inpatient_members(claims: DataFrame) -> DataFrame:
    """Members with more than one PAID inpatient stay."""
    return (
        claims.filter((F.col("claim_type") == "IP") & _status("PAID"))
        .groupBy("member_id")
        .agg(F.count(F.lit(1)).alias("inpatient_stays"))
        .filter(F.col("inpatient_stays") > 1)
        .orderBy(F.desc("inpatient_stays"), "member_id")
    )


# Q11 --------------------------------------------------------------------------
@needs("claim_status", "provider_type", "state_code", "paid_amount")
def behavioral_spend_by_state(claims: DataFrame) -> DataFrame:
    return (
        _behavioral_paid(claims)
        .groupBy("state_code")
        .agg(sum_money("paid_amount").alias("bh_spend"))
        .orderBy(F.desc("bh_spend"), "state_code")
    )


# Q14 --------------------------------------------------------------------------
@needs("claim_status", "billed_amount", "paid_amount", "claim_type", "provider_type")
def executive_metrics(claims: DataFrame, *more: Column) -> DataFrame:
    """The eight metrics behind the executive summary, and ``more`` aggregates, in one pass."""
    total = F.count(F.lit(1))
    denied = count_where(_status("DENIED"))
    return claims.agg(
        total.alias("total_claims"),
        count_where(_status("PAID")).alias("paid_claims"),
        denied.alias("denied_claims"),
        pct(DENIED_N, "count(1)").alias("denial_rate_pct"),
        sum_money("billed_amount").alias("total_billed"),
        sum_money("paid_amount").alias("total_paid"),
        avg_money_sql("CASE WHEN claim_type = 'IP' THEN paid_amount END").alias(
            "inpatient_avg_paid"
        ),
        sum_money_sql("CASE WHEN provider_type = 'BEHAVIORAL' THEN paid_amount END").alias(
            "behavioral_health_spend"
        ),
        *more,
    )


# Q15 --------------------------------------------------------------------------
SPEND_DIMENSIONS = ("claim_type", "state_code", "provider_type")


def spend_by_dimension(claims: DataFrame, dimension: str) -> DataFrame:
    """Paid total per value of one dimension, all statuses (nulls kept)."""
    if dimension not in SPEND_DIMENSIONS:
        raise ValueError(f"dimension must be one of {SPEND_DIMENSIONS}")
    return (
        claims.groupBy(dimension)
        .agg(sum_money("paid_amount").alias("total_paid"))
        .orderBy(F.asc_nulls_last(dimension))
    )


spend_by_dimension.fields = ["paid_amount", *SPEND_DIMENSIONS]


# Q16 --------------------------------------------------------------------------
@needs("diagnosis_code", "claim_id")
def top_diagnoses_by_count(claims: DataFrame, limit: int = 5) -> DataFrame:
    """Most frequent diagnosis codes (claims with an id), ties by code."""
    return (
        claims.groupBy("diagnosis_code")
        .agg(F.count("claim_id").alias("claim_count"))
        .orderBy(F.desc("claim_count"), F.asc_nulls_last("diagnosis_code"))
        .limit(limit)
    )
