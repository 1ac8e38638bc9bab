"""Cost concentration, cost drivers and risk segments (the frames behind the
visual analytics).

All of these start from PAID claims aggregated to one row per member, so
the member-level work scales with members, not claims. Global orderings
(Pareto curve, median) use the distributed rank in ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.money import (
    MONEY_UNIT,
    avg_money,
    exact_ratio,
    money_per,
    pct,
    sum_money_sql,
)
from carelake.functions.hashing import md5_bucket
from carelake.operators.ranking import global_running
from carelake.operators.select_rank import median_by_counts
from carelake.session import written
from carelake.schema import (
    AGE_BAND_CUTS,
    AGE_BAND_SEED,
    AGE_BANDS,
    CLAIM_TYPES,
    SEGMENT_HIGH,
    SEGMENT_LOW,
)

TOP_FRACTION = 0.2


def _paid(claims: DataFrame) -> DataFrame:
    return claims.filter(F.col("claim_status") == "PAID")


def member_spend(claims: DataFrame) -> DataFrame:
    """member_id, total_paid (DECIMAL) and claim count over PAID claims."""
    return (
        _paid(claims)
        .groupBy("member_id")
        .agg(F.sum("paid_amount").alias("member_paid"), F.count(F.lit(1)).alias("claims"))
    )


# V1 ---------------------------------------------------------------------------
def pareto_curve(
    claims: DataFrame, fraction: float = TOP_FRACTION, bands: int | None = None
) -> DataFrame:
    """Members ranked by spend (high to low, ties by member_id) with the
    cumulative share of total spend, the evenly spaced x position
    (0..100, as linspace) and whether the member is in the top ``fraction``.

    Percentages are rounded HALF_UP to 4 decimals.
    """
    spend = member_spend(claims).select("member_id", "member_paid")
    ranked = global_running(
        spend, "member_paid", "member_id", True, bands, "spend_rank", "_cum", with_totals=True
    )
    n, total = F.col("total_rows"), F.col("total_sum")
    cutoff = F.greatest(F.lit(1), F.floor(n * F.lit(fraction))).cast("long")
    return ranked.select(
        "member_id",
        F.round("member_paid", 2).cast("double").alias("total_paid"),
        F.col("spend_rank").cast("long").alias("spend_rank"),
        F.when(n <= 1, F.lit(0.0))
        .otherwise(exact_ratio("spend_rank - 1", "total_rows - 1", 4, 100))
        .alias("member_pct"),
        exact_ratio("_cum", "total_sum", 4, 100, MONEY_UNIT, MONEY_UNIT).alias("cum_pct"),
        (F.col("spend_rank") <= cutoff).alias("is_top"),
    )


# V2 ---------------------------------------------------------------------------
def top_share(claims: DataFrame, fraction: float = TOP_FRACTION, bands: int | None = None) -> DataFrame:
    """Members, top-group size max(1, int(fraction * n)) and its % of spend:
    the running sum at the cutoff rank over the total."""
    spend = member_spend(claims).select("member_id", "member_paid")
    ranked = global_running(
        spend, "member_paid", "member_id", True, bands, "spend_rank", "_cum", with_totals=True
    )
    n, total = F.col("total_rows"), F.col("total_sum")
    cutoff = F.greatest(F.lit(1), F.floor(n * F.lit(fraction))).cast("long")
    return ranked.filter(F.col("spend_rank") == cutoff).select(
        n.alias("members"),
        cutoff.alias("top_members"),
        F.round("_cum", 2).cast("double").alias("top_paid"),
        F.round(total, 2).cast("double").alias("total_paid"),
        exact_ratio("_cum", "total_sum", 4, 100, MONEY_UNIT, MONEY_UNIT).alias("top_pct"),
    )


# V3 ---------------------------------------------------------------------------
def spend_by_claim_type(claims: DataFrame) -> DataFrame:
    """PAID total per claim type and its share of all PAID spend."""
    by_type = _paid(claims).groupBy("claim_type").agg(F.sum("paid_amount").alias("_paid"))
    # the grand total is a window over the small per-type aggregate
    total = F.sum("_paid").over(Window.partitionBy())
    return by_type.select(
        "claim_type",
        F.round("_paid", 2).cast("double").alias("total_paid"),
        exact_ratio(F.col("_paid"), total, 2, 100, MONEY_UNIT, MONEY_UNIT).alias("share_pct"),
    ).orderBy(F.desc("total_paid"), "claim_type")


# V4 ---------------------------------------------------------------------------
def unit_cost_by_claim_type(claims: DataFrame) -> DataFrame:
    return (
        _paid(claims)
        .groupBy("claim_type")
        .agg(avg_money("paid_amount").alias("avg_paid"), F.count(F.lit(1)).alias("claim_count"))
        .orderBy(F.desc("avg_paid"), "claim_type")
    )


# V5-V7: segments ----------------------------------------------------------------
def _segmented(spend: DataFrame, bands: int | None) -> DataFrame:
    """``member_spend`` rows with their segment.

    The rows are written once, in no order, so the claims behind ``spend`` are
    scanned once; the median comes from counts over them.
    """
    spend = written(spend, "member-spend")
    med = spend.sparkSession.createDataFrame([(median_by_counts(spend, "member_paid"),)], "median decimal(38,5)")
    # ``med`` is one row: a bounded broadcast (a scalar subquery)
    return spend.crossJoin(F.broadcast(med)).select(
        "member_id",
        "member_paid",
        "claims",
        F.when(F.col("member_paid") >= F.col("median"), SEGMENT_HIGH)
        .otherwise(SEGMENT_LOW)
        .alias("segment"),
    )


def member_segments(claims: DataFrame, bands: int | None = None) -> DataFrame:
    """member_id, member_paid, claims, segment: High-Cost when the member's
    PAID total is at or above the exact median of member totals."""
    return _segmented(member_spend(claims), bands)


def segment_claims(claims: DataFrame, segment: str = SEGMENT_HIGH, bands: int | None = None) -> DataFrame:
    """PAID claims of the members in ``segment`` (a left-semi join on the
    member ids: claims are filtered, never widened or duplicated)."""
    ids = member_segments(claims, bands).filter(F.col("segment") == segment).select("member_id")
    return _paid(claims).join(ids, "member_id", "left_semi")


def cost_segments(claims: DataFrame, bands: int | None = None) -> DataFrame:
    """Per segment: members, claims, average paid per claim, total paid.

    Segment is a member attribute, so the per-segment figures are sums of
    member-level rows; claims are not joined back.
    """
    segs = member_segments(claims, bands)
    return (
        segs.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("claims").alias("claims"),
            money_per("sum(member_paid)", "sum(claims)").alias("avg_paid"),
            F.round(F.sum("member_paid"), 2).cast("double").alias("total_paid"),
        )
        .orderBy("segment")
    )


def _pivot_shares(counts: DataFrame, column: str, values: list[str], names: list[str]) -> DataFrame:
    """Row-normalised pivot: per segment, % of its claims in each value.

    Values outside the list count among the segment's claims, so the listed
    shares then add up to less than 100.
    """
    total = "sum(n)"
    return (
        counts.groupBy("segment")
        .agg(
            F.sum("n").alias("claims"),
            *[
                pct(f"coalesce(sum(CASE WHEN `{column}` = '{v}' THEN n END), 0)", total).alias(name)
                for v, name in zip(values, names)
            ],
        )
        .orderBy("segment")
    )


def _mix(claims: DataFrame, column: Column, bands: int | None) -> DataFrame:
    """segment, value, n: PAID claims by segment and ``column``. One scan: members' totals are summed up from the
    (member, value) groups."""
    fine = written(
        _paid(claims)
        .groupBy("member_id", column.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("paid_amount").alias("paid")),
        "member-mix",
    )
    spend = fine.groupBy("member_id").agg(F.sum("paid").alias("member_paid"), F.sum("n").alias("claims"))
    segs = _segmented(spend, bands).select("member_id", "segment")
    return fine.join(segs, "member_id").groupBy("segment", "value").agg(F.sum("n").alias("n"))


def segment_claim_type_mix(claims: DataFrame, bands: int | None = None) -> DataFrame:
    """% of each segment's PAID claims by claim type (IP, OP, LTC, RX)."""
    counts = _mix(claims, F.col("claim_type"), bands)
    return _pivot_shares(counts, "value", CLAIM_TYPES, [f"{t}_pct" for t in CLAIM_TYPES])


def age_band(claim_id: Column) -> Column:
    """Synthetic age band per claim: md5 of seed and claim_id, bucket 0..99,
    cut at 15 / 40 / 75 (probabilities .15 .25 .35 .25)."""
    bucket = md5_bucket(claim_id, AGE_BAND_SEED)
    expr = None
    for label, cut in zip(AGE_BANDS, AGE_BAND_CUTS):
        expr = F.when(bucket < cut, label) if expr is None else expr.when(bucket < cut, label)
    return expr


AGE_COLUMNS = ["age_18_34_pct", "age_35_49_pct", "age_50_64_pct", "age_65_plus_pct"]


def segment_age_mix(claims: DataFrame, bands: int | None = None) -> DataFrame:
    """% of each segment's PAID claims by synthetic age band."""
    return _pivot_shares(_mix(claims, age_band(F.col("claim_id")), bands), "value", AGE_BANDS, AGE_COLUMNS)


# V8 ---------------------------------------------------------------------------
def headline_counts(claims: DataFrame) -> DataFrame:
    """Distinct members, claims, PAID spend and denial rate, one row."""
    total = F.count(F.lit(1))
    return claims.agg(
        F.count_distinct("member_id").alias("members"),
        total.alias("total_claims"),
        sum_money_sql("CASE WHEN claim_status = 'PAID' THEN paid_amount END").alias("paid_spend"),
        pct("count_if(claim_status = 'DENIED')", "count(1)").alias("denial_rate_pct"),
    )


__all__ = [
    "cost_segments",
    "headline_counts",
    "member_segments",
    "member_spend",
    "pareto_curve",
    "segment_age_mix",
    "segment_claim_type_mix",
    "spend_by_claim_type",
    "top_share",
    "unit_cost_by_claim_type",
]
