"""Distinct members by mergeable sketches, beside the exact count.

A sketch (HyperLogLog, ``2^lg_k`` registers) of each group is a few kilobytes,
however many members it has seen; sketches of two loads, or of finer groups,
merge to the sketch of both. So a table of sketches per state, plan and month
answers distinct counts of any period or roll-up without reading a claim, where
exact distinct counts would have to keep every member. The standard error is
1.04 / sqrt(2^lg_k); small groups are counted exactly.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import month_label

LG_K = 12
GRAIN = ["state_code", "plan_id", "service_month"]


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / sqrt(1 << lg_k)


def member_sketches(claims: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the members with PAID claims per state, plan and month: the part that a load adds to the table."""
    paid = claims.filter("claim_status = 'PAID'").withColumn("service_month", month_label(F.col("service_date")))
    return paid.groupBy(*GRAIN).agg(F.hll_sketch_agg("member_id", F.lit(lg_k)).alias("members"))


def merge_sketches(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of several loads or finer groups, merged to ``keys`` (a subset of the grain)."""
    return parts.groupBy(*keys).agg(F.hll_union_agg("members").alias("members"))


def estimate_members(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and unique_members, estimated from the sketches."""
    return merge_sketches(parts, keys).select(*keys, F.hll_sketch_estimate("members").alias("unique_members"))
