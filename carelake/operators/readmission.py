"""Readmission proxy: ordered pairs of PAID inpatient claims of one member,
the second strictly later and at most ``days`` days after the first.

A plain self-join on member_id compares every pair of a member's inpatient
claims, which is quadratic for a member with many stays and puts all of a hot
member's rows into one join task. Here dates are cut into bins ``days`` wide.
Since 0 < later - earlier <= days, the later claim's bin is the earlier
claim's bin or the next one. The later side is therefore duplicated into its
own bin and the previous one (two rows each), and the join key becomes
(member_id, bin): candidates shrink to claims at most two bins apart, and a
hot member's rows spread over as many join keys as it has active bins, which
AQE's skew-join handling can split further. The day test stays as a residual,
so the result is exactly the pairs of the plain self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _day_number(c: str):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


# first stays of one member and bin that one task takes
STAYS_PER_TASK = 10_000


def readmission_pairs(claims: DataFrame, days: int = 30) -> DataFrame:
    if days < 1:
        raise ValueError("days must be >= 1")
    ip = claims.filter(
        (F.col("claim_type") == "IP") & (F.col("claim_status") == "PAID")
    ).select("member_id", "claim_id", "service_date")
    with_bin = ip.withColumn("_bin", F.floor(_day_number("service_date") / F.lit(days)))

    # bins with very many stays: the first side is dealt out, the later side copied to each share
    shares = (
        with_bin.groupBy("member_id", "_bin")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(STAYS_PER_TASK)).cast("int").alias("shares"))
        .filter(F.col("shares") > 1)
        .select(F.col("member_id").alias("s_member"), F.col("_bin").alias("s_bin"), "shares")
    )

    def shared(df: DataFrame, member: str, bin_: str) -> DataFrame:
        hot = (F.col(member) == F.col("s_member")) & (F.col(bin_) == F.col("s_bin"))
        return df.join(shares, hot, "left").withColumn("shares", F.coalesce("shares", F.lit(1)))

    first = shared(
        with_bin.select(
            F.col("member_id").alias("a_member"),
            F.col("claim_id").alias("first_admit"),
            F.col("service_date").alias("first_admit_date"),
            F.col("_bin").alias("a_bin"),
        ),
        "a_member",
        "a_bin",
    ).withColumn("a_share", F.pmod(F.xxhash64("first_admit"), F.col("shares")).cast("int"))
    first = first.select("a_member", "first_admit", "first_admit_date", "a_bin", "a_share")
    later = shared(
        with_bin.select(
            F.col("member_id").alias("b_member"),
            F.col("claim_id").alias("readmit_claim"),
            F.col("service_date").alias("readmit_date"),
            F.explode(F.array(F.col("_bin"), F.col("_bin") - 1)).alias("b_bin"),
        ),
        "b_member",
        "b_bin",
    ).select("b_member", "readmit_claim", "readmit_date", "b_bin", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("b_share"))
    gap = F.datediff(F.col("readmit_date"), F.col("first_admit_date"))
    cond = (
        (F.col("a_member") == F.col("b_member"))
        & (F.col("a_bin") == F.col("b_bin"))
        & (F.col("a_share") == F.col("b_share"))
        & (F.col("first_admit") != F.col("readmit_claim"))
        & (F.col("readmit_date") > F.col("first_admit_date"))
        & (gap <= days)
    )
    return first.join(later, cond, "inner").select(
        F.col("a_member").alias("member_id"),
        "first_admit",
        "first_admit_date",
        "readmit_claim",
        "readmit_date",
        gap.alias("days_between"),
    )
