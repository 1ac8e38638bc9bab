"""The claims table in the catalog: typed columns, bucketed and sorted by member.

``load_claims_table`` creates the table by DDL and fills it, so that per-member
work reads it without a shuffle: running windows (``table_member_windows``),
readmissions (``table_readmissions``) and the claims of members above a
threshold (``table_claims_of_members``) start from buckets that already hold a
member's claims together.

A bucket is one task, so a member with very many claims must not be in one.
Members above ``hot_rows`` claims go to a second table, ``<name>_hot``, which
is not bucketed; its rows take the forms that cut a member into ranges. The view
``<name>_all`` is both. Results do not depend on which table a member is in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.operators.member_windows import member_windows, plain_member_windows
from carelake.operators.readmission import readmission_pairs
from carelake.schema import RAW_FIELDS, partition_schema
from carelake.session import discard, freed_shuffles, sized_shuffles, stored_bytes, written

#: Buckets of a table, and claims of a member from which it counts as hot.
BUCKETS, HOT_ROWS = 64, 100_000
#: Claims that a bucket is meant to hold.
BUCKET_ROWS = 250_000
SORT = ["member_id", "service_date", "claim_id"]


def create_claims_table(spark: SparkSession, name: str, location: str, buckets: int = BUCKETS) -> None:
    """The DDL of both tables and their view; tables that exist stay as they are."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in partition_schema(RAW_FIELDS).fields)
    layout = f"CLUSTERED BY (member_id) SORTED BY ({', '.join(SORT)}) INTO {buckets} BUCKETS"
    root = location.rstrip("/")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} LOCATION '{root}/by_member'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_hot ({columns}) USING parquet LOCATION '{root}/hot'")
    spark.sql(f"CREATE OR REPLACE VIEW {name}_all AS SELECT * FROM {name} UNION ALL SELECT * FROM {name}_hot")


def load_claims_table(spark: SparkSession, claims: DataFrame, name: str, location: str, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS) -> None:
    """Replace the content of the table by ``claims`` (typed)."""
    create_claims_table(spark, name, location, buckets)
    rows = claims.select(*RAW_FIELDS)
    with sized_shuffles(spark, stored_bytes(rows)), freed_shuffles(spark):
        _load(spark, rows, name, buckets, hot_rows)


def _load(spark: SparkSession, rows: DataFrame, name: str, buckets: int, hot_rows: int) -> None:
    hot = written(rows.groupBy("member_id").count().filter(F.col("count") > hot_rows).select("member_id"), "hot-members")
    # one task a bucket, with the hash that the bucketed reader expects
    cold = rows.join(hot, "member_id", "left_anti").select(*RAW_FIELDS)
    cold.repartition(buckets, "member_id").sortWithinPartitions(*SORT).write.insertInto(name, overwrite=True)
    rows.join(hot, "member_id", "left_semi").select(*RAW_FIELDS).write.insertInto(f"{name}_hot", overwrite=True)
    discard(hot)
    spark.catalog.refreshTable(name)
    spark.catalog.refreshTable(f"{name}_hot")


def buckets_for(rows: int) -> int:
    """Buckets of a table of so many claims: ``BUCKETS``, doubled until a bucket, which is one task, holds ``BUCKET_ROWS`` at most."""
    buckets = BUCKETS
    while rows > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def _both(spark: SparkSession, name: str, by_member: Callable[[DataFrame], DataFrame], general: Callable[[DataFrame], DataFrame]) -> DataFrame:
    hot = spark.table(f"{name}_hot")
    out = by_member(spark.table(name))
    return out if hot.isEmpty() else out.unionByName(general(hot))


def table_member_windows(spark: SparkSession, name: str) -> DataFrame:
    """All claims with the per-member windows (running paid total, days since the last claim)."""
    return _both(spark, name, plain_member_windows, member_windows)


def _pairs_by_window(claims: DataFrame, days: int) -> DataFrame:
    """Readmission pairs from one window: a stay's frame is the member's stays of the next ``days`` days."""
    stays = claims.filter("claim_type = 'IP' AND claim_status = 'PAID'").select("member_id", "claim_id", "service_date", F.unix_date("service_date").alias("_day"))
    later = Window.partitionBy("member_id").orderBy("_day").rangeBetween(1, days)
    framed = stays.withColumn("_later", F.collect_list(F.struct("claim_id", "service_date")).over(later))
    pairs = framed.select("member_id", F.col("claim_id").alias("first_admit"), F.col("service_date").alias("first_admit_date"), F.explode("_later").alias("_r"))
    pairs = pairs.select(
        "member_id", "first_admit", "first_admit_date", F.col("_r.claim_id").alias("readmit_claim"), F.col("_r.service_date").alias("readmit_date"),
        F.datediff("_r.service_date", "first_admit_date").alias("days_between"),
    )
    return pairs.filter("first_admit <> readmit_claim")


def table_readmissions(spark: SparkSession, name: str, days: int = 30) -> DataFrame:
    """The pairs of ``operators.readmission``, read by bucket."""
    if days < 1:
        raise ValueError("days must be >= 1")
    return _both(spark, name, lambda c: _pairs_by_window(c, days), lambda c: readmission_pairs(c, days))


def table_claims_of_members(spark: SparkSession, name: str, threshold: float) -> DataFrame:
    """PAID claims of the members whose PAID total is above ``threshold`` (a semi-join within buckets)."""

    def of(claims: DataFrame) -> DataFrame:
        paid = claims.filter("claim_status = 'PAID'")
        totals = paid.groupBy("member_id").agg(F.sum("paid_amount").alias("_t"))
        return paid.join(totals.filter(F.col("_t") > F.lit(threshold).cast("decimal(20,4)")).hint("merge"), "member_id", "left_semi").select(*RAW_FIELDS)

    return _both(spark, name, of, of)
