"""The claims ETL end to end, and its two summaries.

    raw text -> check (normalise, parse, one validity flag per row)
             -> one parquet stage by validity (cuts lineage; survives executor
                loss; the load counts are observed on this job)
             -> valid typed rows -> member windows + derived fields -> curated
             -> error log, curated table, PAID layer by state, run summary
             -> one commit of all of them

The checked table is written once to the session's checkpoint folder, so the
valid split, the error log and the counts are all read from the same rows
rather than re-scanning (and re-validating) the input. Error records are built
from the invalid part only.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.functions.money import (
    MONEY_UNIT,
    count_where,
    money_per,
    pct,
    sum_money,
    sum_money_sql,
)
from carelake.operators.quality import (
    INVALID,
    PARSED,
    check,
    errors,
    is_valid,
    observe_counts,
    valid_claims,
    validation_errors,
)
from carelake.plans.transform import curated_paid, derive, transform
from carelake.schema import LINE_KIND
from carelake.session import discard, freed_shuffles, sized_shuffles, stored_bytes, written
from carelake.sources import published, sinks
from carelake.sources.files import number_lines, read_curated


# Q13 --------------------------------------------------------------------------
def load_summary(checked: DataFrame) -> DataFrame:
    """Rows raw / valid / invalid, error records, anomalies, totals, denial %.

    ``rows_invalid`` counts rows; ``error_count`` counts failed checks (a row
    can fail several). One aggregate over the checked rows: the totals use the
    values parsed during the check, restricted to valid rows.
    """
    valid = is_valid()
    denied = valid & (F.col("claim_status") == "DENIED")
    return checked.agg(
        F.count(INVALID).alias("rows_raw"),
        F.count_if(valid).alias("rows_valid"),
        F.count_if(~valid).alias("rows_invalid"),
        F.coalesce(F.sum(F.when(~valid, F.size(errors(checked)))), F.lit(0)).cast("long").alias("error_count"),
        count_where(denied & (F.col(PARSED["paid_amount"]) > 0)).alias("anomalies_found"),
        sum_money_sql(f"CASE WHEN NOT {INVALID} THEN {PARSED['billed_amount']} END").alias(
            "total_billed"
        ),
        sum_money_sql(f"CASE WHEN NOT {INVALID} THEN {PARSED['paid_amount']} END").alias(
            "total_paid"
        ),
        pct(
            f"count_if(NOT {INVALID} AND claim_status = 'DENIED')", f"count_if(NOT {INVALID})"
        ).alias("denial_rate_pct"),
    )


# Q12 --------------------------------------------------------------------------
SUMMARY_DIMENSIONS = ["claim_type", "state_code", "provider_type", "diagnosis_code"]
# grouping_id() of each grouping set over SUMMARY_DIMENSIONS (bit set = rolled up)
_GID = {"all": 15, "claim_type": 7, "state_code": 11, "provider_type": 13, "diagnosis_code": 14}
SUMMARY_MAP_METRICS = {
    "spend_by_claim_type": "claim_type",
    "spend_by_state": "state_code",
    "spend_by_provider": "provider_type",
}
SCALAR_METRICS = [
    "total_claims",
    "paid_claims",
    "denied_claims",
    "denial_rate_pct",
    "total_billed",
    "total_paid",
    "mean_payment_rate_pct",
    "inpatient_avg_paid",
    "behavioral_health_spend",
]


def analytics_summary(curated: DataFrame, top_n: int = 5) -> DataFrame:
    """The run summary as long rows (metric, key, value DOUBLE).

    Scalars have a null key; the spend maps have one row per group value;
    ``top_diagnoses`` has the ``top_n`` most frequent codes.

    One scan and one shuffle of the claims: every metric is a sum or a count,
    so claims are first aggregated at the finest grain (type x state x
    provider x diagnosis) and only that small table is rolled up over the
    five grouping sets.
    """
    paid = F.col("paid_amount")
    is_paid = F.col("claim_status") == "PAID"
    rate4 = F.col("payment_rate").cast("decimal(38,4)")
    fine = curated.groupBy(*SUMMARY_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n"),
        count_where(is_paid).alias("paid_n"),
        count_where(F.col("claim_status") == "DENIED").alias("denied_n"),
        F.sum("billed_amount").alias("billed_s"),
        F.sum(paid).alias("paid_s"),
        F.sum(F.when(is_paid, rate4)).alias("rate_s"),
        F.count(F.when(is_paid, rate4)).alias("rate_n"),
        F.sum(F.when(F.col("is_inpatient"), paid)).alias("ip_s"),
        F.count(F.when(F.col("is_inpatient"), paid)).alias("ip_n"),
        F.sum(F.when(F.col("is_behavioral"), paid)).alias("bh_s"),
        F.count("claim_id").alias("id_n"),
    )
    return summary_of_fine(fine, top_n)


def summary_of_fine(fine: DataFrame, top_n: int = 5) -> DataFrame:
    """The long rows from sums and counts at the finest grain (as in ``analytics_summary``; parts of it may repeat)."""
    total = F.sum("n")
    g = fine.groupingSets(
        [[], ["claim_type"], ["state_code"], ["provider_type"], ["diagnosis_code"]],
        *SUMMARY_DIMENSIONS,
    ).agg(
        F.grouping_id().alias("gid"),
        total.alias("total_claims"),
        F.sum("paid_n").alias("paid_claims"),
        F.sum("denied_n").alias("denied_claims"),
        pct("sum(denied_n)", "sum(n)").alias("denial_rate_pct"),
        sum_money("billed_s").alias("total_billed"),
        sum_money("paid_s").alias("total_paid"),
        pct("sum(rate_s)", "sum(rate_n)", unit=MONEY_UNIT).alias("mean_payment_rate_pct"),
        money_per("sum(ip_s)", "sum(ip_n)").alias("inpatient_avg_paid"),
        sum_money("bh_s").alias("behavioral_health_spend"),
        F.sum("id_n").alias("claim_count"),
    )
    def row(metric: Column, key: Column, value: Column) -> Column:
        return F.struct(
            metric.alias("metric"), key.cast("string").alias("key"), value.cast("double").alias("value")
        )

    gid = F.col("gid")
    rows = F.when(
        gid == _GID["all"],
        F.array(*[row(F.lit(m), F.lit(None), F.col(m)) for m in SCALAR_METRICS]),
    )
    for metric, dim in SUMMARY_MAP_METRICS.items():
        rows = rows.when(
            gid == _GID[dim], F.array(row(F.lit(metric), F.col(dim), F.col("total_paid")))
        )
    # the small rolled-up table is written: both parts read it
    g = written(g, "summary")
    top = (
        g.filter(gid == _GID["diagnosis_code"])
        .orderBy(F.desc("claim_count"), F.asc_nulls_last("diagnosis_code"))
        .limit(top_n)
        .select(F.inline(F.array(row(F.lit("top_diagnoses"), F.col("diagnosis_code"), F.col("claim_count")))))
    )
    return g.filter(gid != _GID["diagnosis_code"]).select(F.inline(rows)).unionByName(top)


# a map of the JSON record shows so many groups, largest first; the long rows, written beside it, have all
MAP_LIMIT = 1000


def summary_record(summary_long: DataFrame, run_timestamp: str) -> DataFrame:
    """One-row nested summary (scalars as columns, maps as MAP columns).

    Built from the long rows, and a view of them: a map shows the ``MAP_LIMIT``
    groups of largest value (state codes aren't checked, so their number isn't
    bounded). ``run_etl`` writes the long rows, with every group, as a table.
    """
    scalars = summary_long.filter(F.col("key").isNull() & (F.col("metric") != "top_diagnoses"))
    maps = summary_long.filter(
        F.col("metric").isin(*SUMMARY_MAP_METRICS.keys(), "top_diagnoses")
    )
    scalar_row = scalars.groupBy().pivot(
        "metric",
        SCALAR_METRICS,
    ).agg(F.first("value"))
    place = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc_nulls_last("value"), "key"))
    maps = maps.withColumn("_place", place).filter(F.col("_place") <= MAP_LIMIT)
    map_row = maps.groupBy().pivot(
        "metric", [*SUMMARY_MAP_METRICS.keys(), "top_diagnoses"]
    ).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.coalesce(F.col("key"), F.lit("null")), F.col("value")))
        )
    )
    return scalar_row.crossJoin(map_row).select(
        F.lit(run_timestamp).alias("run_timestamp"), "*"
    )


# E4 ---------------------------------------------------------------------------
@dataclass
class EtlResult:
    load_id: str
    curated_path: str
    paid_layer_path: str
    errors_path: str | None
    summary_path: str
    summary_rows_path: str
    counts: dict


def run_etl(
    spark: SparkSession,
    raw: DataFrame,
    output_dir: str,
    run_timestamp: str | None = None,
    partition_keys: tuple[str, ...] = ("state_code",),
    keep_loads: int | None = 3,
) -> EtlResult:
    """Validate, transform and write every output of one load, then publish it.

    ``output_dir`` should be shared storage on a cluster. The outputs go to a
    folder of this load and are committed together at the end
    (``sources.published``): readers of ``output_dir`` see the load before until
    then, whatever fails. The last ``keep_loads`` loads stay (None: all).

    The checked rows are written once, by validity, to the session's checkpoint
    folder and removed after the commit: a lost executor does not force
    re-reading the landing files, the transform reads the valid part by column,
    the error log the other. Give the lines of ``read_raw_lines``: then every
    error has the file and the number of its line.
    """
    with sized_shuffles(spark, stored_bytes(raw)), freed_shuffles(spark):
        return _run_etl(spark, raw, output_dir, run_timestamp, partition_keys, keep_loads)


def _run_etl(spark: SparkSession, raw: DataFrame, output_dir: str, run_timestamp: str | None, partition_keys: tuple[str, ...], keep_loads: int | None) -> EtlResult:
    ts = run_timestamp or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    load_id = f"{re.sub('[^0-9]', '', ts)[:14] or 'load'}-{uuid.uuid4().hex[:12]}"
    # raw / valid / invalid counts are filled in by the write itself
    # (observed there, not downstream: a range repartition's sampling job
    # would execute an observed node a second time)
    observed, obs = observe_counts(check(raw))
    checked = written(observed, "checked", INVALID, compression="zstd")

    out = published.load_folder(output_dir, load_id)
    tables: dict[str, str | None] = {}

    def place(table: str) -> str:
        tables[table] = f"{published.LOADS}/{load_id}/{table}"
        return f"{out}/{table}"

    curated_path = place("curated_claims")
    sinks.write_table(transform(valid_claims(checked)), curated_path)
    curated = read_curated(spark, curated_path)

    paid_path = place("curated_paid_by_state")
    sinks.write_partitioned(curated_paid(curated), paid_path, partition_keys)

    failed = validation_errors(checked)
    if LINE_KIND in checked.columns:
        failed = number_lines(failed, checked)
    errors_path = place("validation_errors")
    if not sinks.write_errors(failed, errors_path):
        errors_path = tables["validation_errors"] = None

    rows_path = place("summary_rows")
    sinks.write_table(analytics_summary(curated), rows_path)
    summary_path = place("analytics_summary")
    sinks.write_summary_json(summary_record(spark.read.parquet(rows_path), ts), summary_path)

    stamped = load_summary(checked).select(F.lit(ts).alias("run_timestamp"), "*")
    load_path = place("load_summary")
    sinks.write_summary_json(stamped, load_path)
    counts = spark.read.schema(stamped.schema).json(load_path).drop("run_timestamp").first().asDict()
    counts["observed"] = dict(obs.get)

    published.commit(spark, output_dir, load_id, tables, {"run_timestamp": ts, "counts": counts})
    discard(checked)
    if keep_loads:
        published.prune(spark, output_dir, keep_loads)
    return EtlResult(load_id, curated_path, paid_path, errors_path, summary_path, rows_path, counts)


__all__ = [
    "analytics_summary",
    "derive",
    "load_summary",
    "run_etl",
    "summary_record",
    "transform",
    "curated_paid",
    "validation_errors",
]
