"""Command line: run the ETL on landing files, or a report on curated claims.

    python -m carelake etl <landing_csv_path> <output_dir> [--partition-by state_code,service_year]
    python -m carelake report <name> <curated> <output_path>
    python -m carelake reports

``curated`` is a claims table, or the output folder of ``etl``: then the report
reads the curated table of the load published there (``<folder>/<table>`` names
another of its tables).

On a cluster submit it with spark-submit; the session comes from the
submitting environment (its checkpoint folder included).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from carelake.plans import analytics as A
from carelake.plans import notes as N
from carelake.plans import segments as V


def _reports() -> dict:
    return {
        "baseline_kpis": A.baseline_kpis,
        "monthly_spend_trend": A.monthly_spend_trend,
        "spend_by_state_plan": A.spend_by_state_plan,
        "high_cost_members": A.high_cost_members,
        "behavioral_utilization": A.behavioral_utilization,
        "behavioral_by_state": A.behavioral_by_state,
        "behavioral_share_of_state": A.behavioral_share_of_state,
        "denial_rate_by_provider": A.denial_rate_by_provider,
        "top_diagnoses_by_spend": A.top_diagnoses_by_spend,
        "denied_with_payment": A.denied_with_payment,
        "readmission_pairs": A.readmission_pairs,
        "repeat_inpatient_members": A.repeat_inpatient_members,
        "behavioral_spend_by_state": A.behavioral_spend_by_state,
        "executive_metrics": A.executive_metrics,
        "top_diagnoses_by_count": A.top_diagnoses_by_count,
        "pareto_curve": V.pareto_curve,
        "top_share": V.top_share,
        "spend_by_claim_type": V.spend_by_claim_type,
        "unit_cost_by_claim_type": V.unit_cost_by_claim_type,
        "cost_segments": V.cost_segments,
        "segment_claim_type_mix": V.segment_claim_type_mix,
        "segment_age_mix": V.segment_age_mix,
        "headline_counts": V.headline_counts,
        "executive_summary_text": N.executive_summary_text,
        "anomaly_payload": N.anomaly_payload,
        "explain_anomalies": N.explain_anomalies,
    }


def curated_claims(spark: SparkSession, path: str) -> DataFrame:
    """The claims of a table, or of the load published in the folder or for the table named."""
    from carelake.sources.files import read_layout
    from carelake.sources.published import LAYOUTS, latest, read_published

    folder, _, table = path.rstrip("/").rpartition("/")
    if latest(spark, path):
        return read_published(spark, path, "curated_claims")
    if table in LAYOUTS and latest(spark, folder):
        return read_published(spark, folder, table)
    return read_layout(spark, path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="carelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    etl = sub.add_parser("etl", help="validate, transform and write one load")
    etl.add_argument("landing")
    etl.add_argument("output")
    etl.add_argument("--partition-by", default="state_code")
    rep = sub.add_parser("report", help="run one report over a curated table")
    rep.add_argument("name", choices=sorted(_reports()))
    rep.add_argument("curated")
    rep.add_argument("output")
    sub.add_parser("reports", help="list report names")
    args = ap.parse_args(argv)

    if args.cmd == "reports":
        print("\n".join(sorted(_reports())))
        return 0

    spark = SparkSession.builder.appName(f"carelake-{args.cmd}").getOrCreate()
    if args.cmd == "etl":
        from carelake.plans.etl import run_etl
        from carelake.sources.files import read_raw_lines

        res = run_etl(spark, read_raw_lines(spark, args.landing), args.output, partition_keys=tuple(args.partition_by.split(",")))
        print(json.dumps({k: v for k, v in res.counts.items()}, default=str))
    else:
        claims = curated_claims(spark, args.curated)
        out: DataFrame = _reports()[args.name](claims)
        out.write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
