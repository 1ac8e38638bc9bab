"""End-to-end ETL: one load writes curated, PAID-by-state, errors, summaries."""

import json
import os
import shutil

from pyspark.sql import functions as F

from carelake.plans.etl import run_etl
from carelake.sources.files import read_raw_csv, register, run_sql
from carelake.sources.published import table_path
from carelake.streaming.landing import LandingPaths, start_landing_ingest


def _raw(spark, data_path):
    return read_raw_csv(spark, data_path("claims_fixture.csv")).unionByName(
        read_raw_csv(spark, data_path("claims_defects.csv"))
    )


def test_run_etl(spark, data_path, tmp_path):
    res = run_etl(spark, _raw(spark, data_path), str(tmp_path / "out"), run_timestamp="2024-01-01T00:00:00")
    c = res.counts
    assert (c["rows_raw"], c["rows_valid"], c["rows_invalid"], c["error_count"]) == (33, 18, 15, 18)
    assert c["anomalies_found"] == 2  # C10 and D18
    assert c["observed"]["rows_raw"] == 33 and c["observed"]["rows_valid"] == 18
    curated = spark.read.parquet(res.curated_path)
    assert curated.count() == 18 and len(curated.columns) == 24
    paid = spark.read.parquet(res.paid_layer_path)
    assert paid.filter(F.col("claim_status") != "PAID").count() == 0
    states = sorted(d for d in os.listdir(res.paid_layer_path) if d.startswith("state_code="))
    assert states == ["state_code=OH", "state_code=WA"]
    assert spark.read.parquet(res.errors_path).count() == 18
    summary_file = [f for f in os.listdir(res.summary_path) if f.endswith(".json")][0]
    summary = json.loads(open(os.path.join(res.summary_path, summary_file)).readline())
    assert summary["run_timestamp"] == "2024-01-01T00:00:00"
    assert summary["total_claims"] == 18
    assert set(summary["spend_by_claim_type"]) == {"IP", "OP", "LTC", "RX"}
    assert len(summary["top_diagnoses"]) == 5


def test_sql_runner(spark, data_path):
    from carelake.sources.files import read_claims_csv

    register(read_claims_csv(spark, data_path("claims_fixture.csv")), "claims")
    r = run_sql(
        spark,
        "SELECT count(*) AS n FROM claims WHERE claim_status = :s",
        {"s": "PAID"},
    ).first()
    assert r.n == 11


def test_streaming_landing(spark, data_path, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(data_path("claims_fixture.csv"), landing / "a.csv")
    paths = LandingPaths(str(landing), str(tmp_path / "claims"), str(tmp_path / "errors"), str(tmp_path / "ckpt"))
    q = start_landing_ingest(spark, paths)
    q.awaitTermination(120)
    assert spark.read.parquet(paths.claims_dir).count() == 15
    # a second file arrives; a rerun loads only the new one
    shutil.copy(data_path("claims_defects.csv"), landing / "b.csv")
    q = start_landing_ingest(spark, paths)
    q.awaitTermination(120)
    assert spark.read.parquet(paths.claims_dir).count() == 18
    assert spark.read.parquet(paths.errors_dir).count() == 18


def test_error_rows_carry_source_file(spark, data_path):
    from carelake.operators.quality import check, validation_errors

    raw = read_raw_csv(spark, data_path("claims_defects.csv"), with_source=True)
    files = {r.source_file for r in validation_errors(check(raw)).collect()}
    assert len(files) == 1 and files.pop().endswith("claims_defects.csv")


def test_cli_etl_and_report(spark, data_path, tmp_path):
    from carelake.__main__ import main

    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(data_path("claims_fixture.csv"), landing / "a.csv")
    out = tmp_path / "out"
    assert main(["etl", str(landing), str(out), "--partition-by", "state_code,service_year"]) == 0
    assert os.path.isdir(os.path.join(table_path(spark, str(out), "curated_paid_by_state"), "state_code=OH"))
    assert main(["report", "baseline_kpis", str(out / "curated_claims"), str(tmp_path / "kpi")]) == 0
    r = spark.read.parquet(str(tmp_path / "kpi")).first()
    assert (r.total_claims, r.paid_claims, r.denied_claims) == (15, 11, 2)
