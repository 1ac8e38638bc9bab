"""Landing files with other headers and broken rows, batch and stream; reruns, layers and typed read-back."""

import gzip
import os
import shutil
import time
from statistics import median

import pytest
from pyspark.sql import functions as F

from carelake.operators.quality import SchemaError, check, valid_claims, validation_errors
from carelake.operators.ranking import exact_median, global_running, plain_running
from carelake.plans.etl import run_etl
from carelake.schema import CURATED_PAID_FIELDS, RAW_FIELDS
from carelake.session import ensure_checkpoint_dir
from carelake.sources import sinks
from carelake.sources.files import read_curated, read_raw_csv
from carelake.sources.layer import fingerprint
from carelake.sources.published import table_path
from carelake.streaming.landing import LandingPaths, start_landing_ingest

HEAD = ",".join(RAW_FIELDS)


def line(claim, member, state="OH", n=14):
    return ",".join([claim, member, state, "P1", "2024-01-05", "OP", "D1", "99213", "10.00", "8.00", "PAID", "R1", "PHYSICIAN", "Y", "extra"][:n])


@pytest.fixture
def landing(tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    (d / "a.csv").write_text("\n".join([HEAD, line("C1", "M1"), line("C2", "M2", n=15), line("C3", "M3", n=13)]) + "\n")
    names = RAW_FIELDS[:]
    names[0], names[1] = names[1], names[0]
    (d / "b.csv").write_text("﻿" + ",".join(f'"{n}"' for n in names) + "\n" + line("M9", "C9") + "\n")
    with gzip.open(d / "c.csv.gz", "wt") as f:
        f.write(",".join(reversed(RAW_FIELDS)) + "\n" + ",".join(reversed(line("C5", "M5", "06").split(","))) + "\n")
    (d / "empty.csv").write_text("")
    return d


VALID = [("C1", "M1", "OH"), ("C5", "M5", "06"), ("C9", "M9", "OH")]


def test_each_file_is_bound_by_its_own_header(spark, landing):
    checked = check(read_raw_csv(spark, str(landing), with_source=True))
    ok = sorted(map(tuple, valid_claims(checked).select("claim_id", "member_id", "state_code").collect()))
    assert ok == VALID
    bad = sorted((r.claim_id, r.rule, r.bad_value, os.path.basename(r.source_file)) for r in validation_errors(checked).collect())
    assert bad == [("C2", "MALFORMED_ROW", line("C2", "M2", n=15), "a.csv"), ("C3", "MALFORMED_ROW", line("C3", "M3", n=13), "a.csv")]
    # pruned plans count the same
    assert checked.filter("_invalid").select("claim_id").count() == 2 and checked.select("member_id").count() == 5


def test_missing_and_repeated_columns_abort(spark, tmp_path):
    (tmp_path / "x.csv").write_text("claim_id,member_id\n1,2\n")
    with pytest.raises(SchemaError, match="Missing"):
        read_raw_csv(spark, str(tmp_path / "x.csv"))
    (tmp_path / "y.csv").write_text(HEAD + ",claim_id\n")
    with pytest.raises(SchemaError, match="Repeated"):
        read_raw_csv(spark, str(tmp_path / "y.csv"))
    (tmp_path / "z.csv").write_text("")
    with pytest.raises(SchemaError, match="empty"):
        read_raw_csv(spark, str(tmp_path / "z.csv"))


def test_stream_binds_and_reports_like_the_batch(spark, landing, tmp_path):
    paths = LandingPaths(str(landing), str(tmp_path / "claims"), str(tmp_path / "errors"), str(tmp_path / "ckpt"))
    start_landing_ingest(spark, paths).awaitTermination(120)
    got = read_curated(spark, paths.claims_dir, RAW_FIELDS)
    assert sorted(map(tuple, got.select("claim_id", "member_id", "state_code").collect())) == VALID
    assert sorted(r.claim_id for r in spark.read.parquet(paths.errors_dir).collect()) == ["C2", "C3"]
    start_landing_ingest(spark, paths).awaitTermination(120)  # nothing new
    assert read_curated(spark, paths.claims_dir, RAW_FIELDS).count() == 3


def test_clean_rerun_leaves_no_error_log_and_states_stay_text(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    first = run_etl(spark, read_raw_csv(spark, str(landing)), out, "t")
    assert first.counts["error_count"] == 2 and os.path.exists(table_path(spark, out, "validation_errors"))
    (landing / "a.csv").write_text(HEAD + "\n" + line("C1", "M1") + "\n")
    second = run_etl(spark, read_raw_csv(spark, str(landing)), out, "t")
    assert second.errors_path is None and table_path(spark, out, "validation_errors") is None
    assert sorted(r.state_code for r in read_curated(spark, second.paid_layer_path, CURATED_PAID_FIELDS).collect()) == ["06", "OH", "OH"]


def test_salted_write_uses_several_files(spark, tmp_path):
    df = spark.range(400).select(F.lit("OH").alias("state_code"), F.col("id").cast("string").alias("claim_id"))
    sinks.write_partitioned(df, str(tmp_path / "s"), ("state_code",), salt_buckets=4)
    files = [f for f in os.listdir(tmp_path / "s" / "state_code=OH") if f.endswith(".parquet")]
    assert 2 <= len(files) <= 4 and spark.read.parquet(str(tmp_path / "s")).count() == 400


def test_rewritten_source_gets_another_layer(spark, small_dir, tmp_path):
    for t in ("lineitem", "orders", "customer", "nation", "part"):
        shutil.copy(f"{small_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = fingerprint(spark, str(tmp_path))
    assert before == fingerprint(spark, str(tmp_path))
    time.sleep(0.01)
    os.chmod(tmp_path / "part.parquet", 0o644)
    os.utime(tmp_path / "part.parquet")
    assert fingerprint(spark, str(tmp_path)) != before


def test_scratch_folder_only_on_a_local_master():
    class Fake:
        conf = {"spark.master": "spark://host:7077"}

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Fake())


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_bands_do_not_depend_on_the_plan(spark, reuse):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("decimal(18,4)").alias("v"), (F.col("id") * 2).alias("carried"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        want = sorted((r.k, r["rank"], r.running) for r in plain_running(df, "v", "k").collect())
        got = global_running(df, "v", "k", bands=7, carry=("carried",))
        assert sorted((r.k, r["rank"], r.running) for r in got.collect()) == want
        assert all(r.carried == 2 * int(r.k) for r in got.collect())
        assert float(exact_median(df, "v", "k", bands=7).first().median) == median([7 if i % 3 == 0 else i % 50 for i in range(3000)])
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_nulls_odd_numbers_and_lengths_are_reported(spark, tmp_path):
    def row(**change):
        values = dict(zip(RAW_FIELDS, line("C1", "M1").split(","))) | change
        return ",".join(values[f] for f in RAW_FIELDS)

    rows = [
        row(claim_id=""), row(claim_id="C2", service_date=""), row(claim_id="C3", claim_status=""), row(claim_id="C4", paid_amount=""),
        row(claim_id="C5", billed_amount="1.0d"), row(claim_id="C6", paid_amount="1e3"), row(claim_id="C7") + ",x,y", row(claim_id="C8", claim_status="NULL"),
    ]
    (tmp_path / "x.csv").write_text("\n".join([HEAD, *rows]) + "\n")
    checked = check(read_raw_csv(spark, str(tmp_path / "x.csv")))
    got = sorted(((r.claim_id or ""), r.rule, r.field) for r in validation_errors(checked).collect())
    assert got == sorted([
        ("", "NULL_VALUE", "claim_id"), ("C2", "NULL_VALUE", "service_date"), ("C3", "NULL_VALUE", "claim_status"), ("C3", "UNKNOWN_CLAIM_STATUS", "claim_status"),
        ("C4", "NULL_VALUE", "paid_amount"), ("C4", "NON_NUMERIC", "paid_amount"), ("C5", "NON_NUMERIC", "billed_amount"), ("C7", "MALFORMED_ROW", "_corrupt_record"),
        ("C8", "NULL_VALUE", "claim_status"), ("C8", "UNKNOWN_CLAIM_STATUS", "claim_status"),
    ])
    assert [(r.claim_id, float(r.paid_amount)) for r in valid_claims(checked).collect()] == [("C6", 1000.0)]


def test_reports_come_sorted(spark, data_path):
    from carelake.plans import analytics as A
    from carelake.sources.files import read_claims_csv

    claims = read_claims_csv(spark, data_path("claims_fixture.csv"))
    paid = [r.total_paid for r in A.spend_by_state_plan(claims).collect()]
    assert len(paid) > 1 and paid == sorted(paid, reverse=True)
    months = [(r.service_month, r.claim_type) for r in A.monthly_spend_trend(claims).collect()]
    assert len(months) > 1 and months == sorted(months)
