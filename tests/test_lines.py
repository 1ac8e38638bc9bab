"""Line numbers of landing files: many splits, blank lines, repeated headers, compressed files, batch and stream."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from carelake.__main__ import curated_claims
from carelake.operators.quality import SchemaError, check, validation_errors
from carelake.plans.etl import run_etl
from carelake.schema import RAW_FIELDS
from carelake.session import written
from carelake.sources.files import file_headers, number_lines, read_lines, read_raw_csv, read_raw_lines
from carelake.streaming.landing import LandingPaths, start_landing_ingest

HEAD = ",".join(RAW_FIELDS)


def row(claim, kind="OP", state="06"):
    return ",".join([claim, f"M{claim}", state, "P1", "2024-01-05", kind, "D1", "99213", "10.00", "8.00", "PAID", "R1", "PHYSICIAN", "Y"])


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    """Folder and the wanted (file, line) of every bad row."""
    d = tmp_path_factory.mktemp("lines")
    want = {}
    for name, n, turned in (("a.csv", 4000, False), ("b.csv", 700, True), ("c.csv.gz", 300, False)):
        lines = ["", " \t"] if name == "b.csv" else []
        flip = (lambda t: ",".join(reversed(t.split(",")))) if turned else (lambda t: t)
        lines.append(flip(HEAD))
        for i in range(n):
            if i % 41 == 5:
                lines.append("" if i % 2 else "   ")
            if i % 997 == 3:
                lines.append(flip(HEAD))  # files put together
            bad = i % 13 == 0
            lines.append(flip(row(f"{name[0]}{i}", "XX" if bad else "OP")))
            if bad:
                want[f"{name[0]}{i}"] = (name, len(lines))
        text = "\n".join(lines) + ("" if name == "a.csv" else "\n")
        (gzip.open(d / name, "wt") if name.endswith("gz") else open(d / name, "w")).write(text)
    return str(d), want


def located(rows):
    return {r.claim_id: (os.path.basename(r.source_file), r.source_line) for r in rows}


@pytest.mark.parametrize("split", ["8k", "60k", "128m"])
def test_lines_do_not_depend_on_the_splits(spark, landing, split):
    path, want = landing
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        checked = written(check(read_raw_lines(spark, path)), "test-lines")
        assert located(number_lines(validation_errors(checked), checked).collect()) == want
        if split == "8k":
            assert checked.select("source_file", "source_split").distinct().count() > 20
        rows = read_raw_csv(spark, path)
        assert rows.count() == 5000 and rows.columns[:14] == RAW_FIELDS and "source_file" not in rows.columns
        assert rows.filter("claim_id IS NULL OR _corrupt_record IS NOT NULL").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_load_and_stream_report_lines(spark, landing, tmp_path):
    path, want = landing
    out = str(tmp_path / "out")
    res = run_etl(spark, read_raw_lines(spark, path), out, "t")
    assert located(spark.read.parquet(res.errors_path).collect()) == want
    assert (res.counts["rows_raw"], res.counts["rows_invalid"], res.counts["observed"]["rows_raw"]) == (5000, len(want), 5000)
    # states stay text for reports too, over the layer by state as over the wide table
    for table in ("", "/curated_claims", "/curated_paid_by_state"):
        assert {r.state_code for r in curated_claims(spark, out + table).select("state_code").distinct().collect()} == {"06"}
    assert {r.state_code for r in curated_claims(spark, res.paid_layer_path).select("state_code").distinct().collect()} == {"06"}
    paths = LandingPaths(path, str(tmp_path / "claims"), str(tmp_path / "errors"), str(tmp_path / "ckpt"))
    start_landing_ingest(spark, paths).awaitTermination(120)
    assert located(spark.read.parquet(paths.errors_dir).collect()) == want


def test_headers_come_from_the_first_line_only(spark, tmp_path):
    (tmp_path / "x.csv").write_text(row("1") + "\n" + HEAD + "\n" + row("2") + "\n")
    heads = file_headers(read_lines(spark, str(tmp_path / "x.csv"))).collect()
    assert [h["_header"] for h in heads] == [None]
    with pytest.raises(SchemaError, match="Missing.*x.csv"):
        read_raw_csv(spark, str(tmp_path / "x.csv"))
    (tmp_path / "y.csv").write_text(HEAD + ",source_row\n")
    with pytest.raises(SchemaError, match="Reserved"):
        read_raw_csv(spark, str(tmp_path / "y.csv"))


def test_no_file_is_opened_from_the_driver(spark, landing):
    """The plan over several layouts is one scan of lines; files with another header come from a table."""
    path, _ = landing
    df = read_raw_csv(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("FileScan parquet") == 1
    assert df.select(F.count_distinct("claim_id")).first()[0] == 5000
