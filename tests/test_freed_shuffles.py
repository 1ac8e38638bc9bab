"""Builds and loads leave none of their shuffle files behind."""

import os
import shutil
import time

from pyspark.sql import functions as F

from carelake.plans import etl
from carelake.schema import RAW_FIELDS, partition_schema
from carelake.session import discard, freed_shuffles
from carelake.sources.claims_table import load_claims_table
from carelake.sources.clustered import write_clustered
from carelake.sources.files import read_raw_lines
from carelake.sources.layer import build_claims_layer
from carelake.streaming.landing import LandingPaths, start_landing_ingest


def shuffles_on_disk(spark):
    """Numbers of the shuffles that have files in the session's local folders."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {int(f.split("_")[1]) for top in folders for d, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def claims_rows(spark):
    """60 claims, half of them of one member."""
    text = [F.concat(F.lit(f"{f}-"), F.col("id") % 7).alias(f) for f in RAW_FIELDS[2:]]
    made = spark.range(60).select(F.concat(F.lit("c"), F.col("id")).alias("claim_id"), F.when(F.col("id") % 2 == 0, "m").otherwise(F.col("id").cast("string")).alias("member_id"), *text)
    given = {f.name: f.dataType for f in partition_schema(RAW_FIELDS).fields}
    return made.select(*[F.lit("2024-01-01").cast("date").alias(c) if c == "service_date" else F.expr(f"try_cast({c} AS {given[c].simpleString()})").alias(c) for c in RAW_FIELDS])


def new_number(spark):
    """The number of a shuffle made now: later ones have higher numbers."""
    spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save()
    return max(shuffles_on_disk(spark))


def left_since(spark, number):
    """Later shuffles still on disk; files are removed beside the query, so they are waited for."""
    until = time.time() + 10
    while (left := {n for n in shuffles_on_disk(spark) if n > number}) and time.time() < until:
        time.sleep(0.1)
    return left


def test_freed_shuffles_only_within(spark):
    number = new_number(spark)
    with freed_shuffles(spark):
        rows = spark.range(1000).repartition(3, "id")
        rows.write.format("noop").mode("overwrite").save()
        assert len(rows.collect()) == len(rows.collect()) == 1000  # what is read again is shuffled again
    assert not left_since(spark, number)
    assert len(rows.collect()) == 1000
    number = new_number(spark)
    rows.write.format("noop").mode("overwrite").save()
    assert {n for n in shuffles_on_disk(spark) if n > number}


def test_layer(spark, small_dir, tmp_path):
    number = new_number(spark)
    build_claims_layer(spark, small_dir, str(tmp_path / "layer"))
    assert not left_since(spark, number)


def test_etl(spark, tmp_path, data_path):
    raw = read_raw_lines(spark, data_path("claims_defects.csv"))
    number = new_number(spark)
    etl.run_etl(spark, raw, str(tmp_path / "out"), "2024-01-01T00:00:00")
    assert not left_since(spark, number)


def test_checked_rows_compressed(spark, tmp_path, data_path, monkeypatch):
    kept = []
    monkeypatch.setattr(etl, "discard", kept.append)
    etl.run_etl(spark, read_raw_lines(spark, data_path("claims_defects.csv")), str(tmp_path / "out"), "2024-01-01T00:00:00")
    files = [f for checked in kept for f in checked.inputFiles()]
    assert files and all(".zstd." in f for f in files)
    discard(kept[0])


def test_claims_table(spark, tmp_path):
    rows = claims_rows(spark)
    number = new_number(spark)
    load_claims_table(spark, rows, "freed_claims", str(tmp_path / "table"), buckets=4, hot_rows=20)
    assert not left_since(spark, number)
    assert spark.table("freed_claims_all").count() == 60
    for kind, name in (("VIEW", "freed_claims_all"), ("TABLE", "freed_claims"), ("TABLE", "freed_claims_hot")):
        spark.sql(f"DROP {kind} {name}")


def test_clustered(spark, tmp_path):
    rows = claims_rows(spark)
    number = new_number(spark)
    write_clustered(rows, str(tmp_path / "clustered"), rows_per_file=20)
    assert not left_since(spark, number)
    assert spark.read.parquet(str(tmp_path / "clustered")).count() == 60


def test_landing(spark, tmp_path, data_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(data_path("claims_fixture.csv"), landing)
    paths = LandingPaths(str(landing), *[str(tmp_path / p) for p in ("claims", "errors", "checkpoint")])
    number = new_number(spark)
    start_landing_ingest(spark, paths).awaitTermination()
    assert not left_since(spark, number)
    assert spark.read.parquet(paths.claims_dir).count() > 0
