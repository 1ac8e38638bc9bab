"""Loads appear as a whole: a failure at any write leaves the load before; manifests, rival commits, pruning."""

import json
import os

import pytest

from carelake.plans import etl as E
from carelake.sources import published as P
from carelake.sources import sinks
from carelake.sources.files import read_raw_csv, read_raw_lines

TABLES = ["curated_claims", "curated_paid_by_state", "validation_errors", "summary_rows"]


def contents(spark, out):
    rows = {t: sorted(map(str, P.read_published(spark, out, t).collect())) for t in TABLES}
    rows["load"] = P.latest(spark, out)["facts"]
    return rows


@pytest.fixture(scope="module")
def first_load(spark, data_path, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("loads"))
    E.run_etl(spark, read_raw_lines(spark, data_path("claims_fixture.csv")).unionByName(read_raw_lines(spark, data_path("claims_defects.csv"))), out, "2024-01-01T00:00:00")
    return out, contents(spark, out)


# every write of a load, in order, and the commit: (module, function, which call of it fails)
STEPS = [("write_table", 1), ("write_partitioned", 1), ("write_errors", 1), ("write_table", 2), ("write_summary_json", 1), ("write_summary_json", 2), ("commit", 1)]


@pytest.mark.parametrize("name,nth", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failure_at_any_step_leaves_the_load_before(spark, data_path, first_load, monkeypatch, name, nth, when):
    if name == "commit" and when == "after":
        pytest.skip("a commit that is done counts")
    out, before = first_load
    module = P if name == "commit" else sinks
    real, calls = getattr(module, name), []

    def broken(*args, **kw):
        calls.append(1)
        if len(calls) != nth:
            return real(*args, **kw)
        if when == "after":
            real(*args, **kw)
        raise RuntimeError("killed here")

    monkeypatch.setattr(module, name, broken)
    with pytest.raises(RuntimeError, match="killed here"):
        E.run_etl(spark, read_raw_lines(spark, data_path("claims_fixture.csv")), out, "2024-02-01T00:00:00")
    assert contents(spark, out) == before


def test_the_next_load_replaces_and_prune_keeps_the_last(spark, data_path, tmp_path):
    out = str(tmp_path / "out")
    raw = read_raw_lines(spark, data_path("claims_fixture.csv"))
    ids = [E.run_etl(spark, raw, out, f"2024-0{i}-01T00:00:00", keep_loads=2).load_id for i in (1, 2, 3)]
    assert P.latest(spark, out)["load_id"] == ids[2] and P.latest(spark, out)["facts"]["run_timestamp"] == "2024-03-01T00:00:00"
    assert sorted(os.listdir(f"{out}/{P.LOADS}")) == sorted(ids[1:])
    assert P.read_published(spark, out, "curated_claims").count() == 15
    assert P.table_path(spark, out, "validation_errors") is None  # a load without errors has no log
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, out, "validation_errors")


def test_rival_commits_and_broken_manifests(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "root")
    assert P.latest(spark, out) is None
    with pytest.raises(FileNotFoundError):
        P.table_path(spark, out, "curated_claims")
    assert P.commit(spark, out, "a", {"t": "loads/a/t"}, {}) == 1
    # a load that listed the manifests before the other committed gets the next number, and overwrites nothing
    real = P._manifest_files
    monkeypatch.setattr(P, "_manifest_files", lambda *a: [])
    assert P.commit(spark, out, "b", {"t": "loads/b/t"}, {}) == 2
    monkeypatch.setattr(P, "_manifest_files", real)
    assert P.latest(spark, out)["load_id"] == "b"
    for n, text in ((3, ""), (4, '{"load_id": "c", "tab'), (5, "[1]"), (6, json.dumps({"load_id": "d"}))):
        (tmp_path / "root" / P.MANIFESTS / f"{n:012d}.json").write_text(text)
    assert P.latest(spark, out)["load_id"] == "b" and P.table_path(spark, out, "t") == f"{out}/loads/b/t"
    assert P.commit(spark, out, "e", {}, {}) == 7


def test_all_groups_are_written_though_the_record_shows_some(spark, data_path, tmp_path, monkeypatch):
    monkeypatch.setattr(E, "MAP_LIMIT", 1)
    res = E.run_etl(spark, read_raw_csv(spark, data_path("claims_fixture.csv")), str(tmp_path / "out"), "t")
    rows = spark.read.parquet(res.summary_rows_path).filter("metric = 'spend_by_claim_type'").collect()
    assert {r.key for r in rows} == {"IP", "OP", "LTC", "RX"}
    record = spark.read.json(res.summary_path).first()
    assert len([v for v in record.spend_by_claim_type if v is not None]) == 1
