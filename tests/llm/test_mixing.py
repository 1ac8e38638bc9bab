"""Mixing: against the SQL, targets against the resharing loop, odd rows."""

import duckdb
import pytest

from carelake.llm import mixing as M


def reshared(sizes):
    """Targets by resharing what is above the cap, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = 2 * sizes[s]
            budget -= target[s]
            open_.discard(s)
    return target


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 3, "é": 70, None: 40}, {"z": 5}, {"a": 0, "b": 8}, {"a": 100, "b": 1, "c": 1, "d": 1}):
        rows = M.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint")).collect()
        want = reshared(sizes)
        assert {r.source: r.source_size for r in rows} == sizes
        for r in rows:
            assert r.target == pytest.approx(want[r.source])
        assert sum(r.target for r in rows) == pytest.approx(1.5 * sum(sizes.values()))


def test_query_matches_sql(spark, small_dir):
    got = sorted(map(tuple, M.op3_mixing(spark, small_dir).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_dir}/documents.parquet'")
    assert got == sorted(con.execute(M.OP3_SQL).fetchall())


def test_budgets_ties_and_odd_rows(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "word " * (i % 50)) for i in range(3000)]
    rows += [(5, "hot", "word " * 9), (5, "hot", "word " * 9), (None, None, None), (None, None, "one two"), (9999, "hot", "x " * 20_000), (10_001, "void", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("taken", M.F.lit("clash"))
    out = M.mix(df, bands=16).collect()
    assert len(out) == len(rows)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, M.mix(df, bands=4096).collect()), key=str)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        total = by.setdefault(r.source, [0, r.target, 0])
        total[0] += r.taken
        total[2] = max(total[2], r.size)
    for taken, target, largest in by.values():
        assert abs(taken - target) <= largest / 2 + 1e-6
    assert M.mix(df.limit(0)).count() == 0
