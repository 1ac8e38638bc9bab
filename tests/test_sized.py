"""Work that follows the input: one parse a line, one shuffle for windows, parts by the input's size."""

from pyspark.sql import functions as F

from carelake import session
from carelake.operators import quality as Q
from carelake.operators.member_windows import member_windows, plain_member_windows
from carelake.plans.transform import derive
from carelake.schema import RAW_FIELDS
from carelake.sources import claims_table as C
from carelake.sources import clustered as L
from carelake.sources.files import read_raw_csv

ROW = "c{i},m{m},CA,P,2024-01-1{d},IP,D,PR,10.00,{paid},PAID,V,HOSPITAL,Y"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([",".join(RAW_FIELDS), *[ROW.format(i=i, m=i % 3, d=i % 9, paid=i if i % 4 else "x") for i in range(20)]]) + "\n")
    checked = Q.check(read_raw_csv(spark, str(tmp_path)))
    valid = Q.valid_claims(checked)
    for df, rows in ((valid, 15), (derive(valid), 15), (Q.validation_errors(checked), 5)):
        assert df.count() == rows
        assert plan(df).count("from_csv") == 1


def claims(spark, members):
    rows = [(f"c{i:04d}", m, f"2024-0{1 + i % 8}-1{i % 9}", i % 7) for i, m in enumerate(members)]
    df = spark.createDataFrame(rows, "claim_id string, member_id string, d string, a int")
    return df.select("claim_id", "member_id", F.col("d").cast("date").alias("service_date"), F.col("a").cast("decimal(18,4)").alias("paid_amount"))


def test_windows_take_one_shuffle_and_write_nothing(spark):
    df = claims(spark, [f"m{i % 40}" for i in range(400)])
    got = member_windows(df)
    assert "Relation" not in plan(got) and plan(got).count("Repartition") == 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain_member_windows(df).collect()))


def test_hot_and_other_members_make_a_whole(spark):
    df = claims(spark, [f"m{i % 40}" if i % 2 else "HOT" for i in range(800)])
    assert sorted(map(tuple, member_windows(df).collect())) == sorted(map(tuple, plain_member_windows(df).collect()))
    nobody = member_windows(claims(spark, [None] * 5 + ["a"] * 5))
    assert {r.member_cumulative_paid is None for r in nobody.collect() if r.member_id is None} == {True}


def test_parts_follow_the_stored_bytes(spark):
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(spark, 100 * session.TASK_BYTES):
        assert int(spark.conf.get(name)) >= 100
    with session.sized_shuffles(spark, session.TASK_BYTES):
        assert spark.conf.get(name) == before
    assert spark.conf.get(name) == before


def test_buckets_follow_the_rows():
    assert C.buckets_for(0) == C.buckets_for(C.BUCKETS * C.BUCKET_ROWS) == C.BUCKETS
    assert all(rows <= C.buckets_for(rows) * C.BUCKET_ROWS < 2 * rows for rows in (20_000_000, 36_000_000, 216_000_000))


def test_a_range_is_sought_once_a_row(spark):
    df = spark.createDataFrame([(f"s{i:02d}", i) for i in range(70)] + [(None, None)], "s string, n int")
    cuts = {"s": [f"s{i:02d}" for i in range(1, 64)], "n": [3, 9, 10, 50, 51]}
    want = [(0 if s is None else sum(b <= s for b in cuts["s"]), 0 if n is None else sum(b <= n for b in cuts["n"])) for s, n in df.collect()]
    assert [tuple(r) for r in df.select(*[L.range_number(F.col(c), b) for c, b in cuts.items()]).collect()] == want
    placed = L.with_place(df, cuts)
    assert plan(placed).count("aggregate(") == 2
    assert [r._place for r in placed.collect()] == [r[0] for r in df.select(L.curve_place(cuts)).collect()]
