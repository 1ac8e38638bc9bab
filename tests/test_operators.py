"""Distributed operators against their plain single-window / brute-force forms."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from carelake.operators.member_windows import member_windows, plain_member_windows
from carelake.operators.ranking import exact_median, global_running, plain_running
from carelake.operators.readmission import readmission_pairs


def _claims(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # member "HOT" holds a third of the rows
        m = "HOT" if i % 3 == 0 else f"M{rnd.randint(1, 200)}"
        day = rnd.randint(0, 400)
        rows.append(
            (f"C{i:05d}", m, dt.date(2022, 1, 1) + dt.timedelta(days=day),
             rnd.choice(["IP", "IP", "OP"]), rnd.choice(["PAID", "PAID", "DENIED"]),
             float(rnd.choice([0, 10, 10, 25.5, 100])))
        )
    df = spark.createDataFrame(
        rows, "claim_id string, member_id string, service_date date, claim_type string, claim_status string, paid_amount double"
    )
    return df.select(
        "claim_id", "member_id", F.col("service_date").cast("date").alias("service_date"),
        "claim_type", "claim_status", F.col("paid_amount").cast("decimal(18,4)").alias("paid_amount"),
    )


def test_member_windows_equal_plain(spark):
    cols = ["claim_id", "member_cumulative_paid", "days_since_last_claim"]
    for n, seed in [(3000, 7), (3000, 3), (500, 1), (5, 2)]:
        df = _claims(spark, n=n, seed=seed)
        want = sorted(tuple(r) for r in plain_member_windows(df).select(*cols).collect())
        assert sorted(tuple(r) for r in member_windows(df).select(*cols).collect()) == want


def test_member_windows_hot_member_day(spark):
    """A third of all rows belong to one member on one day (exact, though
    that day shares one task)."""
    rows = [
        (
            f"C{i:05d}",
            "HOT" if i % 3 == 0 else f"M{i % 50}",
            dt.date(2022, 1, 1) + dt.timedelta(days=0 if i % 3 == 0 else i % 30),
            float(i % 7),
        )
        for i in range(3000)
    ]
    df = spark.createDataFrame(
        rows, "claim_id string, member_id string, service_date date, paid_amount double"
    ).withColumn("paid_amount", F.col("paid_amount").cast("decimal(18,4)"))
    cols = ["claim_id", "member_cumulative_paid", "days_since_last_claim"]
    want = sorted(tuple(r) for r in plain_member_windows(df).select(*cols).collect())
    assert sorted(tuple(r) for r in member_windows(df).select(*cols).collect()) == want


def test_global_running_with_ties(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("decimal(18,4)").alias("v")
    )
    for desc in (True, False):
        a = sorted(tuple(r) for r in global_running(df, "v", "k", desc, bands=9).collect())
        b = sorted(tuple(r) for r in plain_running(df, "v", "k", desc).collect())
        assert a == b


def test_global_running_without_exchange_reuse(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 5).cast("decimal(18,4)").alias("v")
    )
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        a = sorted(tuple(r) for r in global_running(df, "v", "k", True, bands=7).collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    b = sorted(tuple(r) for r in plain_running(df, "v", "k", True).collect())
    assert a == b


def test_exact_median(spark):
    for n in (1, 2, 7, 1000, 1001):
        vals = [random.Random(n).randint(0, 50) for _ in range(n)]
        df = spark.createDataFrame([(str(i), v) for i, v in enumerate(vals)], "k string, v long")
        got = float(exact_median(df, "v", "k", bands=5).first().median)
        assert got == float(pd.Series(vals).median())


def test_readmission_equals_bruteforce(spark):
    df = _claims(spark, n=1500)
    got = sorted(
        (r.first_admit, r.readmit_claim, r.days_between)
        for r in readmission_pairs(df, 30).collect()
    )
    p = df.toPandas()
    p = p[(p.claim_type == "IP") & (p.claim_status == "PAID")]
    m = p.merge(p, on="member_id")
    m["gap"] = (pd.to_datetime(m.service_date_y) - pd.to_datetime(m.service_date_x)).dt.days
    m = m[(m.claim_id_x != m.claim_id_y) & (m.gap > 0) & (m.gap <= 30)]
    want = sorted(zip(m.claim_id_x, m.claim_id_y, m.gap.astype(int)))
    assert got == want


def test_hot_member_is_split_across_tasks(spark):
    """One member holds a third of the rows: the day-level form spreads them
    over many window partitions; a member-wide window puts them in one."""
    df = _claims(spark, n=6000, seed=11)
    saved = {
        k: spark.conf.get(k)
        for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        def hot_rows_per_partition(out):
            tagged = out.select(
                "member_id", "member_cumulative_paid", F.spark_partition_id().alias("p")
            )
            hot = (F.col("member_id") == "HOT") & F.col("member_cumulative_paid").isNotNull()
            rows = tagged.groupBy("p").agg(F.count_if(hot).alias("hot")).collect()
            return max(r.hot for r in rows), sum(r.hot for r in rows)

        day_max, hot_total = hot_rows_per_partition(member_windows(df))
        plain_max, _ = hot_rows_per_partition(plain_member_windows(df))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert hot_total == 2000
    assert plain_max == hot_total  # member-wide window: all in one task
    assert day_max < hot_total / 4


def test_hot_member_day_is_many_tasks(spark):
    rows = [(f"c{i:05d}", "hot", "2024-03-01", float(i % 7)) for i in range(4000)]
    rows += [(f"d{i:05d}", "hot" if i % 2 else f"m{i % 9}", f"2024-0{1 + i % 8}-1{i % 9}", 1.5) for i in range(500)]
    df = spark.createDataFrame(rows, "claim_id string, member_id string, d string, a double").select(
        "claim_id", "member_id", F.col("d").cast("date").alias("service_date"), F.col("a").cast("decimal(18,4)").alias("paid_amount")
    )
    cols = ["claim_id", "member_cumulative_paid", "prev_claim_date", "days_since_last_claim"]
    want = sorted(map(str, plain_member_windows(df).select(*cols).collect()))
    got = member_windows(df, bands=12)
    assert [r.split("member_cumulative_paid")[0] for r in want] == sorted(r.split("member_cumulative_paid")[0] for r in map(str, got.select(*cols).collect()))
    assert {(r[0], float(r[1]), r[2], r[3]) for r in got.select(*cols).collect()} == {(r[0], float(r[1]), r[2], r[3]) for r in plain_member_windows(df).select(*cols).collect()}


def test_readmissions_of_a_hot_bin_are_shared_out(spark, monkeypatch):
    from carelake.operators import readmission

    rows = [(f"c{i}", "hot" if i % 3 else "m", f"2024-01-{1 + i % 28:02d}", "IP", "PAID") for i in range(90)]
    df = spark.createDataFrame(rows, "claim_id string, member_id string, d string, claim_type string, claim_status string").withColumn("service_date", F.col("d").cast("date"))
    want = sorted(map(tuple, readmission.readmission_pairs(df).collect()))
    monkeypatch.setattr(readmission, "STAYS_PER_TASK", 7)
    assert sorted(map(tuple, readmission.readmission_pairs(df).collect())) == want and len(want) > 500
