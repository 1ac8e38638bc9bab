"""Clustered layout: same rows, and fewer of them read, as the scan's own metric says."""

import pytest
from pyspark.sql import functions as F

from carelake.plans.analytics import high_cost_members
from carelake.schema import RAW_FIELDS
from carelake.sources import clustered as C
from carelake.sources.layer import claims_layer


@pytest.fixture(scope="module")
def claims(spark, small_dir):
    base = claims_layer(spark, small_dir).select(*RAW_FIELDS)
    hot = F.when(F.pmod(F.xxhash64("claim_id"), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("member_id"))
    return base.withColumn("member_id", hot).cache()  # one member holds a third of all claims


@pytest.fixture(scope="module")
def layouts(spark, claims, tmp_path_factory):
    root = tmp_path_factory.mktemp("clustered")
    C.write_clustered(claims, f"{root}/z", rows_per_file=200)
    C.write_clustered(claims, f"{root}/no_bloom", rows_per_file=200, bloom=False)
    files = -(-claims.count() // 200)
    claims.repartitionByRange(files, "claim_id").sortWithinPartitions("claim_id").write.parquet(f"{root}/plain")
    return {n: C.read_clustered(spark, f"{root}/{n}") for n in ("z", "no_bloom", "plain")}


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def rows_read(df):
    """Rows that the scan of a plan without a shuffle gives after row groups are left out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_same_rows_and_hot_member_in_many_files(claims, layouts):
    assert rows_of(layouts["z"].select(*RAW_FIELDS)) == rows_of(claims)
    files = layouts["z"].where("member_id = 'HOT'").select(F.input_file_name()).distinct().count()
    sizes = [r["count"] for r in layouts["z"].groupBy(F.input_file_name()).count().collect()]
    assert files >= 5 and max(sizes) <= 800
    assert rows_of(high_cost_members(layouts["z"], limit=None)) == rows_of(high_cost_members(claims, limit=None))


def test_filters_on_any_of_the_columns_read_less(claims, layouts):
    total = claims.count()
    state, member = claims.where("member_id <> 'HOT'").select("state_code", "member_id").orderBy("claim_id").first()
    for where, share in ((f"state_code = '{state}'", 0.5), ("service_date between date'1996-01-01' and date'1996-06-30'", 0.5), (f"member_id = '{member}'", 0.7), (f"state_code = '{state}' and service_date < date'1996-01-01'", 0.3)):
        few, all_ = rows_read(layouts["z"].where(where)), rows_read(layouts["plain"].where(where))
        print(where, "rows read", few, "of", total, "in order of ids", all_)
        assert few <= share * total and few < all_
        assert rows_of(layouts["z"].where(where).select(*RAW_FIELDS)) == rows_of(claims.where(where))


def test_claims_are_found_by_bloom_filters(claims, layouts):
    ids = [r[0] for r in claims.select("claim_id").orderBy(F.md5("claim_id")).limit(25).collect()]
    one = C.claims_of_ids(layouts["z"], ids[:1])
    with_bloom, without = rows_read(one), rows_read(C.claims_of_ids(layouts["no_bloom"], ids[:1]))
    print("one claim: rows read", with_bloom, "without Bloom filters", without)
    assert 1 <= with_bloom < without / 2
    many = rows_read(C.claims_of_ids(layouts["z"], ids))  # three INs
    assert many < rows_read(C.claims_of_ids(layouts["no_bloom"], ids))
    assert rows_of(C.claims_of_ids(layouts["z"], [*ids, ids[0], None, "absent"]).select(*RAW_FIELDS)) == rows_of(claims.where(F.col("claim_id").isin(ids)))
    assert C.claims_of_ids(layouts["z"], []).count() == 0 and C.claims_of_ids(layouts["z"], ["absent"]).count() == 0


def test_very_many_ids_are_joined(claims, layouts, monkeypatch):
    monkeypatch.setattr(C, "MOST_IDS", 10)
    ids = claims.where(F.pmod(F.xxhash64("claim_id"), F.lit(7)) == 0).select("claim_id")
    want = rows_of(claims.join(ids.distinct(), "claim_id", "left_semi").select(*RAW_FIELDS))
    assert rows_of(C.claims_of_ids(layouts["z"], ids.unionByName(ids)).select(*RAW_FIELDS)) == want
    assert rows_of(C.claims_of_ids(layouts["z"], [r[0] for r in ids.collect()]).select(*RAW_FIELDS)) == want


def test_nulls_repeats_and_empty_tables(spark, claims, tmp_path):
    odd = claims.limit(50).withColumn("state_code", F.lit(None).cast("string")).unionByName(claims.limit(50)).unionByName(claims.limit(50))
    odd = odd.withColumn("member_id", F.when(F.rand(1) < 0.5, F.col("member_id"))).withColumn("extra", F.lit(1)).cache()
    C.write_clustered(odd, str(tmp_path / "odd"), rows_per_file=20)
    assert rows_of(C.read_clustered(spark, str(tmp_path / "odd")).select(*odd.columns)) == rows_of(odd)
    C.write_clustered(odd.limit(0), str(tmp_path / "none"))
    assert C.read_clustered(spark, str(tmp_path / "none")).count() == 0


def test_places_follow_all_three_columns(spark):
    cuts = {"a": [10, 20, 30], "b": [1], "c": []}
    df = spark.createDataFrame([(None, None, 1), (9, 0, 1), (10, 0, 1), (30, 1, 1), (99, 5, None)], "a int, b int, c int")
    got = [r[0] for r in df.select(C.curve_place(cuts, bits=2)).collect()]
    # a: bits 5 and 2; b, of two ranges, as 0 and 2: bit 4
    assert got == [0, 0, 0b000100, 0b110100, 0b110100]
