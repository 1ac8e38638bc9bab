"""Hand-made claims: known answers for ingest, validation, derivations,
windows, readmissions and segments."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import quality as Q
from carelake.plans import analytics as A
from carelake.plans import segments as V
from carelake.plans.transform import transform
from carelake.sources.files import read_claims_csv, read_raw_csv


@pytest.fixture(scope="module")
def claims(spark, data_path):
    return read_claims_csv(spark, data_path("claims_fixture.csv")).cache()


@pytest.fixture(scope="module")
def defects(spark, data_path):
    return Q.check(read_raw_csv(spark, data_path("claims_defects.csv"))).cache()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_typed_scan(claims):
    types = dict(claims.dtypes)
    assert types["service_date"] == "date"
    assert types["billed_amount"] == "decimal(18,4)"
    assert claims.count() == 15


def test_kpis(claims):
    r = A.baseline_kpis(claims).first()
    assert (r.total_claims, r.paid_claims, r.denied_claims) == (15, 11, 2)
    assert r.denial_rate_pct == 13.33
    assert (r.total_billed, r.total_paid) == (35525.0, 24620.0)
    assert r.avg_payment_rate_pct == 69.30


def test_validation_rules(defects):
    errs = Q.validation_errors(defects)
    got = rows(errs, "claim_id", "error")
    expected = sorted(
        [
            ("D01", "Null in member_id"),
            ("D02", "Null in claim_type"),
            ("D02", "Unknown claim_type: nan"),
            ("D03", "Unknown claim_type: XX"),
            ("D04", "Unknown claim_type: ip"),
            ("D05", "Unknown claim_type: IP "),
            ("D06", "Unknown claim_status: OPEN"),
            ("D07", "Non-numeric billed_amount"),
            ("D08", "Non-numeric billed_amount"),
            ("D09", "Non-numeric billed_amount"),
            ("D10", "Non-numeric billed_amount"),
            ("D11", "Bad date in service_date: 2023-13-01"),
            ("D12", "Bad date in service_date: bad"),
            ("D13", "Null in state_code"),
            ("D14", "Null in billed_amount"),
            ("D14", "Non-numeric billed_amount"),
            ("D15", "Unknown claim_status: OPEN"),
            ("D15", "Non-numeric paid_amount"),
        ]
    )
    assert got == expected
    counts = Q.quality_counts(defects).first()
    assert (counts.rows_raw, counts.rows_valid, counts.rows_invalid, counts.error_count) == (18, 3, 15, 18)


def test_accepted_amounts(defects):
    valid = {r.claim_id: r for r in Q.valid_claims(defects).collect()}
    assert set(valid) == {"D16", "D17", "D18"}
    assert float(valid["D16"].billed_amount) == 12.0 and float(valid["D16"].paid_amount) == 1000.0
    assert float(valid["D17"].billed_amount) == 12.345
    assert float(valid["D17"].paid_amount) == 99999999999.0


def test_header_checks(spark, tmp_path):
    missing = tmp_path / "missing.csv"
    missing.write_text("claim_id,member_id\nA,B\n")
    with pytest.raises(Q.SchemaError):
        read_raw_csv(spark, str(missing))
    swapped = tmp_path / "swapped.csv"
    cols = ["member_id", "claim_id", "state_code", "service_date", "claim_type",
            "billed_amount", "paid_amount", "claim_status"]
    swapped.write_text(",".join(cols) + "\nM9,C9,OH,2023-01-01,IP,10.00,5.00,PAID\n")
    r = read_raw_csv(spark, str(swapped)).first()
    assert (r.claim_id, r.member_id) == ("C9", "M9")


def test_derived_and_windows(claims):
    cur = {r.claim_id: r for r in transform(claims).collect()}
    assert cur["C13"].payment_rate == 0.0 and cur["C14"].payment_rate == 0.0
    assert cur["C01"].payment_rate == 0.8
    assert cur["C12"].is_behavioral is False
    assert cur["C10"].anomaly_paid_denied is True
    assert cur["C07"].anomaly_paid_denied is False
    assert (cur["C01"].service_year, cur["C01"].service_month, cur["C01"].service_quarter) == (2023, 3, 1)
    cum = {k: float(v.member_cumulative_paid) for k, v in cur.items()}
    assert [cum[c] for c in ("C01", "C02", "C03", "C04")] == [8000, 12000, 14500, 16000]
    # same-day ties ordered by claim_id
    assert [cum[c] for c in ("C05", "C06", "C07", "C08")] == [3000, 6000, 6000, 6150]
    gaps = {k: v.days_since_last_claim for k, v in cur.items()}
    assert [gaps[c] for c in ("C01", "C02", "C03", "C04")] == [None, 1, 29, 1]
    assert [gaps[c] for c in ("C05", "C06", "C07", "C08")] == [None, 0, 15, 1]


def test_readmission_edges(claims):
    got = rows(A.readmission_pairs(claims), "first_admit", "readmit_claim", "days_between")
    assert got == [
        ("C01", "C02", 1),
        ("C01", "C03", 30),
        ("C02", "C03", 29),
        ("C02", "C04", 30),
        ("C03", "C04", 1),
    ]


def test_segments(claims):
    top = V.top_share(claims).first()
    assert (top.members, top.top_members, top.top_pct) == (5, 1, 65.2529)
    seg = {r.segment: r for r in V.cost_segments(claims).collect()}
    assert (seg["High-Cost"].members, seg["High-Cost"].claims, seg["High-Cost"].total_paid) == (3, 9, 24360.0)
    assert seg["High-Cost"].avg_paid == 2706.67
    assert (seg["Low-Cost"].members, seg["Low-Cost"].claims, seg["Low-Cost"].avg_paid) == (2, 2, 80.0)
    curve = rows(V.pareto_curve(claims), "spend_rank", "member_id", "member_pct", "cum_pct", "is_top")
    assert curve[0] == (1, "M1", 0.0, 65.2529, True)
    assert curve[-1] == (5, "M4", 100.0, 100.0, False)


def test_anomalies(claims):
    assert rows(A.denied_with_payment(claims), "claim_id") == [("C10",)]
    assert A.high_cost_members(claims, threshold=5000).count() == 2
    assert rows(A.repeat_inpatient_members(claims), "member_id", "inpatient_stays") == [("M1", 4), ("M2", 2)]


def test_one_member(spark):
    one = spark.createDataFrame(
        [("X1", "M", "PAID", "OP", 10.0)], "claim_id string, member_id string, claim_status string, claim_type string, paid_amount double"
    ).withColumn("paid_amount", F.col("paid_amount").cast("decimal(18,4)"))
    r = V.pareto_curve(one).first()
    assert (r.spend_rank, r.member_pct, r.cum_pct) == (1, 0.0, 100.0)
    assert V.top_share(one).first().top_members == 1
