"""Claims built from the driver's TPC-H-style tables.

One claim per ``lineitem`` row. Dimensions are LEFT joined on their primary
keys, so every line item stays exactly one claim; a missing dimension row
leaves its attributes null. Because each dimension key is unique, a join whose
columns are not requested cannot change the row set, and ``claims`` skips it:
a KPI over status and amounts reads ``lineitem`` alone, while state and plan
need orders -> customer -> nation.

Dimension pre-joins (customer with nation, then orders with customer) run on
order-sized data, so the fact table is shuffled at most twice: once by
order key and once by part key.

Mapping (claims field <- source):
    claim_id        l_orderkey-l_partkey-l_suppkey-l_linenumber
    member_id       o_custkey
    state_code      n_name of the customer's nation
    plan_id         c_mktsegment
    service_date    l_shipdate as DATE
    claim_type      p_type LARGE* -> IP, PROMO* -> LTC, SMALL* -> RX, else OP
    diagnosis_code  p_brand
    procedure_code  p_type
    billed_amount   l_extendedprice as DECIMAL(12,2), widened to DECIMAL(18,4)
    claim_status    returnflag A, or N with linestatus F -> PAID; N/O -> PENDING;
                    R/O -> DENIED; R/F -> VOID
    paid_amount     PAID: billed * (1 - discount) to cents; DENIED with
                    l_tax >= 0.07: 100 (denied-with-payment anomalies); else 0
    provider_id     l_suppkey
    provider_type   o_orderpriority 1 -> HOSPITAL, 3 -> BEHAVIORAL,
                    4 -> NURSING, 2 and 5 -> PHYSICIAN
    managed_care_flag  'Y'
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.schema import MONEY, RAW_FIELDS

ORDER_FIELDS = {"member_id", "state_code", "plan_id", "provider_type"}
CUSTOMER_FIELDS = {"state_code", "plan_id"}
PART_FIELDS = {"claim_type", "diagnosis_code", "procedure_code"}

# fixed values: part type prefix -> claim type, order priority digit -> provider
CLAIM_TYPE_BY_PART_PREFIX = [("LARGE", "IP"), ("PROMO", "LTC"), ("SMALL", "RX")]
PROVIDER_BY_PRIORITY = [
    ("1", "HOSPITAL"),
    ("2", "PHYSICIAN"),
    ("3", "BEHAVIORAL"),
    ("4", "NURSING"),
    ("5", "PHYSICIAN"),
]
ANOMALY_TAX_FLOOR = 0.07
ANOMALY_PAID = 100


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((rf == "A") | ((rf == "N") & (ls == "F")), "PAID")
        .when((rf == "N") & (ls == "O"), "PENDING")
        .when((rf == "R") & (ls == "O"), "DENIED")
        .when((rf == "R") & (ls == "F"), "VOID")
    )


def _billed_cents() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _paid() -> Column:
    status = _status()
    net = (_billed_cents() * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(
        "decimal(12,2)"
    )
    return (
        F.when(status == "PAID", net)
        .when((status == "DENIED") & (F.col("l_tax") >= ANOMALY_TAX_FLOOR), F.lit(ANOMALY_PAID))
        .when(status.isNotNull(), F.lit(0))
        .cast(MONEY)
    )


def _claim_type() -> Column:
    p = F.col("p_type")
    expr = F.when(p.isNull(), F.lit(None).cast("string"))
    for prefix, code in CLAIM_TYPE_BY_PART_PREFIX:
        expr = expr.when(p.startswith(prefix), code)
    return expr.otherwise("OP")


def _provider_type() -> Column:
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    expr = None
    for d, label in PROVIDER_BY_PRIORITY:
        expr = F.when(digit == d, label) if expr is None else expr.when(digit == d, label)
    return expr


def _field_exprs() -> dict[str, Column]:
    return {
        "claim_id": F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.col("l_linenumber").cast("string"),
        ),
        "member_id": F.col("o_custkey").cast("string"),
        "state_code": F.col("n_name"),
        "plan_id": F.col("c_mktsegment"),
        "service_date": F.col("l_shipdate").cast("date"),
        "claim_type": _claim_type(),
        "diagnosis_code": F.col("p_brand"),
        "procedure_code": F.col("p_type"),
        "billed_amount": _billed_cents().cast(MONEY),
        "paid_amount": _paid(),
        "claim_status": _status(),
        "provider_id": F.col("l_suppkey").cast("string"),
        "provider_type": _provider_type(),
        "managed_care_flag": F.lit("Y"),
    }


def _joined(spark: SparkSession, sf_dir: str, fields: set[str]) -> DataFrame:
    df = read_table(spark, sf_dir, "lineitem")
    if fields & ORDER_FIELDS:
        orders = read_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority"
        )
        if fields & CUSTOMER_FIELDS:
            cust = read_table(spark, sf_dir, "customer").select(
                "c_custkey", "c_nationkey", "c_mktsegment"
            )
            if "state_code" in fields:
                # its size decides whether the planner broadcasts it
                nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
                cust = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            orders = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    if fields & PART_FIELDS:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    return df


def claims(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Typed claims over the driver tables, restricted to ``columns``."""
    cols = list(columns) if columns is not None else list(RAW_FIELDS)
    unknown = [c for c in cols if c not in RAW_FIELDS]
    if unknown:
        raise ValueError(f"not claim fields: {unknown}")
    exprs = _field_exprs()
    return _joined(spark, sf_dir, set(cols)).select(*[exprs[c].alias(c) for c in cols])


# ---------------------------------------------------------------------------
# Raw (all-text) claims with deterministic defects, for the validation layer.
# ---------------------------------------------------------------------------

DEFECT_MODULUS = 97


def defect_slot() -> Column:
    """Which defect a line item carries: (orderkey * 31 + linenumber) mod 97."""
    return F.pmod(
        F.col("source_orderkey") * 31 + F.col("source_linenumber"), F.lit(DEFECT_MODULUS)
    )


# fixed values: defect slot -> (field, replacement text); None means null.
# Slots 7 and 10 carry two defects in one row.
DEFECTS = [
    (0, "claim_type", "XX"),
    (1, "claim_status", "OPEN"),
    (2, "billed_amount", "N/A"),
    (3, "paid_amount", "x12"),
    (4, "service_date", "2024-13-01"),
    (5, "member_id", None),
    (6, "claim_type", None),
    (7, "claim_status", "OPEN"),
    (7, "billed_amount", "abc"),
    (8, "claim_type", "ip"),
    (9, "paid_amount", ""),
    (10, "state_code", "NA"),
    (10, "service_date", "bad"),
]


def claims_with_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All claim fields plus the source line item key (orderkey, linenumber)."""
    exprs = _field_exprs()
    return _joined(spark, sf_dir, set(RAW_FIELDS)).select(
        *[exprs[c].alias(c) for c in RAW_FIELDS],
        F.col("l_orderkey").alias("source_orderkey"),
        F.col("l_linenumber").alias("source_linenumber"),
    )


def raw_from_typed(typed: DataFrame) -> DataFrame:
    """All-text claims as a landing file would hold them, with seeded defects.

    Every field is text: dates as yyyy-MM-dd, amounts with two decimals. A
    small, fixed share of rows (slots 0-10 of 97) is spoiled so that every
    validation rule fires; the rest are clean. Needs the provenance columns.
    """
    text = {
        f: (
            F.date_format(F.col(f), "yyyy-MM-dd")
            if f == "service_date"
            else F.col(f).cast("decimal(12,2)").cast("string")
            if f in ("billed_amount", "paid_amount")
            else F.col(f).cast("string")
        )
        for f in RAW_FIELDS
    }
    slot = defect_slot()
    for s, field, value in DEFECTS:
        text[field] = F.when(slot == s, F.lit(value).cast("string")).otherwise(text[field])
    return typed.select(*[text[f].alias(f) for f in RAW_FIELDS])


# ---------------------------------------------------------------------------
# Denial notes: free text attached to DENIED claims, picked by line number.
# ---------------------------------------------------------------------------

# note texts, picked by order and line number
DENIAL_NOTE_TEXTS = [
    "No prior authorization on file for this stay",
    "Same claim was already processed",
    "Patient not covered on the date of care",
    "Billed code conflicts with the diagnosis",
    "Claim was filed after the deadline",
    "Records do not support medical necessity",
    "Barcode unreadable, please send again",
    "Precert required before the visit",
    "Looks like a duplicate of an earlier bill",
    "Member ineligible that month",
    "Modifier missing on line two",
    "Received past the timely filing window",
    "Treatment judged not medically necessary",
    "Zip code of the provider is missing",
    "Authorization missing for the second unit",
    "Visit already paid last month",
    "Coverage had lapsed by then",
    "CPT codes unbundled",
    "Submitted too late",
    "Not clinically indicated",
    "Reconsideration of units asked for",
    "Stay was not authorised by the plan",
    "Line already submitted under another number",
    "No longer enrolled with this plan",
    "Wrong code for the procedure room",
    "Late submission by the clinic",
    "Experimental therapy",
    "Signature illegible",
    "Unauthorized out of network visit",
    "Duplicates found on this account",
    "Eligibility could not be shown",
    "Coding review failed",
    "Sent beyond the filing limit",
    "Medically unnecessary scan",
    "Please call the provider desk",
    "Auth not obtained in time",
    "Encounter was billed twice",
    "Coverage terminated in spring",
    "Invalid diagnosis pointer",
    "Missed the deadline by ten days",
    "Test not necessary at this stage",
    "Attachment page three is blank",
    "Referral missing from the packet",
    "Already been adjudicated in May",
    "Person is not a member here",
    "Revenue code absent",
    "Filed late without a reason",
    "Medical necessity not shown",
    "Bank details changed",
    "No referral from the family doctor",
    "Already billed by the partner clinic",
    "Patient without coverage",
    "Codes do not fit together",
    "Filing period over",
    "Not indicated for this condition",
    "Provider moved to a new address",
    "Pre-certification number absent",
    "Possible duplicate line item",
    "Coverage was inactive",
    "Mismatch diagnosis and service",
    "Received late in the year",
    "Considered experimental by the panel",
    "Unit count under review",
]


def notes_from_typed(typed: DataFrame) -> DataFrame:
    """claim_id, service_date, note for every DENIED claim (needs provenance)."""
    texts = F.array(*[F.lit(t) for t in DENIAL_NOTE_TEXTS])
    at = F.pmod(F.col("source_orderkey") * 7 + F.col("source_linenumber"), F.lit(len(DENIAL_NOTE_TEXTS)))
    note = F.element_at(texts, at.cast("int") + 1)
    return typed.filter(F.col("claim_status") == "DENIED").select(
        "claim_id", "service_date", note.alias("note")
    )
