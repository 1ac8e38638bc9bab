"""Claims data model: field lists, types and the fixed code lists.

Everything under a "fixed values" banner must stay exactly as written: the
analytics and the validation rules compare against these literals.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

# ---------------------------------------------------------------------------
# fixed values: the raw claim layout, in file order
# ---------------------------------------------------------------------------
RAW_FIELDS = [
    "claim_id",
    "member_id",
    "state_code",
    "plan_id",
    "service_date",
    "claim_type",
    "diagnosis_code",
    "procedure_code",
    "billed_amount",
    "paid_amount",
    "claim_status",
    "provider_id",
    "provider_type",
    "managed_care_flag",
]

# fixed values: required fields, checked for nulls in this order
REQUIRED_FIELDS = [
    "claim_id",
    "member_id",
    "state_code",
    "service_date",
    "claim_type",
    "billed_amount",
    "paid_amount",
    "claim_status",
]

# fixed values: code lists
CLAIM_TYPES = ["IP", "OP", "LTC", "RX"]
CLAIM_STATUSES = ["PAID", "DENIED", "PENDING", "VOID"]
AMOUNT_FIELDS = ["billed_amount", "paid_amount"]

# fixed values: text read as missing when raw files are loaded (the default
# missing-value tokens of the pandas CSV reader, plus the empty string)
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

DATE_FORMAT = "yyyy-MM-dd"

# fixed values: synthetic age bands with cumulative cut points out of 100
# (probabilities 0.15, 0.25, 0.35, 0.25) and the seed mixed into the hash
AGE_BANDS = ["18–34", "35–49", "50–64", "65+"]
AGE_BAND_CUTS = [15, 40, 75, 100]
AGE_BAND_SEED = "42"

# fixed values: segment labels
SEGMENT_HIGH = "High-Cost"
SEGMENT_LOW = "Low-Cost"

# fixed values: anomaly label of the denied-with-payment query
ANOMALY_LABEL = "denied but paid_amount > 0"


# the text of a row whose number of fields is wrong
CORRUPT = "_corrupt_record"
# what a line of a landing file is, and where it was read
LINE_KIND = "line_kind"
PLACE_FIELDS = ["source_file", "source_split", "source_row"]

# fixed values: derived fields of the curated table
DERIVED_FIELDS = [
    "service_year",
    "service_month",
    "service_quarter",
    "payment_rate",
    "is_inpatient",
    "is_denied",
    "is_behavioral",
    "anomaly_paid_denied",
]
WINDOW_FIELDS = ["member_cumulative_paid", "days_since_last_claim"]

# the one wide curated table: 14 raw + 8 derived + 2 window columns
CURATED_FIELDS = RAW_FIELDS + DERIVED_FIELDS + WINDOW_FIELDS

# fixed values: the PAID-only, state-partitioned projection written by the curated sink
CURATED_PAID_FIELDS = [
    "claim_id",
    "member_id",
    "state_code",
    "plan_id",
    "service_date",
    "service_year",
    "service_month",
    "service_quarter",
    "claim_type",
    "diagnosis_code",
    "provider_type",
    "billed_amount",
    "paid_amount",
    "payment_rate",
    "claim_status",
    "is_inpatient",
    "is_denied",
    "is_behavioral",
    "anomaly_paid_denied",
    "member_cumulative_paid",
    "days_since_last_claim",
]

_CURATED_TYPES = {
    "service_date": T.DateType(),
    "billed_amount": MONEY,
    "paid_amount": MONEY,
    "service_year": T.IntegerType(),
    "service_month": T.IntegerType(),
    "service_quarter": T.IntegerType(),
    "payment_rate": T.DoubleType(),
    "is_inpatient": T.BooleanType(),
    "is_denied": T.BooleanType(),
    "is_behavioral": T.BooleanType(),
    "anomaly_paid_denied": T.BooleanType(),
    "member_cumulative_paid": T.DecimalType(28, 4),
    "days_since_last_claim": T.IntegerType(),
}


def partition_schema(fields=None) -> T.StructType:
    """Types of the curated layout, for reading written tables back."""
    return T.StructType([T.StructField(f, _CURATED_TYPES.get(f, T.StringType())) for f in fields or CURATED_FIELDS])
