"""Text tasks as Spark jobs: executive summary text, denial-note
classification and its trend, parsing classifier JSON, anomaly payloads and
anomaly explanations.

The classification is an ordered list of case-insensitive patterns evaluated
as one CASE expression (JVM-side, no Python). A caller with its own model can
pass ``scorer``: a pandas function applied batch-wise with ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.money import count_where
from carelake.functions.dates import month_label
from carelake.plans.analytics import executive_metrics

# fixed values: the category taxonomy
CATEGORIES = [
    "AUTHORIZATION_MISSING",
    "DUPLICATE_CLAIM",
    "ELIGIBILITY_ISSUE",
    "CODING_ERROR",
    "TIMELY_FILING",
    "MEDICAL_NECESSITY",
    "OTHER",
]

# ordered rules (first match wins) over the lower-cased note, with the
# confidence reported for a match; whole words only
NOTE_RULES = [
    ("DUPLICATE_CLAIM", r"\bduplicates?\b|\balready (been )?(paid|processed|submitted|adjudicated|billed)\b|\bbilled twice\b", 0.95),
    ("AUTHORIZATION_MISSING", r"\b(un|not |pre-?)?authori[sz](ed|ation)\b|\b(no|prior|missing|without) auth\b|\bauth (missing|required|not)\b|\bpre-?cert(ification)?\b|\breferral (missing|required|not)\b|\bno referral\b", 0.95),
    ("TIMELY_FILING", r"\b(timely )?filing (limit|window|deadline|period)\b|\btimely filing\b|\b(filed|submitted|received|submission) (too )?late\b|\blate (filing|submission)\b|\b(after|past|beyond|missed) the (filing )?(deadline|limit|window)\b", 0.95),
    ("ELIGIBILITY_ISSUE", r"\b(not|no longer) (enrolled|eligible|covered|active)\b|\bineligible\b|\beligibility\b|\bcoverage (had |has |was )?(ended|terminated|lapsed|inactive|expired)\b|\b(no|without) coverage\b|\bnot a (member|subscriber)\b", 0.9),
    ("MEDICAL_NECESSITY", r"\bmedical(ly)? (necess(ary|ity)|unnecessary)\b|\bnot (clinically )?(necessary|indicated)\b|\bexperimental\b", 0.9),
    ("CODING_ERROR", r"\b(procedure|diagnosis|billing|billed|revenue|cpt|icd(-10)?|hcpcs|invalid|wrong|incorrect|unbundled|mismatched) codes?\b|\bcoding\b|\bmodifiers?\b|\bcodes? (does|do|is|are|was|conflicts?|invalid|mismatch)\b|\b(match|matching|mismatch|invalid) (the )?diagnosis\b", 0.85),
]
OTHER_CONFIDENCE = 0.5
EMPTY_CONFIDENCE = 0.0

CLASSIFIED_SCHEMA = "category string, confidence double"


def classify_expr(note: Column) -> tuple[Column, Column]:
    """(category, confidence) columns for a note column."""
    text = F.lower(F.trim(note))
    blank = note.isNull() | (text == "")
    cat = F.when(blank, F.lit("OTHER"))
    conf = F.when(blank, F.lit(EMPTY_CONFIDENCE))
    for category, pattern, confidence in NOTE_RULES:
        hit = text.rlike(pattern)
        cat = cat.when(hit, category)
        conf = conf.when(hit, F.lit(confidence))
    return cat.otherwise("OTHER"), conf.otherwise(F.lit(OTHER_CONFIDENCE))


# T2 ---------------------------------------------------------------------------
def classify_denial_notes(
    notes: DataFrame,
    note_col: str = "note",
    scorer: Callable[[pd.Series], pd.DataFrame] | None = None,
) -> DataFrame:
    """Add ``category`` and ``confidence`` to every note row.

    ``scorer`` (optional) maps a pandas Series of notes to a DataFrame with
    columns category, confidence; it runs per Arrow batch in the executors.
    """
    if scorer is None:
        cat, conf = classify_expr(F.col(note_col))
        return notes.withColumn("category", cat).withColumn("confidence", conf)

    out_schema = T.StructType(
        notes.schema.fields
        + [T.StructField("category", T.StringType()), T.StructField("confidence", T.DoubleType())]
    )

    def score(batches):
        for pdf in batches:
            res = scorer(pdf[note_col])
            yield pdf.assign(
                category=res["category"].to_numpy(), confidence=res["confidence"].astype(float).to_numpy()
            )

    return notes.mapInPandas(score, out_schema)


# T3 ---------------------------------------------------------------------------
def denial_category_trend(classified: DataFrame) -> DataFrame:
    """Denials per service month and category."""
    return (
        classified.groupBy(month_label(F.col("service_date")).alias("service_month"), "category")
        .agg(F.count(F.lit(1)).alias("denials"))
        .orderBy("service_month", "category")
    )


# T4 ---------------------------------------------------------------------------
# every value as its own JSON text, so that its type can be checked
_ENTRY = "array<variant>"


def parse_classifications(responses: DataFrame, json_col: str = "response", id_col: str = "claim_id") -> DataFrame:
    """One row per classified note; a reply of another shape gives one error row.

    parse_status: 'ok' for entries, 'empty' for an empty array, 'malformed'
    when the text is not a JSON array, or one of its entries lacks a note text,
    a category of the taxonomy or a confidence number from 0 to 1; ``raw`` then
    holds the text.
    """
    reply = F.try_parse_json(F.col(json_col))
    kind = F.schema_of_variant(reply)
    listed = responses.withColumn("_v", F.when(kind.startswith("ARRAY"), reply)).withColumn(
        "_p", F.when(F.col("_v").isNotNull(), F.col("_v").cast(_ENTRY))
    )

    def good(e: Column) -> Column:
        field = lambda path, t: F.try_variant_get(e, path, t)
        number = F.schema_of_variant(field("$.confidence", "variant")).rlike("^(BIGINT|DOUBLE|DECIMAL)")
        text = lambda path: F.schema_of_variant(field(path, "variant")) == "STRING"
        shape = F.schema_of_variant(e).startswith("OBJECT")
        known = field("$.category", "string").isin(CATEGORIES)
        return F.coalesce(
            shape & text("$.note") & text("$.category") & known & number & field("$.confidence", "double").between(0, 1),
            F.lit(False),
        )

    bad = F.col("_p").isNull() | ~F.forall("_p", good)
    entries = F.transform(
        "_p",
        lambda e: F.struct(
            F.try_variant_get(e, "$.note", "string").alias("note"),
            F.try_variant_get(e, "$.category", "string").alias("category"),
            F.try_variant_get(e, "$.confidence", "double").alias("confidence"),
        ),
    )
    checked = listed.select(id_col, json_col, bad.alias("_bad"), "_p").withColumn(
        "_e", F.when(~F.col("_bad"), entries)
    )
    status = (
        F.when(F.col("_bad"), F.lit("malformed")).when(F.size("_e") == 0, F.lit("empty")).otherwise(F.lit("ok"))
    )
    return checked.select(
        id_col,
        status.alias("parse_status"),
        F.when(F.col("_bad"), F.col(json_col)).alias("raw"),
        F.inline_outer(F.col("_e")),
    )


# T5 ---------------------------------------------------------------------------
def anomaly_payload(claims: DataFrame) -> DataFrame:
    """Denied-with-payment rows as narrow JSON records (claim_id, paid_amount,
    claim_status); no rows when there are no anomalies."""
    rows = claims.filter((F.col("claim_status") == "DENIED") & (F.col("paid_amount") > 0))
    return rows.select(
        "claim_id",
        F.to_json(
            F.struct(
                "claim_id",
                F.col("paid_amount").cast("double").alias("paid_amount"),
                "claim_status",
            )
        ).alias("record"),
    )


# T6 ---------------------------------------------------------------------------
ANOMALY_CODE = "PAID_DENIED"

# anomaly code -> likely cause, remediation
ANOMALY_EXPLANATIONS = [
    (
        ANOMALY_CODE,
        "A denied claim still carries money: status and amount were set by different steps.",
        "Ask the payer which of the two is right, then correct the amount or the status.",
    ),
]


def explain_anomalies(claims: DataFrame) -> DataFrame:
    """Each anomaly with its cause and remedy from a small lookup table.

    The lookup holds one row per anomaly code (a fixed, tiny list), so it is
    broadcast.
    """
    spark = claims.sparkSession
    lookup = spark.createDataFrame(
        ANOMALY_EXPLANATIONS, "anomaly_code string, likely_cause string, remediation string"
    )
    anomalies = claims.filter(
        (F.col("claim_status") == "DENIED") & (F.col("paid_amount") > 0)
    ).select(
        "claim_id",
        "member_id",
        F.col("paid_amount").cast("double").alias("paid_amount"),
        F.lit(ANOMALY_CODE).alias("anomaly_code"),
    )
    return anomalies.join(F.broadcast(lookup), "anomaly_code", "left")


# T1 ---------------------------------------------------------------------------
DENIAL_ATTENTION_PCT = 10.0


def _money(c: str) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.col(c), 2))


def executive_summary_text(claims: DataFrame) -> DataFrame:
    """The executive metrics plus a plain-text briefing and attention flags."""
    anomalies = count_where((F.col("claim_status") == "DENIED") & (F.col("paid_amount") > 0))
    row = executive_metrics(claims, anomalies.alias("anomalies"))
    denial_flag = F.col("denial_rate_pct") > DENIAL_ATTENTION_PCT
    anomaly_flag = F.col("anomalies") > 0
    text = F.concat_ws(
        " ",
        F.concat(
            F.format_number(F.col("total_claims"), 0),
            F.lit(" claims processed: "),
            F.format_number(F.col("paid_claims"), 0),
            F.lit(" paid, "),
            F.format_number(F.col("denied_claims"), 0),
            F.lit(" denied ("),
            F.format_number(F.col("denial_rate_pct"), 2),
            F.lit("% denial rate)."),
        ),
        F.concat(F.lit("Paid "), _money("total_paid"), F.lit(" of "), _money("total_billed"), F.lit(" billed.")),
        F.concat(
            F.lit("Inpatient claims average "),
            F.coalesce(_money("inpatient_avg_paid"), F.lit("n/a")),
            F.lit("; behavioral health spend is "),
            F.coalesce(_money("behavioral_health_spend"), F.lit("$0.00")),
            F.lit("."),
        ),
        F.when(denial_flag, F.lit("Attention: denial rate is above 10%.")),
        F.when(
            anomaly_flag,
            F.concat(
                F.lit("Attention: "),
                F.format_number(F.col("anomalies"), 0),
                F.lit(" denied claims show a payment."),
            ),
        ),
    )
    return row.select(
        "*",
        denial_flag.alias("denial_attention"),
        anomaly_flag.alias("anomaly_attention"),
        text.alias("summary_text"),
    )


__all__ = [
    "CATEGORIES",
    "anomaly_payload",
    "classify_denial_notes",
    "denial_category_trend",
    "executive_summary_text",
    "explain_anomalies",
    "parse_classifications",
]
