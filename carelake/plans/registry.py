"""Named queries over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators import quality as Q
from carelake.operators.distinct import estimate_members, member_sketches, standard_error
from carelake.plans import analytics as A
from carelake.plans import etl as E
from carelake.plans import notes as N
from carelake.plans import segments as V
from carelake.plans.history import append_load, read_history
from carelake.plans.note_model import classify_by_model, rule_labels, train_note_model
from carelake.plans.rollup import REPORTS, append_rollup, read_rollup
from carelake.functions.hashing import md5_bucket
from carelake.plans.transform import curated_paid, derive, transform
from carelake.schema import CORRUPT, RAW_FIELDS
from carelake.session import written
from carelake.sources import published
from carelake.sources.files import number_lines, read_claims_csv, read_layout, read_raw_csv, read_raw_lines, register, run_sql
from carelake.sources.claims_table import buckets_for, create_claims_table, load_claims_table as claims_table_load, table_claims_of_members, table_member_windows, table_readmissions
from carelake.sources.clustered import claims_of_ids, members_of_states, read_clustered, write_clustered
from carelake.sources.layer import claims_layer, committed, layer_claims as claims, layer_path, lines_feed, mixed_feed, raw_feed
from carelake.sources.sinks import remove
from carelake.sources.sql_functions import create_report_functions
from carelake.sources.tables import notes_from_typed

Query = Callable[[SparkSession, str], DataFrame]


def _over_claims(fn: Callable[[DataFrame], DataFrame], fields=None, **kw) -> Query:
    cols = fields if fields is not None else fn.fields

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(claims(spark, sf_dir, cols), **kw)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _dimension(dim: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.spend_by_dimension(claims(spark, sf_dir, [dim, "paid_amount"]), dim)

    return run


# keeps some members only: the default threshold keeps all of these tables
SELECTIVE_THRESHOLD = 2_500_000


def analytics_queries() -> dict[str, Query]:
    return {
        "q1_baseline_kpis": _over_claims(A.baseline_kpis),
        "q2_monthly_spend_trend": _over_claims(A.monthly_spend_trend),
        "q3_spend_by_state_plan": _over_claims(A.spend_by_state_plan),
        "q4_high_cost_members": _over_claims(A.high_cost_members),
        "q4_high_cost_members_all": _over_claims(A.high_cost_members, limit=None),
        "q4_high_cost_members_selective": _over_claims(A.high_cost_members, threshold=SELECTIVE_THRESHOLD, limit=None),
        "q5_behavioral_utilization": _over_claims(A.behavioral_utilization),
        "q5b_behavioral_by_state": _over_claims(A.behavioral_by_state),
        "q5c_behavioral_share_of_state": _over_claims(A.behavioral_share_of_state),
        "q6_denial_rate_by_provider": _over_claims(A.denial_rate_by_provider),
        "q7_top_diagnoses_by_spend": _over_claims(A.top_diagnoses_by_spend),
        "q8_denied_with_payment": _over_claims(A.denied_with_payment),
        "q9_readmission_pairs": _over_claims(A.readmission_pairs),
        "q10_repeat_inpatient_members": _over_claims(A.repeat_inpatient_members),
        "q11_behavioral_spend_by_state": _over_claims(A.behavioral_spend_by_state),
        "q14_executive_metrics": _over_claims(A.executive_metrics),
        "q15_spend_by_claim_type": _dimension("claim_type"),
        "q15_spend_by_state": _dimension("state_code"),
        "q15_spend_by_provider": _dimension("provider_type"),
        "q16_top_diagnoses_by_count": _over_claims(A.top_diagnoses_by_count),
    }


def report_types(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, for reports compared across engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw landing feed, read back through the all-text CSV ingest."""
    return read_raw_csv(spark, raw_feed(spark, sf_dir))


def mixed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder with two column orders, quoted names, short and long
    rows: every row with the fields it is bound to and whether it is malformed."""
    root = mixed_feed(spark, sf_dir)
    raw = read_raw_csv(spark, [f"{root}/{p}" for p in ("plain", "turned", "odd")])
    return raw.select(
        "claim_id", "member_id", "state_code", "paid_amount", "managed_care_flag",
        F.col(CORRUPT).isNotNull().alias("malformed"),
    )


def sql_paid_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed CSV scan registered as a table and queried with a named parameter."""
    register(read_claims_csv(spark, raw_feed(spark, sf_dir)), "landing_claims")
    return run_sql(
        spark,
        "SELECT state_code, count(*) AS n_claims, CAST(sum(paid_amount) AS DOUBLE) AS paid"
        " FROM landing_claims WHERE claim_status = :s GROUP BY state_code",
        {"s": "PAID"},
    )


# one run of the whole load per input: its outputs are checked by the e4_run_* queries
RUN_TIME = "2024-01-01T00:00:00"


def etl_run(spark: SparkSession, sf_dir: str) -> str:
    """Output folder of ``run_etl`` over the raw feed (loaded on first use)."""
    feed = raw_feed(spark, sf_dir)
    out = f"{layer_path(spark, sf_dir)}_run"
    if published.latest(spark, out) is None:
        E.run_etl(spark, read_raw_lines(spark, feed), out, RUN_TIME)
    return out


def _of_run(table: str) -> Query:
    return lambda s, d: published.read_published(s, etl_run(s, d), table)


def run_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's load summary, with the time of the run, from its JSON record."""
    path = published.table_path(spark, etl_run(spark, sf_dir), "load_summary")
    schema = E.load_summary(Q.check(spark.createDataFrame([], T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])))).schema
    return spark.read.schema(T.StructType([T.StructField("run_timestamp", T.StringType()), *schema.fields])).json(path)


def error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failed check with the file and the line of its row."""
    checked = written(Q.check(read_raw_lines(spark, lines_feed(spark, sf_dir))), "checked", Q.INVALID)
    found = number_lines(Q.validation_errors(checked), checked)
    part = F.regexp_extract("source_file", r"part=(\d+)/", 1).cast("long")
    return found.select("claim_id", "rule", "field", part.alias("part"), "source_line")


def _summary_rows(spark: SparkSession, path: str) -> DataFrame:
    """The run's summary record as (metric, key, value) rows."""
    maps = [*E.SUMMARY_MAP_METRICS, "top_diagnoses"]
    fields = [f"{m} map<string,double>" for m in maps] + [f"{m} double" for m in E.SCALAR_METRICS]
    record = spark.read.schema("run_timestamp string, " + ", ".join(fields)).json(path)
    rows = [
        F.map_entries(m) if m in maps else F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col(m).alias("value")))
        for m in [*maps, *E.SCALAR_METRICS]
    ]

    def named(metric: str, entries: Column) -> Column:
        return F.transform(entries, lambda x: F.struct(F.lit(metric).alias("metric"), x["key"].alias("key"), x["value"].alias("value")))

    return record.select(F.inline(F.concat(*[named(m, r) for m, r in zip([*maps, *E.SCALAR_METRICS], rows)])))


def denial_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes_from_typed(claims_layer(spark, sf_dir))


def run_queries() -> dict[str, Query]:
    return {
        "e1_mixed_landing": mixed_landing,
        "s5_sql_paid_by_state": sql_paid_by_state,
        "e4_run_curated": lambda s, d: report_types(_of_run("curated_claims")(s, d)),
        "e4_run_paid_by_state": lambda s, d: report_types(_of_run("curated_paid_by_state")(s, d)),
        "e4_run_errors": lambda s, d: _of_run("validation_errors")(s, d).select("claim_id", "rule", "field", "bad_value", "error"),
        "e4_run_summary": lambda s, d: _summary_rows(s, published.table_path(s, etl_run(s, d), "analytics_summary")),
        "e4_run_summary_rows": _of_run("summary_rows"),
        "e4_run_load_summary": run_load_summary,
        "f19_error_lines": error_lines,
    }


def claims_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of the bucketed claims table over the layer (loaded on first use)."""
    base = layer_path(spark, sf_dir)
    name, location = f"claims_{base.rsplit('/', 1)[1]}", f"{base}_table"
    rows = claims(spark, sf_dir)
    buckets = buckets_for(rows.count())  # from the layer's footers
    if not committed(spark, f"{location}/hot"):
        claims_table_load(spark, rows, name, location, buckets)
    create_claims_table(spark, name, location, buckets)
    return name


def rollup_of_loads(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the rollup, built from two loads of the claims layer (on first use)."""
    root = f"{layer_path(spark, sf_dir)}_rollup"
    rows, bucket = claims(spark, sf_dir), md5_bucket(F.col("claim_id"), "load")
    manifest = published.latest(spark, root)
    for part in [bucket < 60, bucket >= 60][len(manifest["facts"]["parts"]) if manifest else 0 :]:
        append_rollup(spark, root, rows.filter(part))
    return root


def _from_rollup(report: Callable) -> Query:
    return lambda s, d: report(*read_rollup(s, rollup_of_loads(s, d)))


def rollup_queries() -> dict[str, Query]:
    return {f"r_{name}": _from_rollup(report) for name, report in REPORTS.items()}


def clustered_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims layer in the clustered layout (written on first use)."""
    path = f"{layer_path(spark, sf_dir)}_clustered"
    if not committed(spark, path):
        write_clustered(claims(spark, sf_dir), path)
    return read_clustered(spark, path)


ASKED_STATES = ["NATION_3", "NATION_11", "NATION_17"]
#: Which claims the lookup asks for: some of every 10,000, by two hashes of their id.
LOOKUP_BUCKET = 5


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of the claims of a table of ids."""
    rows = clustered_claims(spark, sf_dir)
    ids = claims(spark, sf_dir, ["claim_id"]).filter((md5_bucket(F.col("claim_id"), "ask") < LOOKUP_BUCKET) & (md5_bucket(F.col("claim_id"), "once") < LOOKUP_BUCKET))
    return claims_of_ids(rows, ids).select("claim_id", "member_id", "state_code", "service_date", F.col("paid_amount").cast("double").alias("paid_amount"))


def sketched_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members per state and plan from monthly sketches of two loads, merged: whether the estimate is within five
    standard errors of the exact count beside it."""
    rows = claims(spark, sf_dir, ["claim_id", "member_id", "state_code", "plan_id", "service_date", "claim_status"])
    bucket = md5_bucket(F.col("claim_id"), "load")
    parts = written(member_sketches(rows.filter(bucket < 60)).unionByName(member_sketches(rows.filter(bucket >= 60))), "sketches")
    keys = ["state_code", "plan_id"]
    exact = rows.filter("claim_status = 'PAID'").groupBy(*keys).agg(F.count_distinct("member_id").alias("exact_members"))
    near = F.abs(F.col("unique_members") - F.col("exact_members")) <= 5 * standard_error() * F.col("exact_members")
    return estimate_members(parts, keys).join(exact, keys).select(*keys, "exact_members", near.alias("within_bound"))


def _by_sql(text: str) -> Query:
    """A report called from SQL text, over the claims layer as a view."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = f"claims_{layer_path(spark, sf_dir).rsplit('/', 1)[1]}_view"
        register(claims(spark, sf_dir), view)
        create_report_functions(spark, view)
        return run_sql(spark, text)

    return run


def sql_function_queries() -> dict[str, Query]:
    return {
        "s5_sql_high_cost_members": _by_sql("SELECT * FROM high_cost_members() ORDER BY total_paid DESC, member_id, state_code"),
        "s5_sql_high_cost_members_selective": _by_sql(f"SELECT * FROM all_high_cost_members(threshold => {SELECTIVE_THRESHOLD})"),
        "s5_sql_readmission_pairs": _by_sql("SELECT * FROM readmission_pairs(days => 30)"),
        "s5_sql_spend_by_state_plan": _by_sql("SELECT * FROM spend_by_state_plan() ORDER BY total_paid DESC"),
        "s5_sql_top_diagnoses": _by_sql("SELECT * FROM top_diagnoses_by_spend(top => 15)"),
        "s5_sql_denial_rate_by_provider": _by_sql("SELECT * FROM denial_rate_by_provider()"),
    }


HISTORY_FIELDS = ["claim_id", "member_id", "member_cumulative_paid", "days_since_last_claim"]


def history_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims as three loads (by date, with late claims in the second and third), read back as one history."""
    root = f"{layer_path(spark, sf_dir)}_history"
    rows = claims(spark, sf_dir)
    month, late = F.month("service_date"), md5_bucket(F.col("claim_id"), "late")
    load = F.when(late < 2, 3).when((F.year("service_date") < 1996) & ~(late < 4), 1).otherwise(2) + F.when((month == 12) & (F.year("service_date") >= 1997), 1).otherwise(0)
    manifest = published.latest(spark, root)
    for n in range((manifest["facts"]["loads"] if manifest else 0) + 1, 4):
        append_load(spark, root, rows.filter(F.least(load, F.lit(3)) == n))
    return report_types(read_history(spark, root).select(*HISTORY_FIELDS))


def table_queries() -> dict[str, Query]:
    return {
        "s7_clustered_high_cost_members": lambda s, d: A.high_cost_members(clustered_claims(s, d)),
        "s7_clustered_members_of_states": lambda s, d: report_types(members_of_states(clustered_claims(s, d), ASKED_STATES, "1995-01-01", "1996-06-30")),
        "s7_clustered_lookup": clustered_lookup,
        "s4_table_windows": lambda s, d: report_types(table_member_windows(s, claims_table(s, d)).select(*HISTORY_FIELDS)),
        "s4_table_readmissions": lambda s, d: table_readmissions(s, claims_table(s, d)),
        "s4_table_claims_of_members": lambda s, d: report_types(table_claims_of_members(s, claims_table(s, d), SELECTIVE_THRESHOLD)).select("claim_id", "member_id", "paid_amount"),
        "w1_history_of_loads": history_of_loads,
        "a6_sketched_members": sketched_members,
    }


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check(raw_claims(spark, sf_dir))


def curated_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the wide curated table over all claims (derive + windows)."""
    return report_types(transform(claims(spark, sf_dir)))


def etl_queries() -> dict[str, Query]:
    return {
        "e1_raw_claims": lambda s, d: raw_claims(s, d).select(*RAW_FIELDS),
        "e2_validation_errors": lambda s, d: Q.validation_errors(_checked(s, d)),
        "e2_valid_claims": lambda s, d: report_types(Q.valid_claims(_checked(s, d))),
        "e2_quality_counts": lambda s, d: Q.quality_counts(_checked(s, d)),
        "e3_curated_claims": curated_claims,
        "e4_curated_paid": lambda s, d: report_types(
            curated_paid(transform(Q.valid_claims(_checked(s, d))))
        ),
        "q12_analytics_summary": lambda s, d: E.analytics_summary(
            derive(Q.valid_claims(_checked(s, d)))
        ),
        "q13_load_summary": lambda s, d: E.load_summary(_checked(s, d)),
    }


SEGMENT_FIELDS = ["claim_id", "member_id", "claim_type", "claim_status", "paid_amount"]


def segment_queries() -> dict[str, Query]:
    def seg(fn: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda s, d: fn(claims(s, d, SEGMENT_FIELDS))

    return {
        "v1_pareto_curve": seg(V.pareto_curve),
        "v2_top_share": seg(V.top_share),
        "v3_spend_by_claim_type": seg(V.spend_by_claim_type),
        "v4_unit_cost_by_claim_type": seg(V.unit_cost_by_claim_type),
        "v5_cost_segments": seg(V.cost_segments),
        "v5b_high_cost_claims": lambda s, d: V.segment_claims(
            claims(s, d, SEGMENT_FIELDS + ["service_date"])
        ).select("claim_id", "member_id", "service_date", "claim_type", F.col("paid_amount").cast("double").alias("paid_amount")),
        "v6_segment_claim_type_mix": seg(V.segment_claim_type_mix),
        "v7_segment_age_mix": seg(V.segment_age_mix),
        "v8_headline_counts": lambda s, d: V.headline_counts(
            claims(s, d, ["member_id", "claim_status", "paid_amount"])
        ),
    }


# classifier responses: which claims get a malformed or an empty reply
RESPONSE_SEED = "resp"


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies as a classifier sends them, in its own spelling and not by the library's writer: some broken."""
    notes = denial_notes(spark, sf_dir)
    b = md5_bucket(F.col("claim_id"), RESPONSE_SEED)
    entry = lambda category, confidence: F.concat(F.lit('[ {"category" : "' + category + '", "confidence": ' + confidence + ', "note":"'), F.col("note"), F.lit('"} ]'))
    text = (
        F.when(b < 5, F.concat(F.lit('[{"note": "'), F.col("note")))
        .when(b < 8, F.lit(" [] "))
        .when(b < 10, F.lit('{"error":"rate limited"}'))
        .when(b < 12, F.lit("[null]"))
        .when(b < 14, entry("BANANA", "0.7"))
        .when(b < 16, entry("OTHER", "7"))
        .when(b < 18, entry("OTHER", '"high"'))
        .when(b < 60, entry("CODING_ERROR", "0.75"))
        .otherwise(entry("ELIGIBILITY_ISSUE", "1"))
    )
    return notes.select("claim_id", text.alias("response"))


def note_length_scorer(notes: pd.Series) -> pd.DataFrame:
    """A scorer as a user might plug in (it runs by batch in the executors): short notes are filed apart."""
    length = notes.fillna("").str.len()
    return pd.DataFrame({"category": np.where(length < 25, "SHORT", "LONG"), "confidence": length.clip(upper=50) / 50.0})


def trained_categories(spark: SparkSession, sf_dir: str, **training) -> DataFrame:
    """Every denial note by a classifier trained on the wordings that the rules are sure of."""
    notes = denial_notes(spark, sf_dir)
    return classify_by_model(notes, train_note_model(rule_labels(notes), **training))


def text_queries() -> dict[str, Query]:
    return {
        "t1_executive_summary": lambda s, d: N.executive_summary_text(
            claims(s, d, ["claim_status", "billed_amount", "paid_amount", "claim_type", "provider_type"])
        ),
        "t2_denial_note_categories": lambda s, d: N.classify_denial_notes(denial_notes(s, d)),
        "t2_trained_note_categories": lambda s, d: trained_categories(s, d).drop("confidence"),
        "t3_trained_category_trend": lambda s, d: N.denial_category_trend(trained_categories(s, d, folds=0)),
        "u1_scored_notes": lambda s, d: N.classify_denial_notes(denial_notes(s, d), scorer=note_length_scorer),
        "t3_denial_category_trend": lambda s, d: N.denial_category_trend(
            N.classify_denial_notes(denial_notes(s, d))
        ),
        "t4_parse_classifications": lambda s, d: N.parse_classifications(_responses(s, d)),
        "t5_anomaly_payload": lambda s, d: N.anomaly_payload(
            claims(s, d, ["claim_id", "claim_status", "paid_amount"])
        ),
        "t6_explain_anomalies": lambda s, d: N.explain_anomalies(
            claims(s, d, ["claim_id", "member_id", "claim_status", "paid_amount"])
        ),
    }


def streamed_valid_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw landing feed ingested by the streaming job (availableNow),
    read back: the same rows as the batch valid claims."""
    import uuid

    from carelake.streaming.landing import LandingPaths, start_landing_ingest

    feed = raw_feed(spark, sf_dir)
    runs = f"{layer_path(spark, sf_dir)}_stream"
    remove(spark, runs)  # earlier runs' copies
    root = f"{runs}/{uuid.uuid4().hex}"
    paths = LandingPaths(feed, f"{root}/claims", f"{root}/errors", f"{root}/checkpoint")
    start_landing_ingest(spark, paths).awaitTermination()
    return report_types(read_layout(spark, paths.claims_dir).select(*RAW_FIELDS))


def all_queries() -> dict[str, Query]:
    out = analytics_queries()
    out.update(etl_queries())
    out.update(run_queries())
    out.update(table_queries())
    out.update(rollup_queries())
    out.update(sql_function_queries())
    out.update(segment_queries())
    out.update(text_queries())
    out["s1_streamed_valid_claims"] = streamed_valid_claims
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated_claims(spark, sf_dir)
