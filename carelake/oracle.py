"""DuckDB SQL for every registered query: an independent statement of the
same semantics, used as the correctness oracle.

The claims mapping is written again here in plain SQL (not generated from the
Spark code). Ratios use exact integer HALF_UP division, as the Spark side does,
because DuckDB divides decimals in DOUBLE.
"""

from __future__ import annotations

from carelake.schema import ANOMALY_LABEL


def xr(num: str, den: str, scale: int = 2, factor: int = 1, num_unit: int = 1, den_unit: int = 1) -> str:
    """SQL for round_half_up(factor * num / den, scale) as DOUBLE."""
    f = (10**scale) * factor
    n = f"CAST(({num}) * {num_unit} AS HUGEINT)"
    d = f"NULLIF(CAST(({den}) * {den_unit} AS HUGEINT), 0)"
    return (
        f"(CAST(((2 * ABS({n}) * {f} + ABS({d})) // (2 * ABS({d}))) "
        f"* (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) AS DOUBLE) / {10**scale})"
    )


def avg_m(col: str) -> str:
    return xr(f"SUM({col})", f"COUNT({col})", 2, 1, 10000, 10000)


def sum_m(col: str) -> str:
    return f"CAST(ROUND(SUM({col}), 2) AS DOUBLE)"


def pct(num: str, den: str, unit: int = 1) -> str:
    return xr(num, den, 2, 100, unit, unit)


STATUS = """CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F') THEN 'PAID'
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'PENDING'
            WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'DENIED'
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'VOID' END"""

CLAIMS_CTE = f"""
li AS (
  SELECT *, {STATUS} AS st FROM lineitem
),
claims AS (
  SELECT
    concat_ws('-', CAST(li.l_orderkey AS VARCHAR), CAST(li.l_partkey AS VARCHAR),
              CAST(li.l_suppkey AS VARCHAR), CAST(li.l_linenumber AS VARCHAR)) AS claim_id,
    CAST(o.o_custkey AS VARCHAR) AS member_id,
    n.n_name AS state_code,
    c.c_mktsegment AS plan_id,
    CAST(li.l_shipdate AS DATE) AS service_date,
    CASE WHEN p.p_type IS NULL THEN NULL
         WHEN p.p_type LIKE 'LARGE%' THEN 'IP'
         WHEN p.p_type LIKE 'PROMO%' THEN 'LTC'
         WHEN p.p_type LIKE 'SMALL%' THEN 'RX'
         ELSE 'OP' END AS claim_type,
    p.p_brand AS diagnosis_code,
    p.p_type AS procedure_code,
    CAST(CAST(li.l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS billed_amount,
    CAST(CASE WHEN li.st = 'PAID'
              THEN CAST(CAST(li.l_extendedprice AS DECIMAL(12,2))
                        * (1 - CAST(li.l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2))
              WHEN li.st = 'DENIED' AND li.l_tax >= 0.07 THEN 100
              WHEN li.st IS NOT NULL THEN 0 END AS DECIMAL(18,4)) AS paid_amount,
    li.st AS claim_status,
    CAST(li.l_suppkey AS VARCHAR) AS provider_id,
    CASE substr(o.o_orderpriority, 1, 1)
         WHEN '1' THEN 'HOSPITAL' WHEN '2' THEN 'PHYSICIAN' WHEN '3' THEN 'BEHAVIORAL'
         WHEN '4' THEN 'NURSING' WHEN '5' THEN 'PHYSICIAN' END AS provider_type,
    'Y' AS managed_care_flag,
    li.l_orderkey AS _orderkey,
    li.l_linenumber AS _linenumber
  FROM li
  LEFT JOIN orders o ON li.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON li.l_partkey = p.p_partkey
)"""


def with_claims(body: str, extra_ctes: str = "") -> str:
    ctes = CLAIMS_CTE + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


PAID = "claim_status = 'PAID'"


def _q1() -> str:
    return with_claims(
        f"""SELECT COUNT(*) AS total_claims,
       COUNT(CASE WHEN claim_status = 'PAID' THEN 1 END) AS paid_claims,
       COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END) AS denied_claims,
       {pct("COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)", "COUNT(*)")} AS denial_rate_pct,
       {sum_m("billed_amount")} AS total_billed,
       {sum_m("paid_amount")} AS total_paid,
       {pct("SUM(paid_amount)", "SUM(billed_amount)", 10000)} AS avg_payment_rate_pct
FROM claims"""
    )


def _q2() -> str:
    return with_claims(
        f"""SELECT strftime(service_date, '%Y-%m') AS service_month, claim_type,
       COUNT(*) AS claim_count, {sum_m("paid_amount")} AS total_paid,
       {avg_m("paid_amount")} AS avg_paid_per_claim
FROM claims WHERE {PAID} GROUP BY 1, 2"""
    )


def _q3() -> str:
    return with_claims(
        f"""SELECT state_code, plan_id, COUNT(DISTINCT member_id) AS unique_members,
       COUNT(*) AS total_claims, {sum_m("paid_amount")} AS total_paid,
       {xr("SUM(paid_amount)", "COUNT(DISTINCT member_id)", 2, 1, 10000, 10000)} AS pmpm_proxy
FROM claims WHERE {PAID} GROUP BY 1, 2"""
    )


def _q4(threshold: float = 5000, limit: int | None = 20) -> str:
    lim = f"ORDER BY total_paid DESC, member_id, state_code LIMIT {limit}" if limit else ""
    return with_claims(
        f"""SELECT member_id, state_code, COUNT(*) AS total_claims,
       COUNT(CASE WHEN claim_type = 'IP' THEN 1 END) AS inpatient_visits,
       {sum_m("paid_amount")} AS total_paid,
       {avg_m("paid_amount")} AS avg_per_claim,
       MAX(service_date) AS most_recent_claim
FROM claims WHERE {PAID} GROUP BY 1, 2
HAVING SUM(paid_amount) > {threshold}
{lim}"""
    )


BH = "claim_status = 'PAID' AND provider_type = 'BEHAVIORAL'"


def _q5() -> str:
    return with_claims(
        f"""SELECT state_code, provider_type, claim_count, unique_members, total_paid, avg_paid,
       {pct("claim_count", "SUM(claim_count) OVER (PARTITION BY state_code)")} AS pct_of_state_claims
FROM (SELECT state_code, provider_type, COUNT(*) AS claim_count,
             COUNT(DISTINCT member_id) AS unique_members,
             {sum_m("paid_amount")} AS total_paid, {avg_m("paid_amount")} AS avg_paid
      FROM claims WHERE {BH} GROUP BY 1, 2) g"""
    )


def _q5b() -> str:
    return with_claims(
        f"""SELECT state_code, COUNT(*) AS bh_claims, COUNT(DISTINCT member_id) AS unique_members,
       {sum_m("paid_amount")} AS total_paid, {avg_m("paid_amount")} AS avg_paid
FROM claims WHERE {BH} GROUP BY 1"""
    )


def _q5c() -> str:
    bh = "COUNT(CASE WHEN provider_type = 'BEHAVIORAL' THEN 1 END)"
    return with_claims(
        f"""SELECT state_code, {bh} AS bh_claims, COUNT(*) AS paid_claims,
       {pct(bh, "COUNT(*)")} AS bh_pct_of_state_claims
FROM claims WHERE {PAID} GROUP BY 1"""
    )


def _q6() -> str:
    d = "COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)"
    return with_claims(
        f"""SELECT provider_type, COUNT(*) AS total_claims, {d} AS denied,
       {pct(d, "COUNT(*)")} AS denial_rate_pct,
       CAST(ROUND(SUM(billed_amount) - SUM(paid_amount), 2) AS DOUBLE) AS total_underpaid
FROM claims GROUP BY 1"""
    )


def _q7(limit: int = 15) -> str:
    return with_claims(
        f"""SELECT diagnosis_code, COUNT(*) AS claim_count, COUNT(DISTINCT member_id) AS unique_members,
       {sum_m("paid_amount")} AS total_paid, {avg_m("paid_amount")} AS avg_per_claim
FROM claims WHERE {PAID} GROUP BY 1
ORDER BY total_paid DESC, diagnosis_code ASC NULLS LAST LIMIT {limit}"""
    )


def _q8() -> str:
    return with_claims(
        f"""SELECT claim_id, member_id, service_date, claim_type,
       CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount,
       claim_status, '{ANOMALY_LABEL}' AS anomaly_flag
FROM claims WHERE claim_status = 'DENIED' AND paid_amount > 0"""
    )


def _q9(days: int = 30) -> str:
    return with_claims(
        f"""SELECT stay.member_id, stay.id AS first_admit, stay.day AS first_admit_date,
       unnest(back.ids) AS readmit_claim, back.day AS readmit_date, CAST(back.day - stay.day AS INTEGER) AS days_between
FROM stays stay
JOIN (SELECT member_id, day, list(id) AS ids FROM stays GROUP BY ALL) back
  ON back.member_id = stay.member_id
 AND back.day BETWEEN stay.day + 1 AND stay.day + {days}""",
        """stays AS (
  SELECT member_id, claim_id AS id, service_date AS day FROM claims
  WHERE claim_status = 'PAID' AND claim_type = 'IP'
)"""
    )


def _q10() -> str:
    return with_claims(
        """SELECT member_id, COUNT(*) AS inpatient_stays FROM claims
WHERE claim_type = 'IP' AND claim_status = 'PAID'
GROUP BY member_id HAVING COUNT(*) > 1"""
    )


def _q11() -> str:
    return with_claims(
        f"""SELECT state_code, {sum_m("paid_amount")} AS bh_spend FROM claims
WHERE {BH} GROUP BY state_code"""
    )


def _q14() -> str:
    d = "COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)"
    ip = "CASE WHEN claim_type = 'IP' THEN paid_amount END"
    bh = "CASE WHEN provider_type = 'BEHAVIORAL' THEN paid_amount END"
    return with_claims(
        f"""SELECT COUNT(*) AS total_claims,
       COUNT(CASE WHEN claim_status = 'PAID' THEN 1 END) AS paid_claims,
       {d} AS denied_claims, {pct(d, "COUNT(*)")} AS denial_rate_pct,
       {sum_m("billed_amount")} AS total_billed, {sum_m("paid_amount")} AS total_paid,
       {avg_m(ip)} AS inpatient_avg_paid, {sum_m(bh)} AS behavioral_health_spend
FROM claims"""
    )


def _q15(dim: str) -> str:
    return with_claims(f"SELECT {dim}, {sum_m('paid_amount')} AS total_paid FROM claims GROUP BY 1")


def _q16(limit: int = 5) -> str:
    return with_claims(
        f"""SELECT diagnosis_code, COUNT(claim_id) AS claim_count FROM claims GROUP BY 1
ORDER BY claim_count DESC, diagnosis_code ASC NULLS LAST LIMIT {limit}"""
    )


def analytics_sql() -> dict[str, str]:
    return {
        "q1_baseline_kpis": _q1(),
        "q2_monthly_spend_trend": _q2(),
        "q3_spend_by_state_plan": _q3(),
        "q4_high_cost_members": _q4(),
        "q4_high_cost_members_all": _q4(limit=None),
        "q4_high_cost_members_selective": _q4(threshold=2_500_000, limit=None),
        "q5_behavioral_utilization": _q5(),
        "q5b_behavioral_by_state": _q5b(),
        "q5c_behavioral_share_of_state": _q5c(),
        "q6_denial_rate_by_provider": _q6(),
        "q7_top_diagnoses_by_spend": _q7(),
        "q8_denied_with_payment": _q8(),
        "q9_readmission_pairs": _q9(),
        "q10_repeat_inpatient_members": _q10(),
        "q11_behavioral_spend_by_state": _q11(),
        "q14_executive_metrics": _q14(),
        "q15_spend_by_claim_type": _q15("claim_type"),
        "q15_spend_by_state": _q15("state_code"),
        "q15_spend_by_provider": _q15("provider_type"),
        "q16_top_diagnoses_by_count": _q16(),
    }


def all_sql() -> dict[str, str]:
    out = analytics_sql()
    out.update(etl_sql())
    out.update(segment_sql())
    out.update(text_sql())
    # from the rollup of two loads: the same rows
    for name in ("q1_baseline_kpis", "q2_monthly_spend_trend", "q3_spend_by_state_plan", "q4_high_cost_members", "q5_behavioral_utilization", "q6_denial_rate_by_provider", "q7_top_diagnoses_by_spend"):
        out[f"r_{name}"] = out[name]
    # called from SQL text: the same rows
    for name, of in {
        "high_cost_members": "q4_high_cost_members", "high_cost_members_selective": "q4_high_cost_members_selective", "readmission_pairs": "q9_readmission_pairs",
        "spend_by_state_plan": "q3_spend_by_state_plan", "top_diagnoses": "q7_top_diagnoses_by_spend", "denial_rate_by_provider": "q6_denial_rate_by_provider",
    }.items():
        out[f"s5_sql_{name}"] = out[of]
    # the streaming ingest must produce exactly the batch valid claims
    out["s1_streamed_valid_claims"] = out["e2_valid_claims"]
    return out


# ---------------------------------------------------------------------------
# Raw text claims with seeded defects, validation, typed valid rows, curation
# ---------------------------------------------------------------------------
from carelake.schema import NA_TOKENS, RAW_FIELDS  # noqa: E402


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


RAW_CTES = f"""
slotted AS (
  SELECT *, (_orderkey * 31 + _linenumber) % 97 AS slot FROM claims
),
raw AS (
  SELECT claim_id,
    CASE WHEN slot = 5 THEN NULL ELSE member_id END AS member_id,
    CASE WHEN slot = 10 THEN 'NA' ELSE state_code END AS state_code,
    plan_id,
    CASE WHEN slot = 4 THEN '2024-13-01' WHEN slot = 10 THEN 'bad'
         ELSE strftime(service_date, '%Y-%m-%d') END AS service_date,
    CASE slot WHEN 0 THEN 'XX' WHEN 6 THEN NULL WHEN 8 THEN 'ip' ELSE claim_type END AS claim_type,
    diagnosis_code, procedure_code,
    CASE slot WHEN 2 THEN 'N/A' WHEN 7 THEN 'abc'
         ELSE CAST(CAST(billed_amount AS DECIMAL(12,2)) AS VARCHAR) END AS billed_amount,
    CASE slot WHEN 3 THEN 'x12' WHEN 9 THEN ''
         ELSE CAST(CAST(paid_amount AS DECIMAL(12,2)) AS VARCHAR) END AS paid_amount,
    CASE slot WHEN 1 THEN 'OPEN' WHEN 7 THEN 'OPEN' ELSE claim_status END AS claim_status,
    provider_id, provider_type, managed_care_flag
  FROM slotted
),
nz AS (
  SELECT {", ".join(f"CASE WHEN {f} IN ({_sql_list(NA_TOKENS)}) THEN NULL ELSE {f} END AS {f}" for f in RAW_FIELDS)}
  FROM raw
),
errs AS (
  {" UNION ALL ".join(f"SELECT claim_id, 'NULL_VALUE' AS rule, '{c}' AS field, {c} AS bad_value, 'Null in {c}' AS error FROM nz WHERE {c} IS NULL" for c in ["claim_id", "member_id", "state_code", "service_date", "claim_type", "billed_amount", "paid_amount", "claim_status"])}
  UNION ALL SELECT claim_id, 'UNKNOWN_CLAIM_TYPE', 'claim_type', claim_type,
         'Unknown claim_type: ' || COALESCE(claim_type, 'nan') FROM nz
         WHERE claim_type IS NULL OR claim_type NOT IN ('IP', 'OP', 'LTC', 'RX')
  UNION ALL SELECT claim_id, 'UNKNOWN_CLAIM_STATUS', 'claim_status', claim_status,
         'Unknown claim_status: ' || COALESCE(claim_status, 'nan') FROM nz
         WHERE claim_status IS NULL OR claim_status NOT IN ('PAID', 'DENIED', 'PENDING', 'VOID')
  UNION ALL SELECT claim_id, 'NON_NUMERIC', 'billed_amount', billed_amount, 'Non-numeric billed_amount'
         FROM nz WHERE TRY_CAST(billed_amount AS DECIMAL(18,4)) IS NULL
  UNION ALL SELECT claim_id, 'NON_NUMERIC', 'paid_amount', paid_amount, 'Non-numeric paid_amount'
         FROM nz WHERE TRY_CAST(paid_amount AS DECIMAL(18,4)) IS NULL
  UNION ALL SELECT claim_id, 'BAD_DATE', 'service_date', service_date,
         'Bad date in service_date: ' || service_date FROM nz
         WHERE service_date IS NOT NULL AND TRY_STRPTIME(service_date, '%Y-%m-%d') IS NULL
),
valid_text AS (
  SELECT * FROM nz
  WHERE claim_id IS NOT NULL AND member_id IS NOT NULL AND state_code IS NOT NULL
    AND claim_type IN ('IP', 'OP', 'LTC', 'RX')
    AND claim_status IN ('PAID', 'DENIED', 'PENDING', 'VOID')
    AND TRY_CAST(billed_amount AS DECIMAL(18,4)) IS NOT NULL
    AND TRY_CAST(paid_amount AS DECIMAL(18,4)) IS NOT NULL
    AND TRY_STRPTIME(service_date, '%Y-%m-%d') IS NOT NULL
),
vt AS (
  SELECT claim_id, member_id, state_code, plan_id,
         CAST(TRY_STRPTIME(service_date, '%Y-%m-%d') AS DATE) AS service_date,
         claim_type, diagnosis_code, procedure_code,
         TRY_CAST(billed_amount AS DECIMAL(18,4)) AS billed_amount,
         TRY_CAST(paid_amount AS DECIMAL(18,4)) AS paid_amount,
         claim_status, provider_id, provider_type, managed_care_flag
  FROM valid_text
)"""

RAW_SELECT = ", ".join(RAW_FIELDS)


def derived_cte(src: str, name: str = "der") -> str:
    rate = xr("paid_amount", "billed_amount", 4, 1, 10000, 10000)
    return f"""
{name} AS (
  SELECT {RAW_SELECT},
    CAST(year(service_date) AS INTEGER) AS service_year,
    CAST(month(service_date) AS INTEGER) AS service_month,
    CAST(quarter(service_date) AS INTEGER) AS service_quarter,
    CASE WHEN billed_amount > 0 THEN {rate} ELSE 0.0 END AS payment_rate,
    COALESCE(claim_type = 'IP', false) AS is_inpatient,
    COALESCE(claim_status = 'DENIED', false) AS is_denied,
    COALESCE(provider_type = 'BEHAVIORAL', false) AS is_behavioral,
    COALESCE(claim_status = 'DENIED', false) AND COALESCE(paid_amount > 0, false) AS anomaly_paid_denied
  FROM {src}
)"""


def curated_cte(src: str, name: str = "cur") -> str:
    return derived_cte(src, "der_" + name) + f""",
{name} AS (
  SELECT *,
    SUM(paid_amount) OVER (PARTITION BY member_id ORDER BY service_date, claim_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS member_cumulative_paid,
    CAST(date_diff('day', LAG(service_date) OVER (PARTITION BY member_id ORDER BY service_date, claim_id),
                   service_date) AS INTEGER) AS days_since_last_claim
  FROM der_{name}
)"""


def _report(cols: list[str], money: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols)


MONEY_COLS = {"billed_amount", "paid_amount", "member_cumulative_paid"}


def etl_sql() -> dict[str, str]:
    from carelake.schema import CURATED_FIELDS, CURATED_PAID_FIELDS

    # as read back from the CSV landing file: empty text is null
    raw_body = "SELECT " + ", ".join(f"NULLIF({f}, '') AS {f}" for f in RAW_FIELDS) + " FROM raw"
    errors = "SELECT claim_id, rule, field, bad_value, error FROM errs"
    valid = f"SELECT {_report(RAW_FIELDS, MONEY_COLS)} FROM vt"
    counts = """SELECT (SELECT COUNT(*) FROM nz) AS rows_raw,
       (SELECT COUNT(*) FROM vt) AS rows_valid,
       (SELECT COUNT(*) FROM nz) - (SELECT COUNT(*) FROM vt) AS rows_invalid,
       (SELECT COUNT(*) FROM errs) AS error_count"""
    e3 = f"SELECT {_report(CURATED_FIELDS, MONEY_COLS)} FROM cur"
    e4 = f"SELECT {_report(CURATED_PAID_FIELDS, MONEY_COLS)} FROM cur WHERE claim_status = 'PAID'"
    d = "COUNT(CASE WHEN is_denied THEN 1 END)"
    q13 = f"""SELECT c.*, t.* FROM ({counts}) c, (
  SELECT COUNT(CASE WHEN anomaly_paid_denied THEN 1 END) AS anomalies_found,
         {sum_m("billed_amount")} AS total_billed, {sum_m("paid_amount")} AS total_paid,
         {pct(d, "COUNT(*)")} AS denial_rate_pct
  FROM der) t"""
    rate = "CAST(payment_rate AS DECIMAL(38,4))"
    paid_rate = f"CASE WHEN claim_status = 'PAID' THEN {rate} END"
    dd = "COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)"
    scal = {
        "total_claims": "COUNT(*)",
        "paid_claims": "COUNT(CASE WHEN claim_status = 'PAID' THEN 1 END)",
        "denied_claims": dd,
        "denial_rate_pct": pct(dd, "COUNT(*)"),
        "total_billed": sum_m("billed_amount"),
        "total_paid": sum_m("paid_amount"),
        "mean_payment_rate_pct": pct(f"SUM({paid_rate})", f"COUNT({paid_rate})", 10000),
        "inpatient_avg_paid": avg_m("CASE WHEN is_inpatient THEN paid_amount END"),
        "behavioral_health_spend": sum_m("CASE WHEN is_behavioral THEN paid_amount END"),
    }
    parts = [
        f"SELECT '{k}' AS metric, CAST(NULL AS VARCHAR) AS key, CAST({v} AS DOUBLE) AS value FROM der"
        for k, v in scal.items()
    ]
    for metric, dim in (
        ("spend_by_claim_type", "claim_type"),
        ("spend_by_state", "state_code"),
        ("spend_by_provider", "provider_type"),
    ):
        parts.append(
            f"SELECT '{metric}', {dim}, {sum_m('paid_amount')} FROM der GROUP BY {dim}"
        )
    parts.append(
        "SELECT * FROM (SELECT 'top_diagnoses', diagnosis_code, CAST(COUNT(claim_id) AS DOUBLE) AS v "
        "FROM der GROUP BY diagnosis_code ORDER BY v DESC, diagnosis_code ASC NULLS LAST LIMIT 5)"
    )
    q12 = "\nUNION ALL ".join(parts)
    keyed = "', '".join(["spend_by_claim_type", "spend_by_state", "spend_by_provider", "top_diagnoses"])
    record = f"""SELECT metric, CASE WHEN metric IN ('{keyed}') THEN COALESCE(key, 'null') END AS key, value
FROM ({q12})"""
    bucket = _bucket_sql("claim_id", "mixed")
    mixed = f"""SELECT claim_id, NULLIF(member_id, '') AS member_id, state_code, NULLIF(paid_amount, '') AS paid_amount,
       CASE WHEN {bucket} BETWEEN 80 AND 84 THEN NULL ELSE managed_care_flag END AS managed_care_flag,
       {bucket} BETWEEN 80 AND 89 AS malformed
FROM raw"""
    windows = f"SELECT {_report(['claim_id', 'member_id', 'member_cumulative_paid', 'days_since_last_claim'], MONEY_COLS)} FROM cur"
    of_members = """SELECT claim_id, member_id, CAST(paid_amount AS DOUBLE) AS paid_amount FROM claims
WHERE claim_status = 'PAID' AND member_id IN (
  SELECT member_id FROM claims WHERE claim_status = 'PAID' GROUP BY member_id HAVING SUM(paid_amount) > 2500000)"""
    files = "(SELECT 4 + COUNT(*) // 1000000 FROM lineitem)"
    place = f"""placed AS (
  SELECT claim_id, {_bucket_sql("claim_id", "lines", files)} AS part, {_bucket_sql("claim_id", "gap")} < 5 AS gap FROM raw
), numbered AS (
  SELECT claim_id, part,
    CAST(1 + COUNT(*) OVER w + COUNT(CASE WHEN gap THEN 1 END) OVER w AS BIGINT) AS source_line
  FROM placed WINDOW w AS (PARTITION BY part ORDER BY claim_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""
    by_state = """SELECT state_code, COUNT(*) AS n_claims,
       CAST(SUM(TRY_CAST(paid_amount AS DECIMAL(18,4))) AS DOUBLE) AS paid
FROM raw WHERE claim_status = 'PAID' GROUP BY state_code"""
    with_raw = lambda body, extra="": with_claims(body, RAW_CTES + ("," + extra if extra else ""))
    return {
        "e1_raw_claims": with_raw(raw_body),
        "e2_validation_errors": with_raw(errors),
        "e2_valid_claims": with_raw(valid),
        "e2_quality_counts": with_raw(counts),
        "e3_curated_claims": with_claims(e3, curated_cte("claims")),
        "e1_mixed_landing": with_raw(mixed),
        "s5_sql_paid_by_state": with_raw(by_state),
        "e4_run_curated": with_raw(e3, curated_cte("vt")),
        "e4_run_paid_by_state": with_raw(e4, curated_cte("vt")),
        "e4_run_errors": with_raw(errors),
        "e4_run_summary": with_raw(record, derived_cte("vt")),
        "e4_run_summary_rows": with_raw(q12, derived_cte("vt")),
        "e4_run_load_summary": with_raw("SELECT '2024-01-01T00:00:00' AS run_timestamp, s.* FROM (" + q13 + ") s", derived_cte("vt")),
        "f19_error_lines": with_raw("SELECT claim_id, rule, field, part, source_line FROM errs JOIN numbered USING (claim_id)", place),
        "s7_clustered_high_cost_members": _q4(),
        "s7_clustered_members_of_states": with_claims(
            """SELECT state_code, member_id, COUNT(*) AS claims, CAST(SUM(paid_amount) AS DOUBLE) AS total_paid, MAX(service_date) AS last_claim
FROM claims WHERE claim_status = 'PAID' AND state_code IN ('NATION_3', 'NATION_11', 'NATION_17')
  AND service_date BETWEEN DATE '1995-01-01' AND DATE '1996-06-30' GROUP BY 1, 2"""
        ),
        "s7_clustered_lookup": with_claims(
            f"""SELECT claim_id, member_id, state_code, service_date, CAST(paid_amount AS DOUBLE) AS paid_amount FROM claims
WHERE {_bucket_sql("claim_id", "ask")} < 5 AND {_bucket_sql("claim_id", "once")} < 5"""
        ),
        "s4_table_windows": with_claims(windows, curated_cte("claims")),
        "s4_table_readmissions": _q9(),
        "s4_table_claims_of_members": with_claims(of_members),
        "w1_history_of_loads": with_claims(windows, curated_cte("claims")),
        "e4_curated_paid": with_raw(e4, curated_cte("vt")),
        "q12_analytics_summary": with_raw(q12, derived_cte("vt")),
        "r_q12_analytics_summary": with_claims(q12, derived_cte("claims")),
        "a6_sketched_members": with_claims(
            "SELECT state_code, plan_id, COUNT(DISTINCT member_id) AS exact_members, TRUE AS within_bound FROM claims WHERE claim_status = 'PAID' GROUP BY 1, 2"
        ),
        "q13_load_summary": with_raw(q13, derived_cte("vt")),
    }


# ---------------------------------------------------------------------------
# Segments
# ---------------------------------------------------------------------------
SEG_CTES = """
ms AS (
  SELECT member_id, SUM(paid_amount) AS mp, COUNT(*) AS n_claims
  FROM claims WHERE claim_status = 'PAID' GROUP BY member_id
),
r AS (
  SELECT member_id, mp, n_claims,
         ROW_NUMBER() OVER (ORDER BY mp DESC, member_id) AS rk,
         SUM(mp) OVER (ORDER BY mp DESC, member_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         COUNT(*) OVER () AS n, SUM(mp) OVER () AS total
  FROM ms
),
ra AS (
  SELECT member_id, mp, ROW_NUMBER() OVER (ORDER BY mp, member_id) AS rk, COUNT(*) OVER () AS n FROM ms
),
med AS (
  SELECT SUM(CASE WHEN rk = (n - 1) // 2 + 1 THEN mp END) + SUM(CASE WHEN rk = n // 2 + 1 THEN mp END) AS med2
  FROM ra
),
seg AS (
  SELECT ms.member_id, ms.mp, ms.n_claims,
         CASE WHEN 2 * ms.mp >= med.med2 THEN 'High-Cost' ELSE 'Low-Cost' END AS segment
  FROM ms, med
)"""


def _age_band_sql(col: str) -> str:
    b = f"(('0x' || substr(md5('42:' || {col}), 1, 8))::BIGINT % 100)"
    return (
        f"CASE WHEN {b} < 15 THEN '18–34' WHEN {b} < 40 THEN '35–49' "
        f"WHEN {b} < 75 THEN '50–64' ELSE '65+' END"
    )


def _mix(label_expr: str, values: list[str], names: list[str]) -> str:
    counts = [f"COUNT(CASE WHEN lbl = '{v}' THEN 1 END)" for v in values]
    total = "(" + " + ".join(counts) + ")"
    cols = ", ".join(f"{pct(c, total)} AS {n}" for c, n in zip(counts, names))
    return f"""SELECT segment, CAST({total} AS BIGINT) AS claims, {cols}
FROM (SELECT seg.segment, {label_expr} AS lbl
      FROM claims JOIN seg ON claims.member_id = seg.member_id
      WHERE claims.claim_status = 'PAID') x
GROUP BY segment"""


def segment_sql() -> dict[str, str]:
    w = lambda body: with_claims(body, SEG_CTES)
    v1 = f"""SELECT member_id, CAST(ROUND(mp, 2) AS DOUBLE) AS total_paid, rk AS spend_rank,
       CASE WHEN n <= 1 THEN 0.0 ELSE {xr("rk - 1", "n - 1", 4, 100)} END AS member_pct,
       {xr("cum", "total", 4, 100, 10000, 10000)} AS cum_pct,
       rk <= GREATEST(1, FLOOR(n * 0.2::DOUBLE)) AS is_top
FROM r"""
    v2 = f"""SELECT n AS members, CAST(GREATEST(1, FLOOR(n * 0.2::DOUBLE)) AS BIGINT) AS top_members,
       CAST(ROUND(cum, 2) AS DOUBLE) AS top_paid, CAST(ROUND(total, 2) AS DOUBLE) AS total_paid,
       {xr("cum", "total", 4, 100, 10000, 10000)} AS top_pct
FROM r WHERE rk = GREATEST(1, FLOOR(n * 0.2::DOUBLE))"""
    v3 = f"""SELECT claim_type, {sum_m("paid_amount")} AS total_paid,
       {xr("SUM(paid_amount)", "SUM(SUM(paid_amount)) OVER ()", 2, 100, 10000, 10000)} AS share_pct
FROM claims WHERE claim_status = 'PAID' GROUP BY claim_type"""
    v4 = f"""SELECT claim_type, {avg_m("paid_amount")} AS avg_paid, COUNT(*) AS claim_count
FROM claims WHERE claim_status = 'PAID' GROUP BY claim_type"""
    v5 = f"""SELECT segment, COUNT(*) AS members, CAST(SUM(n_claims) AS BIGINT) AS claims,
       {xr("SUM(mp)", "SUM(n_claims)", 2, 1, 10000, 10000)} AS avg_paid,
       CAST(ROUND(SUM(mp), 2) AS DOUBLE) AS total_paid
FROM seg GROUP BY segment"""
    types = ["IP", "OP", "LTC", "RX"]
    v6 = _mix("claims.claim_type", types, [f"{t}_pct" for t in types])
    v7 = _mix(
        _age_band_sql("claims.claim_id"),
        ["18–34", "35–49", "50–64", "65+"],
        ["age_18_34_pct", "age_35_49_pct", "age_50_64_pct", "age_65_plus_pct"],
    )
    d = "COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)"
    v8 = f"""SELECT COUNT(DISTINCT member_id) AS members, COUNT(*) AS total_claims,
       {sum_m("CASE WHEN claim_status = 'PAID' THEN paid_amount END")} AS paid_spend,
       {pct(d, "COUNT(*)")} AS denial_rate_pct
FROM claims"""
    return {
        "v1_pareto_curve": w(v1),
        "v2_top_share": w(v2),
        "v3_spend_by_claim_type": w(v3),
        "v4_unit_cost_by_claim_type": w(v4),
        "v5_cost_segments": w(v5),
        "v5b_high_cost_claims": w(
            """SELECT claim_id, member_id, service_date, claim_type, CAST(paid_amount AS DOUBLE) AS paid_amount
FROM claims WHERE claim_status = 'PAID'
  AND member_id IN (SELECT member_id FROM seg WHERE segment = 'High-Cost')"""
        ),
        "v6_segment_claim_type_mix": w(v6),
        "v7_segment_age_mix": w(v7),
        "v8_headline_counts": with_claims(v8),
    }


# ---------------------------------------------------------------------------
# Text tasks
# ---------------------------------------------------------------------------
def _bucket_sql(col: str, seed: str, modulus: str = "100") -> str:
    return f"((('0x' || substr(md5('{seed}:' || {col}), 1, 8))::BIGINT) % {modulus})"


# what a reader files each note under: stated by hand, not derived from the rules
LABELLED_NOTES = [
    ("No prior authorization on file for this stay", "AUTHORIZATION_MISSING", 0.95),
    ("Same claim was already processed", "DUPLICATE_CLAIM", 0.95),
    ("Patient not covered on the date of care", "ELIGIBILITY_ISSUE", 0.9),
    ("Billed code conflicts with the diagnosis", "CODING_ERROR", 0.85),
    ("Claim was filed after the deadline", "TIMELY_FILING", 0.95),
    ("Records do not support medical necessity", "MEDICAL_NECESSITY", 0.9),
    ("Barcode unreadable, please send again", "OTHER", 0.5),
    ("Precert required before the visit", "AUTHORIZATION_MISSING", 0.95),
    ("Looks like a duplicate of an earlier bill", "DUPLICATE_CLAIM", 0.95),
    ("Member ineligible that month", "ELIGIBILITY_ISSUE", 0.9),
    ("Modifier missing on line two", "CODING_ERROR", 0.85),
    ("Received past the timely filing window", "TIMELY_FILING", 0.95),
    ("Treatment judged not medically necessary", "MEDICAL_NECESSITY", 0.9),
    ("Zip code of the provider is missing", "OTHER", 0.5),
    ("Authorization missing for the second unit", "AUTHORIZATION_MISSING", 0.95),
    ("Visit already paid last month", "DUPLICATE_CLAIM", 0.95),
    ("Coverage had lapsed by then", "ELIGIBILITY_ISSUE", 0.9),
    ("CPT codes unbundled", "CODING_ERROR", 0.85),
    ("Submitted too late", "TIMELY_FILING", 0.95),
    ("Not clinically indicated", "MEDICAL_NECESSITY", 0.9),
    ("Reconsideration of units asked for", "OTHER", 0.5),
    ("Stay was not authorised by the plan", "AUTHORIZATION_MISSING", 0.95),
    ("Line already submitted under another number", "DUPLICATE_CLAIM", 0.95),
    ("No longer enrolled with this plan", "ELIGIBILITY_ISSUE", 0.9),
    ("Wrong code for the procedure room", "CODING_ERROR", 0.85),
    ("Late submission by the clinic", "TIMELY_FILING", 0.95),
    ("Experimental therapy", "MEDICAL_NECESSITY", 0.9),
    ("Signature illegible", "OTHER", 0.5),
    ("Unauthorized out of network visit", "AUTHORIZATION_MISSING", 0.95),
    ("Duplicates found on this account", "DUPLICATE_CLAIM", 0.95),
    ("Eligibility could not be shown", "ELIGIBILITY_ISSUE", 0.9),
    ("Coding review failed", "CODING_ERROR", 0.85),
    ("Sent beyond the filing limit", "TIMELY_FILING", 0.95),
    ("Medically unnecessary scan", "MEDICAL_NECESSITY", 0.9),
    ("Please call the provider desk", "OTHER", 0.5),
    ("Auth not obtained in time", "AUTHORIZATION_MISSING", 0.95),
    ("Encounter was billed twice", "DUPLICATE_CLAIM", 0.95),
    ("Coverage terminated in spring", "ELIGIBILITY_ISSUE", 0.9),
    ("Invalid diagnosis pointer", "CODING_ERROR", 0.85),
    ("Missed the deadline by ten days", "TIMELY_FILING", 0.95),
    ("Test not necessary at this stage", "MEDICAL_NECESSITY", 0.9),
    ("Attachment page three is blank", "OTHER", 0.5),
    ("Referral missing from the packet", "AUTHORIZATION_MISSING", 0.95),
    ("Already been adjudicated in May", "DUPLICATE_CLAIM", 0.95),
    ("Person is not a member here", "ELIGIBILITY_ISSUE", 0.9),
    ("Revenue code absent", "CODING_ERROR", 0.85),
    ("Filed late without a reason", "TIMELY_FILING", 0.95),
    ("Medical necessity not shown", "MEDICAL_NECESSITY", 0.9),
    ("Bank details changed", "OTHER", 0.5),
    ("No referral from the family doctor", "AUTHORIZATION_MISSING", 0.95),
    ("Already billed by the partner clinic", "DUPLICATE_CLAIM", 0.95),
    ("Patient without coverage", "ELIGIBILITY_ISSUE", 0.9),
    ("Codes do not fit together", "CODING_ERROR", 0.85),
    ("Filing period over", "TIMELY_FILING", 0.95),
    ("Not indicated for this condition", "MEDICAL_NECESSITY", 0.9),
    ("Provider moved to a new address", "OTHER", 0.5),
    ("Pre-certification number absent", "AUTHORIZATION_MISSING", 0.95),
    ("Possible duplicate line item", "DUPLICATE_CLAIM", 0.95),
    ("Coverage was inactive", "ELIGIBILITY_ISSUE", 0.9),
    ("Mismatch diagnosis and service", "CODING_ERROR", 0.85),
    ("Received late in the year", "TIMELY_FILING", 0.95),
    ("Considered experimental by the panel", "MEDICAL_NECESSITY", 0.9),
    ("Unit count under review", "OTHER", 0.5),
]


def text_sql() -> dict[str, str]:
    n = len(LABELLED_NOTES)
    rows = ", ".join(f"({i}, '{t}', '{c}', {v}::DOUBLE)" for i, (t, c, v) in enumerate(LABELLED_NOTES))
    ctes = f"""
labelled(place, note, category, confidence) AS (VALUES {rows}),
classified AS (
  SELECT claim_id, service_date, note, category, confidence
  FROM claims JOIN labelled ON place = (_orderkey * 7 + _linenumber) % {n}
  WHERE claim_status = 'DENIED'
)"""
    t2 = with_claims("SELECT * FROM classified", ctes)
    u1 = with_claims(
        """SELECT claim_id, service_date, note, CASE WHEN length(note) < 25 THEN 'SHORT' ELSE 'LONG' END AS category,
       least(length(note), 50) / 50.0::DOUBLE AS confidence FROM classified""",
        ctes,
    )
    t3 = with_claims(
        """SELECT strftime(service_date, '%Y-%m') AS service_month, category, COUNT(*) AS denials
FROM classified GROUP BY 1, 2""",
        ctes,
    )
    b = _bucket_sql("claim_id", "resp")
    t4 = with_claims(
        f"""SELECT claim_id,
       CASE WHEN {b} < 5 OR {b} BETWEEN 8 AND 17 THEN 'malformed' WHEN {b} < 8 THEN 'empty' ELSE 'ok' END AS parse_status,
       CASE WHEN {b} < 5 THEN '[{{"note": "' || note
            WHEN {b} BETWEEN 8 AND 9 THEN '{{"error":"rate limited"}}' WHEN {b} BETWEEN 10 AND 11 THEN '[null]'
            WHEN {b} BETWEEN 12 AND 13 THEN '[ {{"category" : "BANANA", "confidence": 0.7, "note":"' || note || '"}} ]'
            WHEN {b} BETWEEN 14 AND 15 THEN '[ {{"category" : "OTHER", "confidence": 7, "note":"' || note || '"}} ]'
            WHEN {b} BETWEEN 16 AND 17 THEN '[ {{"category" : "OTHER", "confidence": "high", "note":"' || note || '"}} ]' END AS raw,
       CASE WHEN {b} >= 18 THEN note END AS note,
       CASE WHEN {b} >= 60 THEN 'ELIGIBILITY_ISSUE' WHEN {b} >= 18 THEN 'CODING_ERROR' END AS category,
       CASE WHEN {b} >= 60 THEN 1.0::DOUBLE WHEN {b} >= 18 THEN 0.75::DOUBLE END AS confidence
FROM classified""",
        ctes,
    )
    t5 = with_claims(
        """SELECT claim_id, CAST(to_json(struct_pack(claim_id := claim_id,
                   paid_amount := CAST(paid_amount AS DOUBLE), claim_status := claim_status)) AS VARCHAR) AS record
FROM claims WHERE claim_status = 'DENIED' AND paid_amount > 0"""
    )
    code = "PAID_DENIED"
    cause = "A denied claim still carries money: status and amount were set by different steps."
    remedy = "Ask the payer which of the two is right, then correct the amount or the status."
    t6 = with_claims(
        f"""SELECT '{code}' AS anomaly_code, claim_id, member_id, CAST(paid_amount AS DOUBLE) AS paid_amount,
       '{cause}' AS likely_cause, '{remedy}' AS remediation
FROM claims WHERE claim_status = 'DENIED' AND paid_amount > 0"""
    )
    d = "COUNT(CASE WHEN claim_status = 'DENIED' THEN 1 END)"
    ip = "CASE WHEN claim_type = 'IP' THEN paid_amount END"
    bh = "CASE WHEN provider_type = 'BEHAVIORAL' THEN paid_amount END"
    metrics = f"""m AS (
  SELECT COUNT(*) AS total_claims,
         COUNT(CASE WHEN claim_status = 'PAID' THEN 1 END) AS paid_claims,
         {d} AS denied_claims, {pct(d, "COUNT(*)")} AS denial_rate_pct,
         {sum_m("billed_amount")} AS total_billed, {sum_m("paid_amount")} AS total_paid,
         {avg_m(ip)} AS inpatient_avg_paid, {sum_m(bh)} AS behavioral_health_spend,
         COUNT(CASE WHEN claim_status = 'DENIED' AND paid_amount > 0 THEN 1 END) AS anomalies
  FROM claims
)"""
    money = lambda c: f"'$' || format('{{:,.2f}}', {c})"
    t1 = with_claims(
        f"""SELECT *, denial_rate_pct > 10.0 AS denial_attention, anomalies > 0 AS anomaly_attention,
  concat_ws(' ',
    format('{{:,}}', total_claims) || ' claims processed: ' || format('{{:,}}', paid_claims) || ' paid, '
      || format('{{:,}}', denied_claims) || ' denied (' || format('{{:,.2f}}', denial_rate_pct) || '% denial rate).',
    'Paid ' || {money("total_paid")} || ' of ' || {money("total_billed")} || ' billed.',
    'Inpatient claims average ' || COALESCE({money("inpatient_avg_paid")}, 'n/a')
      || '; behavioral health spend is ' || COALESCE({money("behavioral_health_spend")}, '$0.00') || '.',
    CASE WHEN denial_rate_pct > 10.0 THEN 'Attention: denial rate is above 10%.' END,
    CASE WHEN anomalies > 0 THEN 'Attention: ' || format('{{:,}}', anomalies) || ' denied claims show a payment.' END
  ) AS summary_text
FROM m""",
        metrics,
    )
    return {
        "t1_executive_summary": t1,
        "t2_denial_note_categories": t2,
        "t2_trained_note_categories": with_claims("SELECT claim_id, service_date, note, category FROM classified", ctes),
        "t3_trained_category_trend": t3,
        "u1_scored_notes": u1,
        "t3_denial_category_trend": t3,
        "t4_parse_classifications": t4,
        "t5_anomaly_payload": t5,
        "t6_explain_anomalies": t6,
    }
