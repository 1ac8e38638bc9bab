"""The reports as SQL table functions with parameters.

``create_report_functions`` defines them over a claims table or view, so that
SQL text calls a report as ``SELECT * FROM high_cost_members(top => 50)``. The
bodies are SQL: a call is planned with the query around it (filters on its
result, its parameters as literals), and nothing runs in Python.

    high_cost_members(threshold, top), all_high_cost_members(threshold)
    readmission_pairs(days)
    spend_by_state_plan()
    top_diagnoses_by_spend(top)
    denial_rate_by_provider()

The rows are those of the functions of the same names in ``plans.analytics``;
as with any table function, the caller states the order.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from carelake.functions.money import MONEY_UNIT, ratio_sql


def _avg(column: str) -> str:
    return ratio_sql(f"sum({column})", f"count({column})", 2, 1, MONEY_UNIT, MONEY_UNIT)


def _money(sql: str) -> str:
    return f"CAST(round({sql}, 2) AS DOUBLE)"


_PAID = "claim_status = 'PAID'"

#: name -> (parameters, columns of the result, body); {claims} is the table.
FUNCTIONS = {
    "high_cost_members": (
        "threshold DECIMAL(20,4) DEFAULT 5000, top INT DEFAULT 20",
        "member_id STRING, state_code STRING, total_claims BIGINT, inpatient_visits BIGINT, total_paid DOUBLE, avg_per_claim DOUBLE, most_recent_claim DATE",
        f"""SELECT member_id, state_code, total_claims, inpatient_visits, total_paid, avg_per_claim, most_recent_claim FROM (
  SELECT *, row_number() OVER (ORDER BY total_paid DESC, member_id, state_code) AS place FROM (
    SELECT member_id, state_code, count(*) AS total_claims, count_if(claim_type = 'IP') AS inpatient_visits,
      {_money("sum(paid_amount)")} AS total_paid, {_avg("paid_amount")} AS avg_per_claim, max(service_date) AS most_recent_claim
    FROM {{claims}} WHERE {_PAID} GROUP BY member_id, state_code HAVING sum(paid_amount) > threshold))
WHERE place <= top""",
    ),
    "all_high_cost_members": (
        "threshold DECIMAL(20,4) DEFAULT 5000",
        "member_id STRING, state_code STRING, total_claims BIGINT, inpatient_visits BIGINT, total_paid DOUBLE, avg_per_claim DOUBLE, most_recent_claim DATE",
        f"""SELECT member_id, state_code, count(*), count_if(claim_type = 'IP'), {_money("sum(paid_amount)")}, {_avg("paid_amount")}, max(service_date)
FROM {{claims}} WHERE {_PAID} GROUP BY member_id, state_code HAVING sum(paid_amount) > threshold""",
    ),
    # stays in bins of ``days``: the later one is in the bin of the first or in the next
    "readmission_pairs": (
        "days INT DEFAULT 30",
        "member_id STRING, first_admit STRING, first_admit_date DATE, readmit_claim STRING, readmit_date DATE, days_between INT",
        f"""SELECT a.member_id, a.claim_id, a.service_date, b.claim_id, b.service_date, datediff(b.service_date, a.service_date)
FROM (SELECT member_id, claim_id, service_date, floor(unix_date(service_date) / days) AS bin
      FROM {{claims}} WHERE claim_type = 'IP' AND {_PAID}) a
JOIN (SELECT member_id, claim_id, service_date, bin FROM (
        SELECT member_id, claim_id, service_date, floor(unix_date(service_date) / days) AS own
        FROM {{claims}} WHERE claim_type = 'IP' AND {_PAID}) LATERAL VIEW explode(array(own, own - 1)) x AS bin) b
  ON a.member_id = b.member_id AND a.bin = b.bin AND a.claim_id <> b.claim_id
 AND b.service_date > a.service_date AND datediff(b.service_date, a.service_date) <= days""",
    ),
    "spend_by_state_plan": (
        "",
        "state_code STRING, plan_id STRING, unique_members BIGINT, total_claims BIGINT, total_paid DOUBLE, pmpm_proxy DOUBLE",
        f"""SELECT state_code, plan_id, count(DISTINCT member_id), count(*), {_money("sum(paid_amount)")},
  {ratio_sql("sum(paid_amount)", "count(DISTINCT member_id)", 2, 1, MONEY_UNIT, MONEY_UNIT)}
FROM {{claims}} WHERE {_PAID} GROUP BY state_code, plan_id""",
    ),
    "top_diagnoses_by_spend": (
        "top INT DEFAULT 15",
        "diagnosis_code STRING, claim_count BIGINT, unique_members BIGINT, total_paid DOUBLE, avg_per_claim DOUBLE",
        f"""SELECT diagnosis_code, claim_count, unique_members, total_paid, avg_per_claim FROM (
  SELECT *, row_number() OVER (ORDER BY total_paid DESC, diagnosis_code ASC NULLS LAST) AS place FROM (
    SELECT diagnosis_code, count(*) AS claim_count, count(DISTINCT member_id) AS unique_members,
      {_money("sum(paid_amount)")} AS total_paid, {_avg("paid_amount")} AS avg_per_claim
    FROM {{claims}} WHERE {_PAID} GROUP BY diagnosis_code))
WHERE place <= top""",
    ),
    "denial_rate_by_provider": (
        "",
        "provider_type STRING, total_claims BIGINT, denied BIGINT, denial_rate_pct DOUBLE, total_underpaid DOUBLE",
        f"""SELECT provider_type, count(*), count_if(claim_status = 'DENIED'), {ratio_sql("count_if(claim_status = 'DENIED')", "count(1)", 2, 100)},
  {_money("sum(billed_amount) - sum(paid_amount)")}
FROM {{claims}} GROUP BY provider_type""",
    ),
}


def create_report_functions(spark: SparkSession, claims: str, prefix: str = "", temporary: bool = True) -> list[str]:
    """Define the functions over the table or view ``claims``; their names (with ``prefix``).

    Functions that are not temporary stay in the catalog and need a table there,
    not a temporary view.
    """
    names = []
    for name, (parameters, columns, body) in FUNCTIONS.items():
        kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {body.format(claims=claims)}")
        names.append(prefix + name)
    return names
