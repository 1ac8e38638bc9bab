"""Row validation: every failed check becomes one error record; nothing is
dropped silently.

``check(raw)`` normalises and parses the row and adds one ``_invalid`` flag,
so valid rows, invalid rows, the exploded error log and the counts all come
from the same checked rows. ``errors()`` is the array of failed checks (one
struct per check), evaluated only where consumed. The checks, in reporting
order:

    MALFORMED_ROW         too few or too many fields         "Malformed row"
    NULL_VALUE            a required field is null           "Null in <field>"
    UNKNOWN_CLAIM_TYPE    claim_type not in the code list    "Unknown claim_type: <v>"
    UNKNOWN_CLAIM_STATUS  claim_status not in the code list  "Unknown claim_status: <v>"
    NON_NUMERIC           amount does not parse as a number  "Non-numeric <field>"
    BAD_DATE              service_date present, not a date   "Bad date in service_date: <v>"

A null claim_type or status fails both the null and the code-list check, and a
null amount both the null and the numeric check, as in the row-by-row original.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from carelake.functions.dates import parse_date
from carelake.functions.money import as_money
from carelake.schema import (
    AMOUNT_FIELDS,
    CLAIM_STATUSES,
    CLAIM_TYPES,
    CORRUPT,
    LINE_KIND,
    NA_TOKENS,
    PLACE_FIELDS,
    RAW_FIELDS,
    REQUIRED_FIELDS,
)


# fixed values: how a missing value is printed inside a message
MISSING_TEXT = "nan"


class SchemaError(ValueError):
    """The input lacks required columns; raised before any job runs."""


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_FIELDS) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"Missing required columns: {missing}")


def _sql_list(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _missing_to_null(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> dict[str, Column]:
    """Per column: the value, or null when it is a missing-value token.

    Written as SQL expression text: one JVM call per column instead of one
    per token literal.
    """
    toks = _sql_list(tokens)
    types = dict(df.dtypes)
    return {
        c: (
            F.expr(f"CASE WHEN `{c}` IN ({toks}) THEN CAST(NULL AS STRING) ELSE `{c}` END")
            if types[c] == "string"
            else F.col(c)
        )
        for c in df.columns
    }


# parsed copies of the typed fields, computed once and reused by the checks
# and by the typed output
PARSED = {"billed_amount": "_billed", "paid_amount": "_paid", "service_date": "_date"}
INVALID = "_invalid"


def rules(with_corrupt: bool = False) -> list[tuple[str, str, str, str]]:
    """(failure condition, rule, field, message) for every check, in order,
    as SQL expressions over the normalised row. ``with_corrupt``: the scan
    kept the text of rows with a wrong number of fields."""
    shown = lambda f: f"coalesce(CAST(`{f}` AS STRING), '{MISSING_TEXT}')"
    out = []
    if with_corrupt:
        out.append((f"`{CORRUPT}` IS NOT NULL", "MALFORMED_ROW", CORRUPT, "'Malformed row'"))
    out += [(f"`{c}` IS NULL", "NULL_VALUE", c, f"'Null in {c}'") for c in REQUIRED_FIELDS]
    out.append(
        (
            f"NOT coalesce(claim_type IN ({_sql_list(CLAIM_TYPES)}), false)",
            "UNKNOWN_CLAIM_TYPE",
            "claim_type",
            f"concat('Unknown claim_type: ', {shown('claim_type')})",
        )
    )
    out.append(
        (
            f"NOT coalesce(claim_status IN ({_sql_list(CLAIM_STATUSES)}), false)",
            "UNKNOWN_CLAIM_STATUS",
            "claim_status",
            f"concat('Unknown claim_status: ', {shown('claim_status')})",
        )
    )
    for c in AMOUNT_FIELDS:
        out.append((f"`{PARSED[c]}` IS NULL", "NON_NUMERIC", c, f"'Non-numeric {c}'"))
    out.append(
        (
            f"service_date IS NOT NULL AND `{PARSED['service_date']}` IS NULL",
            "BAD_DATE",
            "service_date",
            "concat('Bad date in service_date: ', service_date)",
        )
    )
    return out


def _invalid_expr(checks) -> Column:
    return F.expr(" OR ".join(f"({cond})" for cond, *_ in checks))


def _error_array(checks) -> Column:
    items = ", ".join(
        f"CASE WHEN {cond} THEN named_struct('rule', '{rule}', 'field', '{field}', "
        f"'bad_value', CAST(`{field}` AS STRING), 'error', {msg}) END"
        for cond, rule, field, msg in checks
    )
    return F.expr(f"filter(array({items}), e -> e IS NOT NULL)")


def check(raw: DataFrame) -> DataFrame:
    """Raw (text) claims, normalised, with parsed amounts / date and the
    ``_invalid`` flag (one boolean OR of the rule conditions). Two
    projections; the per-check error records come from ``errors()``.
    """
    require_columns(raw)
    norm = _missing_to_null(raw)
    for c in (CORRUPT, LINE_KIND, *PLACE_FIELDS):
        if c in norm:
            norm[c] = F.col(c)  # kept as it is
    normalized = raw.select(
        *[e.alias(c) for c, e in norm.items()],
        as_money(norm["billed_amount"]).alias(PARSED["billed_amount"]),
        as_money(norm["paid_amount"]).alias(PARSED["paid_amount"]),
        parse_date(norm["service_date"]).alias(PARSED["service_date"]),
    )
    invalid = _invalid_expr(rules(CORRUPT in raw.columns))
    if LINE_KIND in raw.columns:  # header and blank lines are no rows: neither valid nor invalid
        invalid = F.when(F.col(LINE_KIND) == "row", invalid)
    return normalized.select("*", invalid.alias(INVALID))


def errors(checked: DataFrame) -> Column:
    """The array of failed checks of a checked row (empty when valid).

    An expression, not a stored column: it is evaluated only where it is
    consumed (error log, error counts), i.e. on invalid rows, and a
    checkpoint of the checked rows never materialises it.
    """
    return _error_array(rules(CORRUPT in checked.columns))


def is_valid() -> Column:
    return ~F.col(INVALID)


def typed(valid_text: DataFrame) -> DataFrame:
    """Cast validated text rows to the typed claim layout (reusing the
    values parsed during the check when present)."""
    out = []
    for c in RAW_FIELDS:
        if c in PARSED and PARSED[c] in valid_text.columns:
            out.append(F.col(PARSED[c]).alias(c))
        elif c == "service_date":
            out.append(parse_date(F.col(c)).alias(c))
        elif c in AMOUNT_FIELDS:
            out.append(as_money(c).alias(c))
        elif c in valid_text.columns:
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.lit(None).cast("string").alias(c))
    return valid_text.select(*out)


def valid_claims(checked: DataFrame) -> DataFrame:
    """Rows without errors, typed."""
    return typed(checked.filter(is_valid()))


def validation_errors(checked: DataFrame) -> DataFrame:
    """One row per (claim, failed check): claim_id, rule, field, bad_value,
    error, plus the row's place when the raw scan carried it (see
    ``sources.files.number_lines`` for its line)."""
    cols = [F.col("claim_id"), F.inline(errors(checked))]
    cols += [F.col(c) for c in PLACE_FIELDS if c in checked.columns]
    return checked.filter(~is_valid()).select(*cols)


def observe_counts(checked: DataFrame, name: str = "load_counts") -> tuple[DataFrame, Observation]:
    """Attach raw / valid / invalid row and error counts, filled by the next action.

    No extra job: the counts ride along with whatever action consumes the
    returned DataFrame (e.g. the curated write).
    """
    obs = Observation(name)
    observed = checked.observe(
        obs,
        F.count(INVALID).alias("rows_raw"),
        F.count_if(is_valid()).alias("rows_valid"),
        F.count_if(~is_valid()).alias("rows_invalid"),
        F.sum(F.when(~is_valid(), F.size(errors(checked)))).alias("errors"),
    )
    return observed, obs


def quality_counts(checked: DataFrame) -> DataFrame:
    """The same counts as a one-row DataFrame."""
    return checked.agg(
        F.count(INVALID).alias("rows_raw"),
        F.count_if(is_valid()).alias("rows_valid"),
        F.count_if(~is_valid()).alias("rows_invalid"),
        F.coalesce(F.sum(F.when(~is_valid(), F.size(errors(checked)))), F.lit(0))
        .cast("long")
        .alias("error_count"),
    )
