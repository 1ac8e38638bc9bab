"""Money, ratio and percentage expressions.

Amounts are DECIMAL(18,4) end to end so sums are exact. Every ratio (average,
rate, percentage) is rounded HALF_UP by exact integer division rather than by
rounding a floating-point quotient, so a value such as 1899.90 / 2000 gives
0.9500 and not 0.9499. Results are reported as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.schema import MONEY

# money carries four decimals: 1 unit = 10^-4
MONEY_UNIT = 10_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_money(c: Column | str) -> Column:
    """Parse or widen to DECIMAL(18,4); text that is not a number gives null."""
    return _col(c).try_cast(MONEY)


def round_money(c: Column, scale: int = 2) -> Column:
    """Round a decimal HALF_UP, then report it as DOUBLE."""
    return F.round(c, scale).cast("double")


def sum_money(c: Column | str, scale: int = 2) -> Column:
    if isinstance(c, str):
        return F.expr(f"CAST(round(sum(`{c}`), {scale}) AS DOUBLE)")
    return round_money(F.sum(c), scale)


def ratio_sql(
    num: str, den: str, scale: int = 2, factor: int = 1, num_unit: int = 1, den_unit: int = 1
) -> str:
    """SQL text of ``exact_ratio`` for SQL operands (e.g. ``sum(paid_amount)``).

    One expression string is one JVM call, where the Column form takes a few
    dozen; results are identical.
    """
    f = (10**scale) * factor
    n = f"CAST(({num}) * {num_unit} AS DECIMAL(38,0))"
    d = f"CAST(({den}) * {den_unit} AS DECIMAL(38,0))"
    q = f"((abs({n}) * {2 * f} + abs({d})) div (abs({d}) * 2))"
    return (
        f"CASE WHEN {d} = 0 THEN NULL WHEN ({n} < 0) <> ({d} < 0) "
        f"THEN -{q} / {10**scale} ELSE {q} / {10**scale} END"
    )


def exact_ratio(
    num: Column | str,
    den: Column | str,
    scale: int = 2,
    factor: int = 1,
    num_unit: int = 1,
    den_unit: int = 1,
) -> Column:
    """round_half_up(factor * num / den, scale) as DOUBLE; null if den is 0.

    ``num * num_unit`` and ``den * den_unit`` must be whole numbers (counts,
    or money times MONEY_UNIT). The quotient is formed by integer division of
    DECIMAL(38,0) values, so it is exact at any data size. Operands may be
    Columns or SQL text.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(ratio_sql(num, den, scale, factor, num_unit, den_unit))
    num_c = F.expr(num) if isinstance(num, str) else num
    den_c = F.expr(den) if isinstance(den, str) else den
    f = (10**scale) * factor
    n = (num_c * F.lit(num_unit)).cast("decimal(38,0)")
    d = (den_c * F.lit(den_unit)).cast("decimal(38,0)")
    an, ad = F.abs(n), F.abs(d)
    q = F.call_function("div", an * F.lit(2 * f) + ad, ad * F.lit(2))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed / F.lit(10**scale))


def avg_money(c: Column | str, scale: int = 2) -> Column:
    """AVG of a money column, HALF_UP to ``scale`` decimals, as DOUBLE."""
    if isinstance(c, str):
        return exact_ratio(f"sum(`{c}`)", f"count(`{c}`)", scale, 1, MONEY_UNIT, MONEY_UNIT)
    return exact_ratio(F.sum(c), F.count(c), scale, num_unit=MONEY_UNIT, den_unit=MONEY_UNIT)


def money_per(total: Column | str, count: Column | str, scale: int = 2) -> Column:
    """A money total divided by a count (e.g. paid per member)."""
    return exact_ratio(total, count, scale, num_unit=MONEY_UNIT, den_unit=MONEY_UNIT)


def pct(
    numerator: Column | str, denominator: Column | str, scale: int = 2, unit: int = 1
) -> Column:
    """100 * num / den, HALF_UP to ``scale`` decimals; null if den is 0."""
    return exact_ratio(numerator, denominator, scale, 100, unit, unit)


def sum_money_sql(expr: str, scale: int = 2) -> Column:
    """Rounded DOUBLE sum of a SQL money expression."""
    return F.expr(f"CAST(round(sum({expr}), {scale}) AS DOUBLE)")


def avg_money_sql(expr: str, scale: int = 2) -> Column:
    """Exact HALF_UP average of a SQL money expression (nulls ignored)."""
    return exact_ratio(f"sum({expr})", f"count({expr})", scale, 1, MONEY_UNIT, MONEY_UNIT)


def count_where(predicate: Column) -> Column:
    """COUNT(CASE WHEN predicate THEN 1 END): rows where it is true."""
    return F.count(F.when(predicate, F.lit(1)))


def payment_rate(paid: str = "paid_amount", billed: str = "billed_amount") -> Column:
    """paid / billed to 4 dp when billed > 0, else 0.0 (DOUBLE)."""
    rate = ratio_sql(f"`{paid}`", f"`{billed}`", 4, 1, MONEY_UNIT, MONEY_UNIT)
    return F.expr(f"CASE WHEN `{billed}` > 0 THEN {rate} ELSE CAST(0.0 AS DOUBLE) END")
