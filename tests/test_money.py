"""Exact ratio helpers: SQL-text and Column forms against Python decimals."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from carelake.functions.money import MONEY_UNIT, exact_ratio, payment_rate


def _expected(n, d, scale, factor):
    if n is None or d is None or d == 0:
        return None
    q = Decimal(factor) * Decimal(n) / Decimal(d)
    return float(q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


def test_exact_ratio_forms_agree(spark):
    rnd = random.Random(5)
    rows = [
        (Decimal(rnd.randint(-10**8, 10**8)) / 10000, Decimal(rnd.randint(-10**6, 10**6)) / 10000)
        for _ in range(400)
    ]
    rows += [(Decimal("1899.9000"), Decimal("2000.0000")), (Decimal("1"), Decimal("0")), (None, Decimal("3"))]
    df = spark.createDataFrame(rows, "n decimal(18,4), d decimal(18,4)")
    out = df.select(
        "n",
        "d",
        exact_ratio("n", "d", 4, 1, MONEY_UNIT, MONEY_UNIT).alias("sql4"),
        exact_ratio(F.col("n"), F.col("d"), 4, num_unit=MONEY_UNIT, den_unit=MONEY_UNIT).alias("col4"),
        exact_ratio("n", "d", 2, 100, MONEY_UNIT, MONEY_UNIT).alias("pct2"),
    ).collect()
    for r in out:
        assert r.sql4 == r.col4 == _expected(r.n, r.d, 4, 1), r
        assert r.pct2 == _expected(r.n, r.d, 2, 100), r
    tie = [r for r in out if r.n == Decimal("1899.9000")][0]
    assert tie.sql4 == 0.95  # 0.94995 rounds half up, not down as a DOUBLE quotient would


def test_payment_rate_guards(spark):
    df = spark.createDataFrame(
        [(Decimal("80"), Decimal("100")), (Decimal("5"), Decimal("0")), (Decimal("5"), Decimal("-5"))],
        "paid_amount decimal(18,4), billed_amount decimal(18,4)",
    )
    assert [r.rate for r in df.select(payment_rate().alias("rate")).collect()] == [0.8, 0.0, 0.0]
