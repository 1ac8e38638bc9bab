"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.schema import DATE_FORMAT


def parse_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Text -> DATE; text that is not a valid date gives null (no ANSI error)."""
    return F.try_to_date(c, fmt)


def month_label(c: Column) -> Column:
    """'yyyy-MM' text label of a date (STRFTIME('%Y-%m', d))."""
    return F.date_format(c, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
