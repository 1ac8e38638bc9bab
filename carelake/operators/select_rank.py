"""Values at given ranks by narrowing value ranges with counts: no sort, nothing written.

The range from the smallest to the largest value is cut into ``bins`` equal
parts; one aggregate counts the rows of each part, and the part that holds the
rank becomes the next range. Each scan divides the range by ``bins``, so two or
three scans reach single values (a range of R units takes log(R) / log(bins)).
The driver sees at most ``bins`` counts a rank and scan, whatever the table.

Values are whole numbers or decimals (scaled to whole units, so all steps are
exact). Null values are left out; ties are one value; no values give null.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
_UNITS = "decimal(38,0)"


def _scale(df: DataFrame, value: str) -> int:
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return 0
    raise TypeError(f"{value} is {kind.simpleString()}: whole numbers and decimals only")


def values_at(df: DataFrame, value: str, ranks: list[int], bins: int = BINS, total: tuple[int, int] | None = None) -> list[int]:
    """The values at ``ranks`` (from 0, in ascending order), in units of the column's scale.

    ``total``: smallest and largest value, if known (both in units).
    """
    units = df.filter(F.col(value).isNotNull()).select((F.col(value) * F.lit(10 ** _scale(df, value))).cast(_UNITS).alias("u"))
    if total is None:
        ends = units.agg(F.min("u"), F.max("u")).first()
        total = int(ends[0]), int(ends[1])
    # rank -> (range, number of values below it)
    state = {r: (*total, 0) for r in ranks}
    while True:
        open_ = sorted({(lo, hi, below) for lo, hi, below in state.values() if lo < hi})
        if not open_:
            return [state[r][0] for r in ranks]
        place, widths = None, []
        for i, (lo, hi, _) in enumerate(open_):  # disjoint ranges, at most one a rank
            width = -(-(hi - lo + 1) // bins)
            widths.append(width)
            bin_ = F.struct(F.lit(i).alias("i"), F.expr(f"CAST((u - {lo}) DIV {width} AS INT)").alias("b"))
            inside = F.col("u").between(F.lit(Decimal(lo)), F.lit(Decimal(hi)))
            place = F.when(inside, bin_) if place is None else place.when(inside, bin_)
        held = units.select(place.alias("p")).filter("p IS NOT NULL").groupBy("p.i", "p.b").count().collect()  # bins x ranks rows at most
        counts: dict[int, dict[int, int]] = {}
        for r in held:
            counts.setdefault(r.i, {})[r.b] = r["count"]
        for rank, (lo, hi, below) in state.items():
            if lo == hi:
                continue
            i = open_.index((lo, hi, below))
            for b in sorted(counts[i]):
                if below + counts[i][b] > rank:
                    start = lo + b * widths[i]
                    state[rank] = (start, min(hi, start + widths[i] - 1), below)
                    break
                below += counts[i][b]


def median_by_counts(df: DataFrame, value: str, bins: int = BINS) -> Decimal | None:
    """Exact median of a column (the mean of the middle two for an even count); None without values."""
    scale = _scale(df, value)
    units = (F.col(value) * F.lit(10**scale)).cast(_UNITS)
    facts = df.agg(F.count(value), F.min(units), F.max(units)).first()
    n = facts[0]
    if not n:
        return None
    low, high = values_at(df, value, [(n - 1) // 2, n // 2], bins, (int(facts[1]), int(facts[2])))
    return (Decimal(low + high) / 2).scaleb(-scale)
