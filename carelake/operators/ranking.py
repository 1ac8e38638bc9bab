"""Global rank and running sum without a single-partition window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
``global_running`` gives the same row numbers and running sums in three
distributed steps:

1. ``repartitionByRange`` on the full sort key (value and the tie-breaking
   id), so each partition holds one contiguous range of the global order and
   equal values are split across partitions by id. ``spark_partition_id``
   then names the range ("band"). The banded rows are written once, so a
   row's band is a stored value: no later plan can cut the ranges anew.
2. Per band, a window gives the local row number and running sum.
3. Per band, the row count and sum; a window over these band rows (at most
   ``bands`` of them, a bound fixed by the caller) gives the offsets of all
   earlier bands, broadcast back and added.

The result equals ROW_NUMBER() / SUM() OVER (ORDER BY value, id) exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import written

BAND = "_band"


def default_bands(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, n)


def _order(value: str, key: str, descending: bool) -> list[Column]:
    v = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    return [v, F.col(key).asc_nulls_first()]


def global_running(
    df: DataFrame,
    value: str,
    key: str,
    descending: bool = True,
    bands: int | None = None,
    rank_col: str = "rank",
    running_col: str = "running",
    with_totals: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``rank_col`` (1-based position) and ``running_col`` (sum of
    ``value`` over all rows up to and including this one) in the order
    (value desc|asc, key asc). ``with_totals`` also adds ``total_rows`` and
    ``total_sum`` (the row count and sum of ``value`` over all rows).

    The output holds ``key``, ``value``, the columns named in ``carry`` and
    the new columns.
    """
    nb = bands or default_bands(df)
    order = _order(value, key, descending)
    banded = written(
        df.select(key, value, *carry)
        .repartitionByRange(nb, *order)
        .withColumn(BAND, F.spark_partition_id()),
        "bands",
    )

    w = Window.partitionBy(BAND).orderBy(*order)
    local = banded.withColumn("_band_rn", F.row_number().over(w)).withColumn(
        "_band_cum", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    per_band = local.groupBy(BAND).agg(
        F.max("_band_rn").alias("_n"), F.max_by("_band_cum", "_band_rn").alias("_s")
    )
    # at most ``nb`` rows: the windows below and the broadcast are bounded by
    # the band count, not by the data
    before = Window.orderBy(BAND).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = per_band.select(
        BAND,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_sum_before"),
        F.sum("_n").over(everything).alias("total_rows"),
        F.sum("_s").over(everything).alias("total_sum"),
    )
    out = (
        local.join(F.broadcast(offsets), BAND, "left")
        .withColumn(rank_col, F.col("_rows_before") + F.col("_band_rn"))
        .withColumn(running_col, F.col("_sum_before") + F.col("_band_cum"))
        .drop(BAND, "_band_rn", "_band_cum", "_rows_before", "_sum_before")
    )
    return out if with_totals else out.drop("total_rows", "total_sum")


def plain_running(
    df: DataFrame,
    value: str,
    key: str,
    descending: bool = True,
    rank_col: str = "rank",
    running_col: str = "running",
) -> DataFrame:
    """The single-window form (one partition); tests compare against it."""
    w = Window.orderBy(*_order(value, key, descending))
    return df.withColumn(rank_col, F.row_number().over(w)).withColumn(
        running_col, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def median_of_ranked(ranked: DataFrame, value: str) -> DataFrame:
    """One-row median of ``value`` from ``global_running`` rows with totals (no null values)."""
    n = F.col("total_rows")
    lo = F.floor((n - 1) / 2) + 1
    hi = F.floor(n / 2) + 1
    picked = ranked.filter((F.col("rank") == lo) | (F.col("rank") == hi))
    # lo == hi for odd counts: the one value counts twice, then halved
    weight = F.when(lo == hi, F.lit(2)).otherwise(F.lit(1))
    return picked.agg((F.sum(F.col(value) * weight) / F.lit(2)).alias("median"))


def exact_median(df: DataFrame, value: str, key: str, bands: int | None = None) -> DataFrame:
    """One-row DataFrame with the exact (interpolated) median of ``value``.

    The two middle positions are found with ``global_running`` ranks, so no
    task ever holds all values; for an even count the two middle values are
    averaged (as pandas and SQL MEDIAN do). Null values are ignored; no
    values give a null median.
    """
    vals = df.filter(F.col(value).isNotNull()).select(key, value)
    ranked = global_running(
        vals, value, key, descending=False, bands=bands, running_col="_r", with_totals=True
    )
    return median_of_ranked(ranked, value)
