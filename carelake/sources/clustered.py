"""Claims in a space-filling order, so that few row groups hold what a question asks for.

Rows are sorted along a Z curve over state, service date and member: each column
is cut into at most ``2 ** BITS`` ranges of about as many rows, and the bits of
the three range numbers are interleaved. Files are ranges of that order, so the
minima and maxima in a file's footer are narrow in all three columns at once, and
a filter on any of them skips most row groups. Claim ids are spread over all
files by this; a Parquet Bloom filter on ``claim_id`` finds a claim's row group.

The cuts come from ``SAMPLE`` rows in hash order: they decide where a row lies,
never whether it is found. Rows of one place on the curve are ordered by claim
id, so a member or day with very many claims is many files.

Null values go to the first range; repeated rows stay; an empty table is one
without rows; further columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import freed_shuffles
from carelake.sources.files import read_layout

CURVE = ("state_code", "service_date", "member_id")
KEY = "claim_id"
PLACE = "_place"
BITS, SAMPLE = 6, 10_000
ROWS_PER_FILE = 1_000_000
#: Ids that are looked up as literals (they reach the Bloom filters); more are joined.
MOST_IDS = 500
#: Values of one IN that Spark hands to Parquet one by one; a longer IN is pushed as a range only.
IN_VALUES = 10


def curve_cuts(rows: DataFrame, columns: Sequence[str] = CURVE, bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """Bounds that cut every column into ranges of about as many rows; a frequent value is one bound only."""
    some = rows.select(*columns, F.xxhash64(KEY).alias("_h")).orderBy("_h", *columns).limit(sample).collect()  # ``sample`` rows at most
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in some if r[c] is not None)
        cuts[c] = sorted({values[len(values) * j >> bits] for j in range(1, 1 << bits)}) if values else []
    return cuts


def range_number(column: Column, cuts: Sequence) -> Column:
    """How many of the sorted bounds a value reaches, by halving: as many comparisons as the number has bits."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])  # folded to one literal
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    # a step past the last bound compares with null and isn't taken
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= column, at + step).otherwise(at))
    return F.when(column.isNull(), 0).otherwise(reached)


def curve_place(cuts: dict[str, list], bits: int = BITS) -> Column:
    """Place on the Z curve: the bits of the range numbers by turns, the highest first. A column of few ranges has them
    spread over all its bits, so that its highest bits part the rows too."""
    return _place_of([(range_number(F.col(c), bounds), len(bounds)) for c, bounds in cuts.items()], bits)


def _place_of(numbers: Sequence[tuple[Column, int]], bits: int) -> Column:
    """Range numbers, each with the number of its bounds, as one place."""
    place = F.lit(0).cast("long")
    for i, (found, bounds) in enumerate(numbers):
        number = F.floor(found * (1 << bits) / (bounds + 1)).cast("long")
        for k in range(bits):
            bit = F.shiftright(number, k).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, k * len(numbers) + len(numbers) - 1 - i))
    return place


def with_place(rows: DataFrame, cuts: dict[str, list], bits: int = BITS) -> DataFrame:
    """``rows`` with their place on the curve as a column: ranges, bits and place are projections of their own, so that
    a row's range of a column is sought once and not once a bit, and the order reads a value."""
    numbers = {f"_range{i}": range_number(F.col(c), bounds) for i, (c, bounds) in enumerate(cuts.items())}
    ranges = {f"_range{i}": len(bounds) for i, bounds in enumerate(cuts.values())}
    return rows.withColumns(numbers).withColumn(PLACE, _place_of([(F.col(c), n) for c, n in ranges.items()], bits)).drop(*numbers)


def write_clustered(rows: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, bloom: bool = True) -> None:
    """Write claims along the curve, with Bloom filters on the claim id."""
    with freed_shuffles(rows.sparkSession):
        files = max(1, -(-rows.count() // rows_per_file))
        placed = with_place(rows, curve_cuts(rows))
        ordered = placed.repartitionByRange(files, PLACE, KEY).sortWithinPartitions(PLACE, KEY).drop(PLACE)
        writer = ordered.write.mode("overwrite").option("maxRecordsPerFile", 2 * rows_per_file)
        if bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{KEY}", "true").option(f"parquet.bloom.filter.expected.ndv#{KEY}", str(rows_per_file))
        writer.parquet(path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return read_layout(spark, path)


def members_of_states(rows: DataFrame, states: Sequence[str], since: str, until: str) -> DataFrame:
    """PAID claims and their sum by member, for some states and a span of service dates (both ends included)."""
    asked = F.col("state_code").isin(list(states)) & F.col("service_date").between(date.fromisoformat(since), date.fromisoformat(until))
    return (
        rows.where(asked & (F.col("claim_status") == "PAID"))
        .groupBy("state_code", "member_id")
        .agg(F.count("*").alias("claims"), F.sum("paid_amount").alias("total_paid"), F.max("service_date").alias("last_claim"))
    )


def claims_of_ids(rows: DataFrame, ids: DataFrame | Iterable[str]) -> DataFrame:
    """Rows of the claims named, each once however often it is named; ``ids``: values, or a table with claim_id.

    Up to ``MOST_IDS`` go into the scan as literals, ten to an IN, so that Bloom filters skip row groups; more are a semi-join.
    """
    if isinstance(ids, DataFrame):
        named = ids.select(KEY).where(F.col(KEY).isNotNull()).distinct()
        few = [r[0] for r in named.limit(MOST_IDS + 1).collect()]
        if len(few) > MOST_IDS:
            return rows.join(named, KEY, "left_semi").select(*rows.columns)
    else:
        few = [i for i in set(ids) if i is not None]
        if len(few) > MOST_IDS:
            return claims_of_ids(rows, rows.sparkSession.createDataFrame([(i,) for i in few], f"{KEY} string"))
    if not few:
        return rows.limit(0)
    few = sorted(few)
    groups = [F.col(KEY).isin(few[at : at + IN_VALUES]) for at in range(0, len(few), IN_VALUES)]
    while len(groups) > 1:  # by pairs: a flat plan for any number
        groups = [reduce(Column.__or__, groups[at : at + 2]) for at in range(0, len(groups), 2)]
    return rows.where(groups[0])
