"""Claim files: CSV landing files, the curated parquet layer, SQL access.

Landing files are read as lines, by executors only: the driver lists names and
sees one row for each distinct header, never a file. Every file is bound by
its own header (``file_headers``), each line is parsed by that header's columns
(``read_raw_lines``), and a line keeps the place where it was read (file, split
and row), from which ``number_lines`` gives its number in the file.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.dates import parse_date
from carelake.functions.money import as_money
from carelake.operators.quality import SchemaError
from carelake.schema import CORRUPT, LINE_KIND, PLACE_FIELDS, RAW_FIELDS, REQUIRED_FIELDS, partition_schema
from carelake.session import written

_LINE, _HEADER = "_line", "_header"
#: A line with any character above the blank counts; others are blank.
_TEXT = r"[^\x00-\x20]"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of the files, blank ones too, with its place.

    ``source_row`` rises along the lines of a task, so within a split it is the
    line's place up to a constant.
    """
    return spark.read.text(path).select(
        F.col("value").alias(_LINE),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_split"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def file_headers(lines: DataFrame) -> DataFrame:
    """source_file and _header of every file with a line: its first line, or null if that lacks a required column.

    One aggregate on the executors. Only lines that name all required columns
    are gathered (one a file, as a rule); all others count by their place.
    """
    named = F.lit(True)
    for field in REQUIRED_FIELDS:
        named = named & F.col(_LINE).contains(field)
    first = lines.filter((F.col("source_split") == 0) & F.col(_LINE).rlike(_TEXT)).groupBy("source_file").agg(
        F.min("source_row").alias("first"),
        F.array_min(F.collect_set(F.when(named, F.struct("source_row", _LINE)))).alias("header"),
    )
    return first.select("source_file", F.when(F.col("header.source_row") == F.col("first"), F.col(f"header.{_LINE}")).alias(_HEADER))


def column_names(header: str) -> tuple[str, ...]:
    """The names of a header line, parsed as CSV (quoted names too)."""
    return tuple(c.strip() for c in next(csv.reader([header.lstrip("\ufeff")])))


def _checked_names(spark: SparkSession, header: str | None, file: str) -> tuple[str, ...]:
    if header is None:  # its own first line names what it lacks
        header = spark.read.text(file).filter(F.col("value").rlike(_TEXT)).first().value
    names = column_names(header)
    missing = [c for c in REQUIRED_FIELDS if c not in names]
    if missing:
        raise SchemaError(f"Missing required columns: {missing} in {file}")
    twice = [c for c, n in Counter(names).items() if n > 1]
    if twice:
        raise SchemaError(f"Repeated columns: {twice} in {file}")
    taken = [c for c in names if c in (_LINE, _HEADER, CORRUPT, LINE_KIND, *PLACE_FIELDS)]
    if taken:
        raise SchemaError(f"Reserved columns: {taken} in {file}")
    return names


def _parsed(line: Column, names: tuple[str, ...]) -> Column:
    """The line as a struct of the layout's columns; a null line is null."""
    quoted = ["`" + n.replace("`", "``") + "` STRING" for n in [*names, CORRUPT]]
    return F.from_csv(line, ", ".join(quoted), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All-text scan of every line: nothing is coerced before validation.

    ``line_kind`` is row, header or blank; fields are set in rows only. Every
    file is bound by its own header, so files with other column orders, or with
    quoted names, may share a folder. A file without a required column aborts
    before any row is parsed. A row with too few or too many fields keeps its
    text in ``_corrupt_record``, which the validation reports. A line equal to
    its file's header is a header wherever it stands (files put together keep
    the headers of their parts).

    The most frequent header is a literal of the plan; only files with another
    are looked up, in a table of one row for each of them whose size decides how
    it is joined.
    """
    lines = read_lines(spark, path)
    headers = written(file_headers(lines), "headers")  # a row for each file
    layouts = headers.groupBy(_HEADER).agg(F.count("*").alias("n"), F.min("source_file").alias("file")).collect()  # distinct headers
    if not layouts:
        raise SchemaError(f"empty input: {path}")
    layouts.sort(key=lambda r: (-r.n, r.file))
    by_names: dict[tuple[str, ...], list[str]] = {}
    for r in layouts:
        by_names.setdefault(_checked_names(spark, r[_HEADER], r.file), []).append(r[_HEADER])
    common = layouts[0][_HEADER]
    if len(layouts) == 1:
        bound = lines.withColumn(_HEADER, F.lit(common))
    else:
        others = headers.filter(F.col(_HEADER) != common)
        bound = lines.join(others, "source_file", "left").withColumn(_HEADER, F.coalesce(_HEADER, F.lit(common)))

    kind = F.when(~F.col(_LINE).rlike(_TEXT), "blank").when(F.col(_LINE) == F.col(_HEADER), "header").otherwise("row")
    kinds = bound.withColumn(LINE_KIND, kind)
    # one struct a layout, null for the lines of the others
    is_row = F.col(LINE_KIND) == "row"
    layouts_of = {f"_layout{i}": names for i, names in enumerate(by_names)}
    structs = [
        _parsed(F.when(is_row if len(by_names) == 1 else is_row & F.col(_HEADER).isin(by_names[names]), F.col(_LINE)), names).alias(c)
        for c, names in layouts_of.items()
    ]
    # a generator of one row: filters and expressions on fields stay above it, so a line is parsed once and not once a use of a field
    parsed = kinds.select("*", F.inline(F.array(F.struct(*structs))))
    named = {n for names in by_names for n in names}
    fields = [f for f in RAW_FIELDS if f in named] + sorted(named - set(RAW_FIELDS))
    held = {f: [F.col(c)[f] for c, names in layouts_of.items() if f in names] for f in fields} | {CORRUPT: [F.col(c)[CORRUPT] for c in layouts_of]}
    return parsed.select(*[F.coalesce(*of).alias(f) for f, of in held.items()], LINE_KIND, *PLACE_FIELDS)


def read_raw_csv(spark: SparkSession, path: str | list[str], with_source: bool = False) -> DataFrame:
    """The rows of ``read_raw_lines``; ``with_source`` keeps their places."""
    rows = read_raw_lines(spark, path).filter(F.col(LINE_KIND) == "row").drop(LINE_KIND)
    return rows if with_source else rows.drop(*PLACE_FIELDS)


def number_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``rows`` with ``source_line``, the number of their line in its file (from 1), instead of split and row.

    ``lines`` holds the places of all lines of the same read, header and blank
    ones too: give a written table, so that both see one reading. The lines of
    each split are counted, and summed up over the earlier splits of the file.
    Splits are one row each; their size decides how they are joined.
    """
    splits = lines.groupBy("source_file", "source_split").agg(F.min("source_row").alias("_first"), (F.max("source_row") - F.min("source_row") + 1).alias("_lines"))
    earlier = Window.partitionBy("source_file").orderBy("source_split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))).drop("_lines")
    line = F.col("_before") + F.col("source_row") - F.col("_first") + 1
    kept = [c for c in rows.columns if c not in ("source_split", "source_row")]
    return rows.join(before, ["source_file", "source_split"]).select(*kept, line.alias("source_line"))


def read_claims_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan: explicit schema, date parsed, amounts as DECIMAL(18,4).

    Unparseable values become null (no ANSI failure); use ``read_raw_csv`` and
    the validation layer to report them instead.
    """
    raw = read_raw_csv(spark, path)
    return raw.select(
        *[
            parse_date(F.col(c)).alias(c)
            if c == "service_date"
            else as_money(c).alias(c)
            if c in ("billed_amount", "paid_amount")
            else F.col(c)
            for c in raw.columns
            if c != CORRUPT
        ]
    )


def read_curated(spark: SparkSession, path: str, fields: Iterable[str] | None = None) -> DataFrame:
    """The curated parquet layer, in the layout of ``fields`` (default: the wide table).

    The schema is given, not inferred: a partition directory ``state_code=06``
    is the text 06, not the number 6.
    """
    return spark.read.schema(partition_schema(fields)).parquet(path)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """A claims table in any layout: the columns found under ``path``, claim fields with their given types."""
    found = spark.read.parquet(path).schema
    given = {f.name: f for f in partition_schema().fields}
    return spark.read.schema(T.StructType([given.get(f.name, f) for f in found.fields])).parquet(path)


def register(df: DataFrame, name: str = "claims") -> DataFrame:
    """Make a DataFrame queryable from SQL as ``name``."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run SQL text (named parameters as :name) and return the lazy result."""
    return spark.sql(text, args=dict(args) if args else None)
