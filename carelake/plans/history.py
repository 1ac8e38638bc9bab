"""Per-member windows kept up to date load by load.

``append_load`` adds a load to a history without computing it anew. A carry
table has one row a member: the paid total and the date of the last claim so
far. Members whose new claims all come after that date (or who are new) need
their new claims only: windows within the load, plus what the carry holds. The
others got a claim dated on or before one they have; all their claims are
windowed again and written with the load, and the rows that earlier loads hold
of them are superseded: a small table of (member, load) says so and readers
leave those rows out. No earlier file is touched, and a load is one commit
(``sources.published``).

After any sequence of loads ``read_history`` equals the windows over all claims
at once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.member_windows import member_windows
from carelake.schema import RAW_FIELDS
from carelake.session import discard, sized_shuffles, stored_bytes, written
from carelake.sources import published

LOAD = "load_no"
TOTAL = "decimal(28,4)"
CARRY = f"member_id string, paid {TOTAL}, last_date date"
_WINDOWS = ["member_cumulative_paid", "days_since_last_claim"]


def _state(spark: SparkSession, root: str) -> tuple[int, list[str], DataFrame, DataFrame]:
    """Number of loads, folders of their rows, carry, and superseded (member_id, load_no: rows of earlier loads don't count)."""
    manifest = published.latest(spark, root)
    if manifest is None:
        return 0, [], spark.createDataFrame([], CARRY), spark.createDataFrame([], f"member_id string, {LOAD} int")
    facts = manifest["facts"]
    return facts["loads"], facts["parts"], published.read_published(spark, root, "carry"), published.read_published(spark, root, "superseded")


def _rows(spark: SparkSession, root: str, parts: list[str], superseded: DataFrame) -> DataFrame:
    rows = spark.read.parquet(*[f"{root.rstrip('/')}/{p}" for p in parts])
    newer = superseded.select("member_id", F.col(LOAD).alias("_since"))
    # the size of ``superseded`` decides how it is joined
    return rows.join(newer, (rows["member_id"] == newer["member_id"]) & (rows[LOAD] < newer["_since"]), "left_anti")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All claims so far with their windows and the load that wrote the row."""
    _, parts, _, superseded = _state(spark, root)
    if not parts:
        raise FileNotFoundError(f"no load under {root}")
    return _rows(spark, root, parts, superseded)


def append_load(spark: SparkSession, root: str, claims: DataFrame) -> dict:
    """Add typed claims; {load_no, rows_added, rows_rewritten, members_repaired}."""
    state = _state(spark, root)
    held = [claims] + ([spark.read.parquet(*[f"{root.rstrip('/')}/{p}" for p in state[1]])] if state[1] else [])
    with sized_shuffles(spark, sum(map(stored_bytes, held))):
        return _append(spark, root, claims, *state)


def _append(spark: SparkSession, root: str, claims: DataFrame, loads: int, parts: list[str], carry: DataFrame, superseded: DataFrame) -> dict:
    number = loads + 1
    load_id = f"load{number:06d}-{uuid.uuid4().hex[:12]}"
    out = published.load_folder(root, load_id)
    place = lambda table: f"{published.LOADS}/{load_id}/{table}"

    new = written(claims.select(*RAW_FIELDS), "history-load")
    per_member = new.groupBy("member_id").agg(F.min("service_date").alias("_first"))
    late = written(per_member.join(carry, "member_id").filter(F.col("_first") <= F.col("last_date")).select("member_id"), "history-late")

    fresh = member_windows(new.join(late, "member_id", "left_anti"))
    before = carry.select("member_id", F.col("paid").alias("_paid"), F.col("last_date").alias("_last"))
    gap = F.coalesce("days_since_last_claim", F.datediff(F.col("service_date"), F.col("_last")))
    fresh = fresh.join(before, "member_id", "left").select(
        *RAW_FIELDS, (F.col("member_cumulative_paid") + F.coalesce("_paid", F.lit(0))).cast(TOTAL).alias(_WINDOWS[0]), gap.alias(_WINDOWS[1])
    )
    rows = fresh
    repaired = late.count()
    if repaired:
        old = _rows(spark, root, parts, superseded).select(*RAW_FIELDS)
        whole = old.unionByName(new).join(late, "member_id", "left_semi")
        rows = fresh.unionByName(member_windows(whole).select(*RAW_FIELDS, F.col(_WINDOWS[0]).cast(TOTAL).alias(_WINDOWS[0]), _WINDOWS[1]))
    rows.withColumn(LOAD, F.lit(number)).write.parquet(f"{out}/rows")
    written_rows = spark.read.parquet(f"{out}/rows")

    # carry: untouched members as they were, new and extended ones by addition, repaired ones from all their rows
    added = written_rows.groupBy("member_id").agg(F.coalesce(F.sum("paid_amount"), F.lit(0)).cast(TOTAL).alias("_new"), F.max("service_date").alias("_date"))
    base = carry.join(late, "member_id", "left_anti")
    merged = base.join(added, "member_id", "full").select(
        "member_id",
        (F.coalesce("paid", F.lit(0).cast(TOTAL)) + F.coalesce("_new", F.lit(0).cast(TOTAL))).cast(TOTAL).alias("paid"),
        F.greatest("last_date", "_date").alias("last_date"),
    )
    merged.write.parquet(f"{out}/carry")
    superseded.unionByName(late.withColumn(LOAD, F.lit(number))).groupBy("member_id").agg(F.max(LOAD).alias(LOAD)).write.parquet(f"{out}/superseded")

    n_new, n_rows = new.count(), written_rows.count()
    report = {LOAD: number, "rows_added": n_new, "rows_rewritten": n_rows - n_new, "members_repaired": repaired}
    published.commit(spark, root, load_id, {"carry": place("carry"), "superseded": place("superseded")}, {"loads": number, "parts": [*parts, place("rows")], **report})
    discard(new)
    discard(late)
    return report
