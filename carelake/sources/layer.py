"""The claims layer: typed claims written once, read by every report.

Analytics read a curated claims table, not the raw sources. Built from the
driver tables this means the four dimension joins of the claims mapping run
once per input, and each report becomes a pruned scan of a parquet table:

* partitioned by ``claim_status``, so the many PAID-only reports read only the
  PAID directory (partition pruning), and
* written by the parallel tasks of the build, so scans are split across many
  files instead of one row group.

The layer lives under the session's checkpoint folder (``spark.checkpoint.dir``
on a cluster; a scratch folder in local tests) in a directory named by a
fingerprint of the source files (paths, sizes, modification times), so a
changed input gets a new layer rather than a stale one.

Besides the 14 claim fields the layer keeps two provenance columns,
``source_orderkey`` and ``source_linenumber``, which the raw-feed simulation
and the denial notes use.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.hashing import md5_bucket
from carelake.schema import RAW_FIELDS, partition_schema
from carelake.session import ensure_checkpoint_dir, freed_shuffles, open_writers, sized_shuffles, stored_bytes
from carelake.sources.tables import claims_with_provenance, raw_from_typed, read_table

SOURCE_TABLES = ["lineitem", "orders", "customer", "nation", "part"]
PROVENANCE = ["source_orderkey", "source_linenumber"]
LAYER_DIR = "carelake-claims-layer"
# bump when the mapping, the layout or the raw-feed defects change: the
# version is part of the fingerprint, so an older layer is never reused
LAYER_VERSION = "7"


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the source files' names, sizes and times, as their own file system gives them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parts = [LAYER_VERSION, sf_dir.rstrip("/")]
    for t in SOURCE_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            parts.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:16]


def committed(spark: SparkSession, path: str) -> bool:
    """True when a write to ``path`` finished (its ``_SUCCESS`` marker exists)."""
    try:
        spark.read.format("binaryFile").load(f"{path.rstrip('/')}/_SUCCESS").limit(1).collect()
        return True
    except AnalysisException:
        return False


def layer_path(spark: SparkSession, sf_dir: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{LAYER_DIR}/{fingerprint(spark, sf_dir)}"


def build_claims_layer(spark: SparkSession, sf_dir: str, path: str) -> None:
    claims = claims_with_provenance(spark, sf_dir)
    with sized_shuffles(spark, stored_bytes(read_table(spark, sf_dir, "lineitem"))), open_writers(spark), freed_shuffles(spark):
        (
            claims.write.mode("overwrite")
            .option("maxRecordsPerFile", 5_000_000)
            .option("compression", "zstd")
            .partitionBy("claim_status")
            .parquet(path)
        )


# one build at a time per process: concurrent callers wait and reuse it
_BUILD_LOCK = threading.RLock()


def claims_layer(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> DataFrame:
    """The typed claims layer for ``sf_dir`` (built on first use).

    The sources' fingerprint is taken on every call, so a rewritten source
    gets a new layer within a session too; ``rebuild=True`` rewrites it.
    """
    with _BUILD_LOCK:
        path = layer_path(spark, sf_dir)
        if rebuild or not committed(spark, path):
            build_claims_layer(spark, sf_dir, path)
        return spark.read.schema(_layer_schema()).parquet(path)


def _layer_schema() -> T.StructType:
    fields = partition_schema(RAW_FIELDS).fields
    return T.StructType(
        [f for f in fields if f.name != "claim_status"]
        + [T.StructField("source_orderkey", T.LongType()), T.StructField("source_linenumber", T.IntegerType())]
        + [f for f in fields if f.name == "claim_status"]
    )


RAW_FEED_DIR = "raw_feed_csv"
#: Rows of a file of the raw feed at most: compressed files are read whole, one a task.
FEED_FILE_ROWS = 250_000


def raw_feed(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> str:
    """Path of the raw landing feed for ``sf_dir``: header CSV, all text,
    with the seeded defects (see ``tables.raw_from_typed``); written once
    next to the claims layer."""
    with _BUILD_LOCK:
        base = claims_layer(spark, sf_dir)
        path = layer_path(spark, sf_dir) + "_" + RAW_FEED_DIR
        if rebuild or not committed(spark, path):
            (
                raw_from_typed(base)
                .write.mode("overwrite")
                .option("header", "true")
                .option("compression", "gzip")
                .option("maxRecordsPerFile", FEED_FILE_ROWS)
                .csv(path)
            )
        return path


MIXED_FEED_DIR = "mixed_feed_csv"


def mixed_feed(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed as a mixed landing folder: files in the standard order, files in another order with quoted names,
    and files whose rows lack the last field or have one too many (by md5 of the claim id)."""
    with _BUILD_LOCK:
        path = layer_path(spark, sf_dir) + "_" + MIXED_FEED_DIR
        if not committed(spark, f"{path}/odd"):
            raw = raw_from_typed(claims_layer(spark, sf_dir))
            bucket = md5_bucket(F.col("claim_id"), "mixed")
            raw.filter(bucket < 50).write.mode("overwrite").option("header", "true").csv(f"{path}/plain")
            turned = [RAW_FIELDS[1], RAW_FIELDS[0], *reversed(RAW_FIELDS[2:])]
            (
                raw.filter((bucket >= 50) & (bucket < 80)).select(*turned)
                .write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(f"{path}/turned")
            )
            # whole lines as one column, so that a row may have any number of fields
            text = [F.coalesce(F.col(f), F.lit("")) for f in RAW_FIELDS]
            short, long = F.concat_ws(",", *text[:-1]), F.concat_ws(",", *text, F.lit("more"))
            line = F.when(bucket < 85, short).when(bucket < 90, long).otherwise(F.concat_ws(",", *text))
            (
                raw.filter(bucket >= 80).select(line.alias(",".join(RAW_FIELDS)))
                .write.mode("overwrite").option("header", "true").option("sep", "\u0001").csv(f"{path}/odd")
            )
        return path


LINES_FEED_DIR = "lines_feed_csv"
#: Rows of a file of the numbered feed, about; and its least number of files.
LINES_FILE_ROWS, LINES_FILES = 1_000_000, 4


def lines_feed(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed as files whose line numbers are known: ``part=<n>`` holds the claims of a bucket (md5 of the id) in the
    order of their ids below a header, with a blank line before some of them (another bucket)."""
    with _BUILD_LOCK:
        path = layer_path(spark, sf_dir) + "_" + LINES_FEED_DIR
        if not committed(spark, path):
            raw = raw_from_typed(claims_layer(spark, sf_dir))
            files = LINES_FILES + raw.count() // LINES_FILE_ROWS
            line = F.concat_ws(",", *[F.coalesce(F.col(f), F.lit("")) for f in RAW_FIELDS])
            gap = F.when(md5_bucket(F.col("claim_id"), "gap") < 5, F.lit("\n")).otherwise(F.lit(""))
            rows = raw.select(md5_bucket(F.col("claim_id"), "lines", files).alias("part"), F.col("claim_id").alias("_id"), F.concat(gap, line).alias("value"))
            heads = spark.range(files).select(F.col("id").alias("part"), F.lit("").alias("_id"), F.lit(",".join(RAW_FIELDS)).alias("value"))
            (
                rows.unionByName(heads).repartition(files, "part").sortWithinPartitions("part", "_id").select("part", "value")
                .write.mode("overwrite").partitionBy("part").option("compression", "gzip").text(path)
            )
        return path


def layer_claims(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Typed claims from the layer, restricted to ``columns`` (claim fields)."""
    cols = list(columns) if columns is not None else list(RAW_FIELDS)
    unknown = [c for c in cols if c not in RAW_FIELDS and c not in PROVENANCE]
    if unknown:
        raise ValueError(f"not claim fields: {unknown}")
    return claims_layer(spark, sf_dir).select(*cols)
