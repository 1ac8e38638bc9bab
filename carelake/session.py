"""Session helpers for tests and the bench (library code never builds one)."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Stored bytes that one task of a shuffle takes, and shuffled ones up to which AQE puts parts together.
TASK_BYTES = 8 << 20
MERGED_BYTES = 16 << 20
#: Writers of a partitioned table that a task keeps open; it sorts its rows only if it meets more values.
OPEN_WRITERS = 8
#: Bytes of rows that a task hands to Python at a time, where the caller has set nothing (Spark's default is 64 MB).
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the cluster one, minus the cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("carelake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder; invent one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is left
    alone; without it a cluster session is refused, as each executor would
    write to its own disk. Local tests have none, so a scratch folder is made
    for them.
    """
    current = checkpoint_dir(spark)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
    local = tempfile.mkdtemp(prefix="carelake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as their file system gives them (0 if it reads none)."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def sized_shuffles(spark: SparkSession, stored: int) -> Iterator[None]:
    """Writes within are shuffled in as many parts as ``stored`` bytes of input need: a task then holds no more
    of a large input than of a small one. Small inputs keep the session's number."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if stored // TASK_BYTES <= parts:
        yield
        return
    with _settings(spark, {"spark.sql.shuffle.partitions": str(stored // TASK_BYTES + 1), "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(MERGED_BYTES)}):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes within, and queries of frames made within, remove their shuffle files as each of them ends. Else the files
    of every step of a load stay until the driver happens to collect its garbage, and the disk holds them all at once."""
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within keep a few files open at once instead of sorting their rows first."""
    with _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_WRITERS)}):
        yield


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about BATCH_BYTES (one row may exceed them on its own), so that the JVM's and
    the worker's copies of a batch follow its bytes and not 10,000 rows of any length.

    A lazy result takes the setting when it is written, so it stays with the session; one that the caller has set is kept.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def written(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` as a parquet table in the checkpoint folder, read back.

    Cuts lineage and fixes the rows: what is read afterwards is pruned by
    column (and by ``partition_by``), and every reader sees the same values.
    ``compression``: a codec other than the session's, for stages of whole tables.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/carelake-stages/{name}-{uuid.uuid4().hex}"
    if partition_by:
        with open_writers(spark):
            df.write.partitionBy(partition_by).parquet(path, compression=compression)
    else:
        df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path  # for ``discard``
    return out


def discard(df: DataFrame) -> None:
    """Remove the stage behind ``df``, a result of ``written``, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
