"""Helpers shared by the training-data operators.

Arrow batches are cut into slices bounded by characters (one text may exceed
the bound on its own), so that a Python worker's memory follows the slice and
not Spark's batch size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession

from carelake.session import bound_batches, discard, ensure_checkpoint_dir  # noqa: F401

#: A word: a run of characters other than space and the five ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path  # for ``discard``
    return out


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive slices of a batch with their texts (null: ""), about ``limit`` bytes each."""
    at, n = 0, batch.num_rows
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        part = batch.slice(at, to - at)
        yield part, [t or "" for t in part.column(column).to_pylist()]
        at = to
