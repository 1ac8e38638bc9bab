"""Stable hash buckets that any SQL engine with md5 can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(value: Column, seed: str, modulus: int = 100) -> Column:
    """Bucket 0..modulus-1 from the first 32 bits of md5(seed + ':' + value)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), value))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(modulus))
