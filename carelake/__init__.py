"""carelake: claims analytics as lazy Spark DataFrame functions.

Layers
------
sources    readers (CSV landing files, parquet curated layer, the driver's
           TPC-H-style tables mapped to claims) and sinks
functions  small Column-expression helpers (money rounding, dates, text)
operators  reusable relational building blocks (validation, per-member
           windows, readmission self-join, Pareto scan, exact median, pivots)
plans      the named analytics: KPIs, trends, segments, ETL, text tasks
streaming  incremental landing-zone ingest with the same validation

Nothing here creates a SparkSession at import time; every public function
takes DataFrames (or a session plus a path) and returns a lazy DataFrame.
"""

__all__ = ["schema"]
