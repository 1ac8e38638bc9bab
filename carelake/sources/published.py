"""Loads that appear as a whole or not at all.

A load writes its tables into a folder of its own, ``<root>/loads/<load id>``,
and then commits: a small manifest that names the folder of every table is
written under another name and renamed to the next free number in
``<root>/_manifests``. A rename to a name that exists fails, so two loads that
end at once get two numbers, and the higher one counts. Readers take the last
manifest that can be read; what a load left behind before its commit is never
seen. A load that a newer one has replaced stays for readers that have resolved
it, until ``prune`` removes all but the last few.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from carelake.schema import CURATED_PAID_FIELDS
from carelake.sources.files import read_curated
from carelake.sources.sinks import remove

MANIFESTS, LOADS = "_manifests", "loads"
#: Tables with another layout than the wide curated one; others are read with the schema they carry.
LAYOUTS = {"curated_claims": None, "curated_paid_by_state": CURATED_PAID_FIELDS}


def load_folder(root: str, load_id: str) -> str:
    return f"{root.rstrip('/')}/{LOADS}/{load_id}"


def _manifest_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the manifests, newest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MANIFESTS}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return [f"{root.rstrip('/')}/{MANIFESTS}/{n}" for n in sorted(names, reverse=True) if n.endswith(".json")]


def _read(spark: SparkSession, file: str) -> dict[str, Any] | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None  # not a whole manifest
    return found if isinstance(found, dict) and isinstance(found.get("tables"), dict) else None


def latest(spark: SparkSession, root: str) -> dict[str, Any] | None:
    """The manifest of the load that counts now, if any."""
    return next((m for f in _manifest_files(spark, root) if (m := _read(spark, f))), None)


def commit(spark: SparkSession, root: str, load_id: str, tables: dict[str, str | None], facts: dict[str, Any]) -> int:
    """Make a written load the one that readers see; the number of its manifest."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MANIFESTS}")
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    text = json.dumps({"load_id": load_id, "tables": tables, "facts": facts}, default=str)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf)
    rename = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    taken = [int(f.rsplit("/", 1)[1][:-5]) for f in _manifest_files(spark, root)]
    number = max(taken, default=0) + 1
    while True:
        target = jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.json")
        try:
            context.rename(draft, target, rename)
            return number
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            number += 1  # another load came first


def table_path(spark: SparkSession, root: str, table: str) -> str | None:
    """Folder of a table of the load that counts now (None: the load has no such table)."""
    manifest = latest(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no load published under {root}")
    held = manifest["tables"].get(table)
    return held and f"{root.rstrip('/')}/{held}"


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the load that counts now."""
    path = table_path(spark, root, table)
    if path is None:
        raise FileNotFoundError(f"the load published under {root} has no {table}")
    return read_curated(spark, path, LAYOUTS[table]) if table in LAYOUTS else spark.read.parquet(path)


def prune(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove committed loads but the last ``keep``; their ids. Loads without a manifest may be running and stay."""
    files = [(f, m) for f in _manifest_files(spark, root) if (m := _read(spark, f))]
    held = {m["load_id"] for _, m in files[:keep]}
    gone = []
    for file, manifest in files[keep:]:
        if manifest["load_id"] not in held:
            remove(spark, load_folder(root, manifest["load_id"]))
            gone.append(manifest["load_id"])
        remove(spark, file)
    return gone
