"""File-set selection (S4) and file-name routing.

Listing goes through Spark's ``binaryFile`` source with the ``content``
column pruned, so only file metadata is read, on any Hadoop file system.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.load(root)
    return df.select("path", "length",
                     F.element_at(F.split("path", "/"), -1).alias("file_name"))


def manifest_report(spark: SparkSession, manifest: DataFrame, root: str,
                    glob: str | None = None) -> DataFrame:
    """Manifest rows ``(…, file_name)`` whose file is absent under ``root``.
    The original skipped such files silently; here they are reported and the
    run goes on with what exists."""
    present = list_files(spark, root, glob).select("file_name")
    return manifest.join(present, "file_name", "left_anti")


def route_expr(file_name: Column, rules: Sequence[tuple[str, str]],
               suffix: str | None = None, match: str = "contains") -> Column:
    """First rule that matches the file name wins; no match (or a wrong suffix)
    gives NULL. ``match``: ``"contains"`` (substring), ``"prefix"`` or ``"exact"``."""
    tests = {"contains": file_name.contains, "prefix": file_name.startswith, "exact": file_name.__eq__}
    if match not in tests:
        raise ValueError(f"unknown match {match!r}")
    expr = None
    for needle, relation in rules:
        cond = tests[match](needle)
        expr = F.when(cond, F.lit(relation)) if expr is None else expr.when(cond, F.lit(relation))
    if expr is None:
        raise ValueError("no routing rules")
    if suffix is not None:
        expr = F.when(file_name.endswith(suffix), expr)
    return expr


def route_by_filename(df: DataFrame, rules: Sequence[tuple[str, str]],
                      suffix: str | None = None, name: str = "relation", match: str = "contains") -> DataFrame:
    """Tag every row of a multi-file scan with the relation its file feeds,
    dropping rows of stray files. ``df`` must come straight from a file scan."""
    rel = route_expr(F.col("_metadata.file_name"), rules, suffix, match)
    return df.withColumn(name, rel).filter(F.col(name).isNotNull())


CHUNK = 4 << 20                # bytes of a file held at a time


def file_stamps(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, file_name, length, modified): what a listing says, no content read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length",
                               F.unix_micros("modificationTime").alias("modified"))


def _store(path: str):
    """(file system, name in it) of a path that tasks can open themselves, else None."""
    uri = f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path
    try:
        return pafs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _digest(path: str) -> str:
    fs, name = _store(path)
    sha = hashlib.sha256()
    with fs.open_input_stream(name) as f:
        while chunk := f.read(CHUNK):
            sha.update(chunk)
    return sha.hexdigest()


def file_digests(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """SHA-256 of each delivered file's bytes (a delivery has some tens of files).

    A task reads its file in chunks of ``CHUNK``. In a store that only Spark
    reads, the content comes through ``binaryFile`` (there a file must be below 2 GB)."""
    paths = list(paths)
    if not paths:
        return {}
    if _store(paths[0]) is None:
        got = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))
    else:
        def digests(batches):
            for b in batches:
                names = b.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({"path": names, "sha256": [_digest(p) for p in names]})

        listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
        got = listed.mapInArrow(digests, "path string, sha256 string")
    return {r.path: r.sha256 for r in got.collect()}
