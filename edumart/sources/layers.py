"""Lake layers (S6, S8): ``<root>/<layer>/date=<run date>/...`` in Parquet.

A run replaces its own ``date`` folder, so re-running a day replaces that day
only; readers of a run open that folder, and filters on other partition columns
such as ``edition`` list only the matching directories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")
SCHEMA_FOLDER = "_schema"          # the leading "_" hides it from scans of the dataset


def layer_root(root: str, layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}"


def write_layer(df: DataFrame, root: str, layer: str, name: str, run_date: str,
                partition_by: Sequence[str] = (), keep_other_partitions: bool = False) -> str:
    """Write the run's ``date=`` folder, replacing exactly that folder: rows and
    partitions of an earlier run of the day go, also when the new result is
    empty. ``keep_other_partitions``: replace only the partitions present in
    ``df`` (landing one edition again). The schema is kept beside the data, so
    an empty result still reads as a table."""
    path = f"{layer_root(root, layer)}/{name}"
    run = f"{path}/date={run_date}"
    w = df.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if keep_other_partitions else "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(run)
    df.limit(0).write.mode("overwrite").parquet(f"{run}/{SCHEMA_FOLDER}")
    return path


def read_layer(spark: SparkSession, root: str, layer: str, name: str,
               run_date: str | None = None) -> DataFrame:
    """One run's folder with that run's own schema, or all runs together."""
    path = f"{layer_root(root, layer)}/{name}"
    if run_date is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    run = f"{path}/date={run_date}"
    schema = spark.read.parquet(f"{run}/{SCHEMA_FOLDER}").schema
    return spark.read.schema(schema).parquet(run).withColumn("date", F.lit(run_date))


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a path pattern, in name order (names only: a layer has
    one per dataset and run date)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [] if f.isDirectory())


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition columns of the dataset in a folder, from its
    sub-folders ``name=value``."""
    names = []
    while inner := _folders(spark, f"{path}/*=*"):
        names.append(inner[0].rsplit("/", 1)[1].split("=")[0])
        path = inner[0]
    return names


def publish(spark: SparkSession, src: str, target_uri: str, fmt: str = "parquet") -> str:
    """Copy a dataset to another file system URI (object store, shared volume)
    through Spark. The partition layout is that of the source, so relative keys
    stay. The target folder is replaced, the source is left in place (no
    upload-then-delete race). CSV copies keep header, text and encoding."""
    by = partition_columns(spark, src)
    read, how = spark.read, {}
    if fmt == "csv":
        how = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}
    else:
        for hidden in _folders(spark, f"{src}/{SCHEMA_FOLDER}"):
            read = read.schema(spark.read.parquet(hidden).schema)
    w = read.format(fmt).options(**how).load(src).write.format(fmt).options(**how).mode("overwrite")
    (w.partitionBy(*by) if by else w).save(target_uri)
    for hidden in _folders(spark, f"{src}/{SCHEMA_FOLDER}"):
        spark.read.parquet(hidden).write.mode("overwrite").parquet(f"{target_uri}/{SCHEMA_FOLDER}")
    return target_uri


def publish_layer(spark: SparkSession, root: str, layer: str, target_uri: str,
                  run_date: str | None = None) -> list[str]:
    """Publish every dataset of a layer (of one run date, or of all): Parquet
    tables and CSV copies, each under its own relative key. Returns the keys."""
    base = layer_root(root, layer)
    day = f"date={run_date or '*'}"
    here = _folders(spark, base)
    if not here:
        raise ValueError(f"no layer at {base}")
    keys = []
    for pattern, fmt in ((f"*/{day}", "parquet"), (f"*/*/{day}", "parquet"), (f"csv/{day}/*", "csv")):
        for path in _folders(spark, f"{base}/{pattern}"):
            key = path[len(here[0].rstrip("/")) + 1:]
            if fmt == "parquet" and key.startswith("csv/"):
                continue
            publish(spark, path, f"{target_uri.rstrip('/')}/{key}", fmt)
            keys.append(key)
    return keys
