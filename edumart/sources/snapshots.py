"""Atomic runs (S6, S7, S8): immutable run folders and a commit manifest.

A snapshot table is a folder

    <table>/runs/<id>/...          Parquet of one run, never changed once written
    <table>/_commits/<version>.json   which run folder each key's rows are in

Keys are run dates, editions or delivered files. A writer puts its rows into new
run folders, which nobody sees, and then commits: one manifest file that names
the folders of all keys, written aside and renamed to the next version. The
rename refuses an existing name, so of two writers that started from the same
version one gets ``RunConflict`` and has changed nothing. A reader resolves the newest
manifest once and reads the folders it names: a rerun in progress, a killed write
or a later commit do not change what it sees.

The manifest holds one entry per key (a few hundred bytes), never rows. The
rename must be atomic on the file system (HDFS, local disk, most cluster
stores); plain object stores need a committer service in front.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUNS, COMMITS = "runs", "_commits"
_KEY = "_run_key"


class RunConflict(RuntimeError):
    """Another run was committed since this one resolved its base version."""


@dataclass(frozen=True)
class Part:
    """Where one key's rows are: a folder below the table (None: no rows), the
    schema, and facts about the key (such as its delivery's checksum)."""

    folder: str | None
    schema: str
    info: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """What one manifest says; version 0 is a table without commits."""

    version: int
    parts: Mapping[str, Part]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, table: str) -> list[int]:
    """Committed versions, oldest first."""
    names = _names(spark, f"{table}/{COMMITS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def resolve(spark: SparkSession, table: str, version: int | None = None) -> Snapshot:
    """The newest committed snapshot, or the given version."""
    known = versions(spark, table)
    if version is None:
        version = known[-1] if known else 0
    if version == 0:
        return Snapshot(0, {})
    if version not in known:
        raise ValueError(f"{table}: no version {version}")
    fs, p = _fs(spark, f"{table}/{COMMITS}/{version:020d}.json")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(version, {k: Part(**v) for k, v in json.loads(text)["parts"].items()})


def commit(spark: SparkSession, table: str, base: Snapshot, parts: Mapping[str, Part],
           drop: Iterable[str] = ()) -> Snapshot:
    """Make ``parts`` visible on top of ``base`` (keys in ``drop`` go); refuses
    if another commit was made since ``base`` was resolved."""
    after = {k: p for k, p in {**base.parts, **parts}.items() if k not in set(drop)}
    version = base.version + 1
    text = json.dumps({"version": version, "parts": {k: asdict(p) for k, p in after.items()}}, sort_keys=True)
    folder = f"{table}/{COMMITS}"
    fs, aside = _fs(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, final = _fs(spark, f"{folder}/{version:020d}.json")
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(final), none)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise RunConflict(f"{table}: version {version} was committed by another run") from None
        raise
    return Snapshot(version, after)


def write_run(df: DataFrame, table: str, key: str, info: Mapping | None = None) -> dict[str, Part]:
    """All rows of ``df`` as the not yet visible part of one key."""
    folder = f"{RUNS}/{uuid.uuid4().hex}"
    df.write.parquet(f"{table}/{folder}")
    return {key: Part(folder, df.schema.json(), dict(info or {}))}


def write_runs(df: DataFrame, table: str, key: Column, keys: Sequence[str],
               info: Mapping[str, Mapping] | None = None) -> dict[str, Part]:
    """Rows dealt to the given keys by the string column ``key``, in one job; a
    key without rows gets an empty part. Rows of other keys are an error of
    the caller and are refused."""
    folder = f"{RUNS}/{uuid.uuid4().hex}"
    named = {hashlib.sha256(k.encode()).hexdigest()[:32]: k for k in keys}
    schema = df.schema.json()
    df.withColumn(_KEY, F.substring(F.sha2(key, 256), 1, 32)).write.partitionBy(_KEY).parquet(_at(table, folder))
    found = {n.split("=", 1)[1] for n in _names(df.sparkSession, _at(table, folder)) if n.startswith(f"{_KEY}=")}
    if found - named.keys():
        raise ValueError(f"{len(found - named.keys())} keys of the rows are not among {list(keys)[:5]} ...")
    return {k: Part(f"{folder}/{_KEY}={h}" if h in found else None, schema, dict((info or {}).get(k, {})))
            for h, k in named.items()}


def _at(table: str, folder: str) -> str:
    return f"{table.rstrip('/')}/{folder}"


def read_snapshot(spark: SparkSession, table: str, snapshot: Snapshot | None = None,
                  keys: Sequence[str] | None = None) -> DataFrame:
    """The rows of all keys, or of the given ones, of one resolved snapshot.
    Parts of different schemas are stacked by name."""
    snapshot = snapshot or resolve(spark, table)
    chosen = {k: p for k, p in snapshot.parts.items() if keys is None or k in set(keys)}
    if not chosen:
        raise ValueError(f"{table}: nothing committed" + ("" if keys is None else f" for {list(keys)}"))
    by_schema: dict[str, list[str]] = {}
    for p in chosen.values():
        by_schema.setdefault(p.schema, []).extend([_at(table, p.folder)] if p.folder else [])
    frames = []
    for schema, folders in by_schema.items():
        schema = StructType.fromJson(json.loads(schema))
        frames.append(spark.read.schema(schema).parquet(*sorted(folders)) if folders else spark.createDataFrame([], schema))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def run_atomic(df: DataFrame, table: str, key: str, info: Mapping | None = None) -> Snapshot:
    """Write and commit one key's rows: the rerun of a day replaces that day."""
    base = resolve(df.sparkSession, table)
    return commit(df.sparkSession, table, base, write_run(df, table, key, info))


def unreferenced(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Run folders that none of the newest ``keep`` versions names (left by
    killed writes, refused commits and old versions); for a clean-up job that
    knows which readers are still at work."""
    used = {p.folder.split("/")[1] for v in versions(spark, table)[-keep:]
            for p in resolve(spark, table, v).parts.values() if p.folder}
    return [f"{RUNS}/{n}" for n in _names(spark, f"{table}/{RUNS}") if n not in used]
