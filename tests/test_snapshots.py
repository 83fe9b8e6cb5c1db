"""Snapshot tables: what readers see, refused commits, killed writes."""

import os

import pytest
from pyspark.sql import functions as F

from edumart.sources import (
    RunConflict, commit, read_snapshot, resolve, run_atomic, unreferenced, versions, write_run, write_runs)


def rows(df):
    return sorted(r[0] for r in df.collect())


def test_rerun_is_atomic_for_readers(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    assert resolve(spark, t).version == 0
    with pytest.raises(ValueError):
        read_snapshot(spark, t)
    run_atomic(spark.range(5), t, "2024-01-01", {"by": "first"})
    reader = read_snapshot(spark, t)
    base = resolve(spark, t)
    parts = write_run(spark.range(10, 12), t, "2024-01-01")
    assert rows(reader) == rows(read_snapshot(spark, t)) == [0, 1, 2, 3, 4]
    commit(spark, t, base, parts)
    assert rows(reader) == [0, 1, 2, 3, 4]                       # it resolved the manifest before
    assert rows(read_snapshot(spark, t)) == [10, 11]
    assert rows(read_snapshot(spark, t, resolve(spark, t, 1))) == [0, 1, 2, 3, 4]
    assert versions(spark, t) == [1, 2] and dict(resolve(spark, t, 1).parts["2024-01-01"].info) == {"by": "first"}
    with pytest.raises(ValueError):
        resolve(spark, t, 7)


def test_killed_write_and_half_manifest_are_not_seen(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    run_atomic(spark.range(3), t, "d")
    write_run(spark.range(100), t, "d")                            # never committed
    os.makedirs(f"{t}/runs/half/_temporary/0")
    with open(f"{t}/_commits/.0000.tmp", "w") as f:                # killed while it wrote the manifest aside
        f.write('{"version": 2, "par')
    assert rows(read_snapshot(spark, t)) == [0, 1, 2]
    run_atomic(spark.range(4), t, "d")
    assert rows(read_snapshot(spark, t)) == [0, 1, 2, 3]
    assert len(unreferenced(spark, t)) == 3 and len(unreferenced(spark, t, keep=2)) == 2


def test_second_of_two_writers_is_refused(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    run_atomic(spark.range(1), t, "a")
    one, two = resolve(spark, t), resolve(spark, t)
    commit(spark, t, one, write_run(spark.range(2), t, "b"))
    with pytest.raises(RunConflict):
        commit(spark, t, two, write_run(spark.range(9), t, "a"))
    assert rows(read_snapshot(spark, t)) == [0, 0, 1] and not [n for n in os.listdir(f"{t}/_commits") if n.endswith(".tmp")]
    commit(spark, t, resolve(spark, t), write_run(spark.range(9), t, "a"), drop=["b"])
    assert rows(read_snapshot(spark, t)) == list(range(9))


def test_parts_by_key_empty_keys_and_changed_schema(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    df = spark.createDataFrame([(1, "a/b=c"), (2, "ü"), (3, "a/b=c")], "v long, k string")
    commit(spark, t, resolve(spark, t), write_runs(df, t, F.col("k"), ["a/b=c", "ü", "none"], {"ü": {"n": 1}}))
    assert rows(read_snapshot(spark, t, keys=["a/b=c"])) == [1, 3]
    assert rows(read_snapshot(spark, t, keys=["none"])) == [] and read_snapshot(spark, t, keys=["none"]).columns == ["v", "k"]
    commit(spark, t, resolve(spark, t), write_run(spark.createDataFrame([(9, 1.5)], "v long, w double"), t, "ü"))
    got = read_snapshot(spark, t)
    assert set(got.columns) == {"v", "k", "w"} and rows(got.select("v")) == [1, 3, 9]
    with pytest.raises(ValueError):
        write_runs(df, t, F.col("k"), ["ü"])
