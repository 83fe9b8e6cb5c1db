"""Checkpoint folder comes from the session; scratch folders live under it."""

from types import SimpleNamespace

import pytest

from edumart.session import checkpoint_root, scratch_path


def test_checkpoint_root_is_the_sessions(spark):
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert checkpoint_root(spark) == own.rstrip("/")


def test_scratch_paths_are_fresh_and_under_the_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(f"{root}/") and b.startswith(f"{root}/")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Unset:
        def get(self, key, default=None):
            return default
    far = SimpleNamespace(conf=Unset(), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        checkpoint_root(far)


def test_sized_deals_shuffles_by_rows_and_returns_the_settings(spark, monkeypatch):
    from edumart import session
    parts, target = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    files = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(parts), spark.conf.get(target), spark.conf.get(files)
    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    with session.sized(spark, 2_050):
        assert int(spark.conf.get(parts)) == 21 and max(int(spark.conf.get(k)) for k in (target, files)) <= session.BYTES_A_TASK
    with session.sized(spark, 100):                              # never fewer than the session sets
        assert spark.conf.get(parts) == before[0]
    try:
        with session.sized(spark, 10_000):
            raise KeyError
    except KeyError:
        pass
    assert (spark.conf.get(parts), spark.conf.get(target), spark.conf.get(files)) == before


def test_mart_incremental_writes_with_tasks_sized_by_its_rows(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from edumart import session
    from edumart.plans import analogues
    n = 400
    day = F.expr("timestamp_ntz '1996-06-01 00:00:00'") + F.expr("make_dt_interval(365 * cast(id % 3 as int))")
    tables = {
        "orders": spark.range(n).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit(10.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority")),
        "lineitem": spark.range(n).select(
            F.col("id").alias("l_orderkey"), *[F.lit(1).cast("bigint").alias(c) for c in ("l_partkey", "l_suppkey")], F.lit(1).alias("l_linenumber"),
            F.col("id").cast("double").alias("l_quantity"), *[F.lit(1.0).alias(c) for c in ("l_extendedprice", "l_discount", "l_tax")],
            *[F.lit("N").alias(c) for c in ("l_returnflag", "l_linestatus")], day.alias("l_shipdate")),
        "customer": spark.range(40).select(
            F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"), F.lit("m").alias("c_mktsegment")),
        "nation": spark.range(3).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("n").alias("n_name"), F.lit(1).alias("n_regionkey")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    monkeypatch.setattr(session, "ROWS_A_TASK", 20)
    seen, write = [], analogues.write_runs

    def spy(*args, **kw):
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return write(*args, **kw)

    monkeypatch.setattr(analogues, "write_runs", spy)
    mart = analogues.QUERIES["mart_incremental"](spark, tmp_dir)
    assert seen == [40, 40]
    assert mart.count() == spark.read.parquet(f"{tmp_dir}/orders.parquet").select(F.year("o_orderdate"), "o_custkey").distinct().count()
