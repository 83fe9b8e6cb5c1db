"""Order-dependent output (O1): descending score order with a position.

A global position needs the whole order, but never one task: the rows are
range-partitioned and sorted by Spark, the sorted result is checkpointed to
the shared checkpoint folder (stable partitions, lineage cut), each
partition's size is counted, and a position is the partition's offset plus
the row's index inside it. The offsets table has one row per partition, so
its broadcast is bounded by the partition count, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edumart.session import checkpoint_root


def with_position(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    checkpoint_root(df.sparkSession)  # make sure a checkpoint folder is set
    ranked = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = ranked.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, (F.col("_off") + local + 1).cast("long"))
    return out.drop("_pid", "_mid", "_off")


def desc_nulls_last_order(col: str, tiebreak: Sequence[str] = ()) -> list[Column]:
    return [F.col(col).desc_nulls_last(), *[F.col(t).asc() for t in tiebreak]]
