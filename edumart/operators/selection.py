"""Exact statistics of continuous values under hot keys (A2, A7): distributed
selection of the middle ranks.

``value_stats`` orders each key's distinct values in one window, which is right
for ages and wrong for amounts: a key with a third of all rows has as many distinct
values as rows. Here no step gathers a key:

1. Equal (key, value) rows are counted (hash aggregate, partial on the map side).
2. The counted rows are range-partitioned by (key, value): a hot key spreads over
   as many partitions as its share asks for, and the ranges are written down
   with their partition number.
3. Each range's count per key gives, by prefix sums over ranges, the range in which
   a key's middle ranks lie: a table with a row per (key, range).
4. Only in those ranges (one or two for a key) rows are ranked, in groups that a
   range bounds.

Mean and deviation are mergeable moments, aggregated beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edumart.functions.scalar import exact_mean
from edumart.operators.columns import drop_null_keys
from edumart.session import scratch_path


def ranges(df: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """(keys, value, _f, _range): counted values in ranges of the order (keys, value),
    written to the shared folder so that every later step sees the same ranges."""
    counted = drop_null_keys(df, keys).filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_f"))
    by = [*keys, value]
    dealt = counted.repartitionByRange(partitions, *by) if partitions else counted.repartitionByRange(*by)
    path = scratch_path(df.sparkSession, "selection")
    dealt.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ranks(dealt: DataFrame, keys: Sequence[str], value: str, wanted: Sequence) -> DataFrame:
    """(keys, _n, one column ``_r<i>`` per wanted rank): the values at 1-based
    ranks, given as expressions of the key's count ``_n``."""
    parts = dealt.groupBy(*keys, "_range").agg(F.sum("_f").alias("_c"))
    # a row per (key, range): a key's rows here are as many as the ranges it spans
    w = Window.partitionBy(*keys).orderBy("_range")
    parts = parts.select(*keys, "_range", "_c", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_upto"),
                         F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"))
    before = F.col("_upto") - F.col("_c")
    hit = None
    for r in wanted:
        here = (r > before) & (r <= F.col("_upto"))
        hit = here if hit is None else hit | here
    goals = parts.filter(hit).select(*keys, "_range", "_n", before.alias("_before"))
    rows = dealt.join(goals, [*keys, "_range"])
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_cum", F.col("_before") + F.sum("_f").over(inside))
    got = [F.min(F.when((F.col("_cum") >= r) & (F.col("_cum") - F.col("_f") < r), F.col(value))).alias(f"_r{i}")
           for i, r in enumerate(wanted)]
    return rows.groupBy(*keys).agg(F.max("_n").alias("_n"), *got)


def value_stats_continuous(df: DataFrame, keys: Sequence[str], value: str,
                           names: tuple[str, str, str] = ("mean", "median", "std"),
                           partitions: int | None = None, round_places: int | None = None) -> DataFrame:
    """``value_stats`` for values with many distinct levels per key: mean, exact
    median (mean of the two middle values) and sample deviation.

    A key with one value has no deviation (NULL), a key whose values are all
    missing is kept with NULL statistics, a NULL key is dropped. ``partitions``:
    number of ranges (default: the session's shuffle partitions)."""
    mean_n, median_n, std_n = names

    def out(c, name):
        return (F.round(c, round_places) if round_places is not None else c).alias(name)

    v, n = F.col(value), F.col("_n")
    moments = drop_null_keys(df, keys).groupBy(*keys).agg(exact_mean(value).alias("_mean"), F.stddev_samp(v).alias("_std"))
    middle = ranks(ranges(df, keys, value, partitions), keys, value, [F.floor((n + 1) / 2), F.floor(n / 2) + 1])
    return moments.join(middle, list(keys), "left").select(
        *keys, out(F.col("_mean"), mean_n), out(((F.col("_r0") + F.col("_r1")) / 2).cast("double"), median_n),
        out(F.col("_std"), std_n))
