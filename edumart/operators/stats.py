"""Score means and age statistics, course level and institution level
(A1, A2, A6, A7, P3, P4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edumart.functions.scalar import exact_mean, round_half_even
from edumart.operators.columns import drop_null_keys


def mean_scores(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                places: int | None = 2, zero_fill: bool = False) -> DataFrame:
    """Per-key mean of each score column, missing values skipped, rounded
    half-even to ``places``; ``zero_fill`` turns a key without any value into
    0 (course scores, K2)."""
    aggs = []
    for c in cols:
        m = exact_mean(c)
        m = round_half_even(m, places) if places is not None else m
        aggs.append(F.coalesce(m, F.lit(0.0)).alias(c) if zero_fill else m.alias(c))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def _map_up(child: DataFrame, mapping: DataFrame, from_key: str, to_key: str,
            keys: Sequence[str]) -> DataFrame:
    m = drop_null_keys(mapping.select(*keys, from_key, to_key), [to_key])
    return child.join(m, [*keys, from_key], "inner")


def mean_of_means(child: DataFrame, mapping: DataFrame, from_key: str, to_key: str,
                  cols: Sequence[str], keys: Sequence[str] = (), places: int | None = 2) -> DataFrame:
    """Second-level mean (A6): every child row weighs 1, whatever its own
    population; children missing from ``mapping`` drop out (K3)."""
    j = _map_up(child, mapping, from_key, to_key, keys)
    aggs = []
    for c in cols:
        m = exact_mean(c)
        aggs.append((round_half_even(m, places) if places is not None else m).alias(c))
    return j.groupBy(*keys, to_key).agg(*aggs)


def avg_of_stats(child: DataFrame, mapping: DataFrame, from_key: str, to_key: str,
                 cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Plain unrounded mean of child statistics, NULLs skipped."""
    j = _map_up(child, mapping, from_key, to_key, keys)
    return j.groupBy(*keys, to_key).agg(*[F.avg(c).alias(c) for c in cols])


def value_stats(df: DataFrame, keys: Sequence[str], value: str,
                names: tuple[str, str, str] = ("mean", "median", "std"),
                exact_median: bool = True, accuracy: int = 10000,
                round_places: int | None = None) -> DataFrame:
    """Per-key mean, exact median (mean of the two middle values) and sample
    standard deviation (A2).

    Plan: (1) histogram ``(keys, value) -> frequency`` in a codegen'd hash
    aggregate, partial on the map side, so even a key holding a third of all
    rows reaches the shuffle as at most one row per distinct value per map
    task; (2) one window per key over the small histogram, ordered by value,
    gives the running and total frequency and the value sum; (3) a plain hash
    aggregate (no object aggregate, no sort fallback) picks the two middle
    values by cumulative frequency and forms the two-pass sample variance.
    A key with one value has no std (NULL); a key whose values are all
    missing is kept with NULL statistics. ``round_places`` rounds the three
    outputs (half-up), e.g. for comparisons at a fixed precision.
    """
    mean_n, median_n, std_n = names

    def out(c, name):
        return (F.round(c, round_places) if round_places is not None else c).alias(name)

    if not exact_median:
        # opt-in: one aggregate (partial sketches), median within 1/accuracy
        # of rank; for values with very many distinct levels per key
        v = F.col(value)
        return drop_null_keys(df, keys).groupBy(*keys).agg(
            out(F.avg(v), mean_n),
            out(F.percentile_approx(v, 0.5, accuracy).cast("double"), median_n),
            out(F.stddev_samp(v), std_n))
    hist = drop_null_keys(df, keys).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_f"))
    return histogram_stats(hist, keys, value, "_f", names, round_places)


def histogram_stats(hist: DataFrame, keys: Sequence[str], value: str, frequency: str,
                    names: tuple[str, str, str] = ("mean", "median", "std"),
                    round_places: int | None = None) -> DataFrame:
    """Steps 2 and 3 of ``value_stats`` from rows ``(keys, value, frequency)``,
    one row per key and value."""
    mean_n, median_n, std_n = names

    def out(c, name):
        return (F.round(c, round_places) if round_places is not None else c).alias(name)

    hist = hist.withColumnRenamed(frequency, "_f")
    v, f = F.col(value), F.col("_f")
    nn = F.when(v.isNotNull(), f)
    ordered = Window.partitionBy(*keys).orderBy(v.asc_nulls_first())
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hist = hist.select(*keys, value, "_f",
                       F.sum(nn).over(running).alias("_cum"),
                       F.sum(nn).over(whole).alias("_n"),
                       F.sum(v * f).over(whole).alias("_s"))
    n, cum = F.col("_n"), F.col("_cum")
    mean = F.when(n > 0, F.col("_s") / n)
    lo_pos = F.floor((n + 1) / 2)        # 1-based positions of the middle pair
    hi_pos = F.floor(n / 2) + 1
    dev = v - mean
    stats = hist.groupBy(*keys).agg(
        F.max(mean).alias(mean_n),
        F.min(F.when(cum >= lo_pos, v)).alias("_lo"),
        F.min(F.when(cum >= hi_pos, v)).alias("_hi"),
        F.sum(f * dev * dev).alias("_ss"),
        F.max(n).alias("_n"))
    return stats.select(
        *keys, out(F.col(mean_n), mean_n),
        out(((F.col("_lo") + F.col("_hi")) / 2).cast("double"), median_n),
        out(F.when(F.col("_n") > 1, F.sqrt(F.col("_ss") / (F.col("_n") - 1))), std_n))
