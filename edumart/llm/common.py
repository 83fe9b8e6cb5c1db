"""Helpers shared by the operators of this subpackage: lineage cuts in the
shared folder, collision-free column names, connected components, and the
two whitespace-word definitions the contracts use."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.session import scratch_path

# The character classes of the query contracts.
SPACE = " \t-\r"                                      # U+0020, U+0009-U+000D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a reread of shared files, never a
    recomputation of everything before. Nullability aside the schema is kept.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have (case ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def space_words(c: Column) -> Column:
    """Array of the runs of non-space characters of a text (null: none)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def word_chunks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The whitespace words of a text's bytes, in order, about ``size`` bytes at a time."""
    pos = 0
    while pos < len(data):
        m = _SPACE.search(data, pos + size)
        end = m.start() if m else len(data)
        if words := data[pos:end].split():
            yield words
        pos = end


_SPACE = re.compile(rb"[ \t-\r]")


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of an undirected graph: ``(v, root)`` for every
    vertex that has an edge to another one; ``root`` is the same long for all
    vertices of a component and differs between components.

    ``edges``: columns ``a``, ``b`` (long; nulls are not allowed, loops are
    ignored, repeats are harmless).

    Randomised contraction: vertex ids are mixed by XXH64 (a bijection on
    longs), every vertex picks the smallest mixed id of its closed
    neighbourhood, both ends of each edge are replaced by their picks, loops
    and repeats go; the edge table shrinks geometrically. Afterwards the picks
    are composed backwards. Only hash aggregates with map-side combining and
    equi-joins: no vertex's neighbour list is ever gathered, so a hub with a
    third of all edges is no special case, and nothing reaches the driver but
    one emptiness flag per round.
    """
    e = materialize(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
                    .filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), f"{name}-edges")
    spark, picks = edges.sparkSession, []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.min("a")).alias("m")),
                           f"{name}-pick{len(picks)}")
        picks.append(pick)
        e = materialize(
            e.join(pick.select(F.col("v").alias("a"), F.col("m").alias("ma")), "a")
            .join(pick.select(F.col("v").alias("b"), F.col("m").alias("mb")), "b")
            .filter("ma <> mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b"))
            .distinct(), f"{name}-edges")
    if not picks:
        return spark.createDataFrame([], "v long, root long")
    label = picks.pop()
    while picks:
        upper = label.select(F.col("v").alias("m"), F.col("m").alias("top"))
        label = picks.pop().join(upper, "m", "left").select("v", F.coalesce("top", "m").alias("m"))
    label = label.select(F.col("v").alias("h"), F.col("m").alias("root"))
    ends = edges.filter("a <> b").select(F.explode(F.array("a", "b")).alias("v")).distinct()
    return ends.withColumn("h", F.xxhash64("v")).join(label, "h").select("v", "root")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges ``(vertex, smallest vertex of its component)`` with the same
    components as the links ``(i, j)`` among ``0 .. n-1``."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        if (live := lo != hi).sum() == 0:
            break
        np.minimum.at(root, hi[live], lo[live])
        while (up := root[root])[:].tolist() != root.tolist():
            root = up
    v = np.flatnonzero(root != np.arange(n))
    return v, root[v]
