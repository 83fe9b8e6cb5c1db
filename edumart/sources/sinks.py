"""Mart sinks (S7): Parquet as the primary copy, optional CSV copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_mart(df: DataFrame, path: str, fmt: str = "parquet",
               partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("encoding", "UTF-8").option("quote", '"') \
         .option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported mart format {fmt!r}")
    return path
