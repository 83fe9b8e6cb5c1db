"""Column-level helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from edumart.functions.scalar import qcol


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Projection by name list; missing names raise (the contract)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[qcol(c) for c in cols])


def drop_like(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name contains ``pattern``."""
    return df.drop(*[c for c in df.columns if pattern in c])


def move_first(df: DataFrame, col: str) -> DataFrame:
    return df.select(qcol(col), *[qcol(c) for c in df.columns if c != col])


def drop_null_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Exclude rows with a missing grouping key (pandas ``groupby`` drops them,
    Spark keeps a NULL group)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = None
    for k in keys:
        c = qcol(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[qcol(c).alias(mapping.get(c, c)) for c in df.columns])
