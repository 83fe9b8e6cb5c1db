"""Join helpers: pandas-style suffixing, null-safe keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edumart.functions.scalar import qcol


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_suffixed(left: DataFrame, right: DataFrame, on, how: str = "left",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join on named keys; non-key names present on both sides get
    ``suffixes`` (pandas ``merge`` default). Output order: left columns, then
    the right side's non-key columns."""
    keys = _keys(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lsx, rsx = suffixes
    if clash:
        left = left.select(*[qcol(c).alias(c + lsx if c in clash else c) for c in left.columns])
        right = right.select(*[qcol(c).alias(c + rsx if c in clash else c) for c in right.columns])
    joined = left.join(right, keys, how)
    order = list(left.columns) + [c for c in right.columns if c not in keys]
    if joined.columns == order:
        return joined
    return joined.select(*[qcol(c) for c in order])


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join where a NULL key matches a NULL key (pandas ``merge``
    parity, J7). Key columns appear once, taken from whichever side has them;
    other shared names get ``_x`` / ``_y``."""
    keys = _keys(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    taken = {*left.columns, *right.columns}
    temp = {}
    for k in keys:
        name = f"{k}_right"
        while name in taken:
            name += "_"
        taken.add(name)
        temp[k] = name
    r = right.select(*[qcol(c).alias(temp.get(c, c)) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[temp[k]])
        cond = c if cond is None else cond & c
    joined = left.join(r, cond, how)
    key_cols = [F.coalesce(left[k], r[temp[k]]).alias(k) for k in keys]
    rest_l = [left[c].alias(c + "_x" if c in clash else c) for c in left.columns if c not in keys]
    rest_r = [r[c].alias(c + "_y" if c in clash else c) for c in right.columns if c not in keys]
    return joined.select(*key_cols, *rest_l, *rest_r)


def enrich(fact: DataFrame, dim: DataFrame, on, how: str = "left",
           suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Attach dimension attributes to a keyed summary.

    ``dim`` must be unique on ``on`` (de-duplicated registry), so the join
    never fans out. The planner decides on a broadcast from its size estimate
    in bytes.
    """
    return join_suffixed(fact, dim, on, how, suffixes)


def chain_left(base: DataFrame, others: Sequence[DataFrame], on) -> DataFrame:
    """Left-join several summaries that share the key ``on`` onto ``base``.

    All sides are aggregates keyed by ``on``; hash-partitioned on the same
    key they zip together without further exchanges."""
    out = base
    for o in others:
        out = out.join(o, _keys(on), "left")
    return out
