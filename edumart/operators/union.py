"""UNION ALL by name across editions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_editions(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent on one side is NULL there.
    An empty input is an error (there is nothing to take a schema from)."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("union_editions needs at least one input")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
