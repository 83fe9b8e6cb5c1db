"""Contract checks (V1, V2, V4): what the original pipeline enforced by
crashing becomes a reportable table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.operators.crosstab import CODE, N, QUESTION


def count_rejects(df: DataFrame, rejected: str, keys: Sequence[str] = (), out_n: str = "n") -> DataFrame:
    """Values per column that are present in the text but did not convert:
    (keys, column, n) from the arrays that ``read_delimited(rejects=True)`` adds."""
    return (df.select(*keys, F.explode(rejected).alias("column"))
            .groupBy(*keys, "column").agg(F.count(F.lit(1)).alias(out_n)))


def domain_violations(df: DataFrame, code: str, expected: Sequence[str],
                      out_code: str = "code", out_n: str = "n") -> DataFrame:
    """Codes outside the expected domain, with their row counts."""
    c = F.col(code)
    return (df.filter(~c.isin(list(expected)))
            .groupBy(c.alias(out_code)).agg(F.count(F.lit(1)).alias(out_n)))


def long_domain_violations(spark: SparkSession, counts: DataFrame,
                           cells: Sequence[tuple[str, str, str]],
                           keys: Sequence[str] = ()) -> DataFrame:
    """Long counts whose (question, code) has no mart column. The expected
    pairs come from the fixed catalogue (about a hundred rows), so the
    broadcast is bounded by the catalogue, not by the data."""
    qtype = "tinyint" if cells and isinstance(cells[0][0], int) else "string"
    expected = spark.createDataFrame([(q, c) for q, c, _ in cells], f"{QUESTION} {qtype}, {CODE} string")
    return (counts.join(F.broadcast(expected), [QUESTION, CODE], "left_anti")
            .groupBy(*keys, QUESTION, CODE).agg(F.sum(N).alias(N)))


def duplicate_keys(df: DataFrame, key: str | Sequence[str], out_n: str = "n") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_n)).filter(F.col(out_n) > 1)


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
