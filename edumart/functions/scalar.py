"""Column expressions shared by the marts. All are built-in Spark SQL
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens the default CSV reader of the original pipeline
# treats as missing (pandas ``read_csv`` default ``na_values``). A lone blank
# " " is *not* among them.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

MISSING_CODE = "N"


def qcol(name: str) -> Column:
    """Column by its literal name, even when the name holds dots, commas or
    spaces (the display labels do)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _col(c) -> Column:
    return qcol(c) if isinstance(c, str) else c


def round_half_even(c, places: int = 2) -> Column:
    """Round by scale-multiply and round-half-even on the scaled double.

    Matches ``numpy.round`` (``rint(x * 10**p) / 10**p``): 2.675 -> 2.68,
    0.575 -> 0.57, 47.125 -> 47.12. Spark's ``round`` (half-up on the decimal
    expansion) and ``bround`` (half-even on the decimal expansion) differ on
    such inputs, so neither is used.
    """
    scale = float(10 ** places)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def exact_mean(c) -> Column:
    """Aggregate: arithmetic mean with an exact decimal sum.

    Summing the values as ``decimal(38, 18)`` makes the sum independent of
    row order and partitioning (a double sum is not), so every engine and
    every retry returns the same bits. Digits past the 18th place are beyond
    it; a group sum of 1e20 or more raises an error. Missing values are
    skipped; a group with no values yields NULL.
    """
    x = _col(c)
    n = F.count(x)
    s = F.sum(x.cast("decimal(38,18)")).cast("double")
    return F.when(n > 0, s / n)


def fill_category(c, missing: str = MISSING_CODE) -> Column:
    """Missing answer -> the explicit "not answered" code."""
    return F.coalesce(_col(c), F.lit(missing))


def null_if_token(c, tokens=PANDAS_NA_TOKENS) -> Column:
    """String column: exact NA tokens -> NULL (no trimming, like pandas)."""
    x = _col(c)
    return F.when(x.isin(list(tokens)), F.lit(None).cast("string")).otherwise(x)
