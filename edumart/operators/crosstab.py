"""Answer-count cross-tabs (A3, A4, A5, P5).

The marts never pivot fact rows directly. Every question file is projected
to a narrow long form ``(keys..., question, code, counted)`` and all
questions are stacked with ``unionByName``. One hash aggregate over
``(keys, question, code)`` then counts everything: it is partial on the map
side (a hot course collapses to one row per code per map task before the
shuffle) and stays within whole-stage codegen because the rows are narrow.
Widening to one column per (question, code) happens last, on the already
aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edumart.functions.scalar import MISSING_CODE, fill_category
from edumart.operators.columns import drop_null_keys

QUESTION = "question"
CODE = "code"
COUNTED = "_counted"
N = "n"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sql_lit(v) -> str:
    """SQL literal of a question id (int) or a code / question name (str)."""
    if isinstance(v, int):
        return str(v)
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def answers_long(df: DataFrame, keys: Sequence[str], code, question: str | int,
                 counted=None, fill: str | None = MISSING_CODE) -> DataFrame:
    """One question source -> long rows. A missing answer becomes ``fill``;
    rows with a missing key are dropped (the original grouping drops them).
    ``counted`` is the column whose non-missing values are counted (K5).
    ``question`` is a name or a small integer id; an id keeps the shuffled
    key narrow (8 bytes in the row format instead of the string)."""
    code_col = fill_category(_c(code), fill) if fill is not None else _c(code)
    counted_col = _c(counted) if counted is not None else F.lit(1)
    qv = F.lit(question).cast("tinyint") if isinstance(question, int) else F.lit(question)
    out = df.select(*[F.col(k) for k in keys], qv.alias(QUESTION),
                    code_col.alias(CODE), counted_col.alias(COUNTED))
    return drop_null_keys(out, keys)


def count_long(long_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, question, code) -> n = number of non-missing counted values."""
    return long_df.groupBy(*keys, QUESTION, CODE).agg(F.count(COUNTED).alias(N))


def rollup(counts: DataFrame, mapping: DataFrame, from_key: str, to_key: str,
           keys: Sequence[str] = ()) -> DataFrame:
    """Re-key long counts through a unique ``from_key -> to_key`` mapping and
    sum (A5). Unmapped ``from_key`` values drop out, as do NULL targets."""
    m = drop_null_keys(mapping.select(*keys, from_key, to_key), [to_key])
    j = counts.join(m, [*keys, from_key], "inner")
    return j.groupBy(*keys, to_key, QUESTION, CODE).agg(F.sum(N).alias(N))


def widen(counts: DataFrame, keys: Sequence[str],
          cells: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Long counts -> one column per ``(question, code, column_name)``.

    A key with rows for a question gets 0 for that question's absent codes
    (pivot ``fill_value=0``); a key with no row at all for a question gets
    NULL in all its columns, as a left join of a per-question table would.
    Codes outside ``cells`` produce no column (see ``checks.domain_violations``).
    """
    # one SQL expression per cell: a single driver round trip each, which
    # matters for a hundred cells
    aggs = []
    for question, code, name in cells:
        q, c = _sql_lit(question), _sql_lit(code)
        aggs.append(F.expr(
            f"CASE WHEN count(CASE WHEN {QUESTION} = {q} THEN 1 END) > 0 "
            f"THEN coalesce(sum(CASE WHEN {QUESTION} = {q} AND {CODE} = {c} THEN {N} END), 0L) END"
        ).alias(name))
    return counts.groupBy(*keys).agg(*aggs)


def crosstab(df: DataFrame, keys: Sequence[str], code,
             cells: Sequence[tuple[str, str]], counted=None) -> DataFrame:
    """Single-question cross-tab in one aggregate: one conditional count per
    ``(code, column_name)``; a code that never occurs gives a column of 0."""
    code_col = _c(code)
    counted_col = _c(counted) if counted is not None else F.lit(1)
    aggs = [F.count(F.when(code_col == v, counted_col)).alias(name) for v, name in cells]
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def profile(df: DataFrame, keys: Sequence[str], means: Sequence[tuple[str, Column]] = (),
            cells: Sequence[tuple[Column, str, str]] = (), counted=None, places: int = 2,
            zero_fill: bool = False) -> DataFrame:
    """Per-key profile of a *wide* source in one hash aggregate: rounded exact
    means of ``means`` (name, column) and conditional counts for ``cells``
    (code column, code, output name).

    When the scores and several items sit in one table, this replaces the
    stacked long form (one scan, one exchange, partial on the map side).
    Sources split into one file per item use ``answers_long`` instead.
    Keep the cell count moderate: an aggregate with more than ~100 output
    fields leaves whole-stage codegen.
    """
    from edumart.functions.scalar import exact_mean, round_half_even

    counted_col = _c(counted) if counted is not None else F.lit(1)
    aggs = []
    for name, col in means:
        m = round_half_even(exact_mean(col), places)
        aggs.append((F.coalesce(m, F.lit(0.0)) if zero_fill else m).alias(name))
    for code_col, code, name in cells:
        aggs.append(F.count(F.when(_c(code_col) == code, counted_col)).alias(name))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


#: most codes one question may have; each becomes a column
MAX_CODES = 256


class CodeSetError(ValueError):
    """The codes found are too many, or do not fit their labels."""


def discover_codes(df: DataFrame, code, limit: int = MAX_CODES) -> list[str]:
    """The distinct codes of a column in code-point order, missing ones left out.

    ``df`` may be rows or their long counts (``count_long``), which are far
    fewer. At most ``limit + 1`` codes reach the driver; beyond ``limit`` the
    column is no answer code and is refused."""
    found = df.select(_c(code).cast("string").alias(CODE)).dropna().distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise CodeSetError(f"more than {limit} codes, among them {sorted(r[0] for r in found)[:5]}")
    return sorted(r[0] for r in found)


def label_by_position(codes: Sequence[str], labels: Sequence[str]) -> list[tuple[str, str]]:
    """``(code, label)``: the n-th code in order takes the n-th label. A code
    that never occurs would shift all labels after it, so both lists must be
    equally long, and labels must differ."""
    if len(codes) != len(labels):
        raise CodeSetError(f"{len(codes)} codes {list(codes)} for {len(labels)} labels {list(labels)}")
    if len(set(labels)) < len(labels):
        raise CodeSetError(f"labels repeat: {list(labels)}")
    return list(zip(codes, labels))


def crosstab_discovered(df: DataFrame, keys: Sequence[str], code, labels: Sequence[str] | None = None,
                        prefix: str = "", counted=None, limit: int = MAX_CODES,
                        fill: str | None = MISSING_CODE) -> DataFrame:
    """Cross-tab with a column per code that occurs beside a key, in code order:
    named by position from ``labels``, else ``prefix`` and the code. Rows
    without a key bring no code. An empty table has the key columns only."""
    rows = answers_long(df, keys, code, question=0, counted=counted, fill=fill)
    codes = discover_codes(rows, CODE, limit)
    named = label_by_position(codes, labels) if labels is not None else [(c, f"{prefix}{c}") for c in codes]
    counts = count_long(rows, keys)
    return widen(counts, keys, [(0, c, name) for c, name in named]) if named else counts.select(*keys).distinct()
