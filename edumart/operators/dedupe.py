"""Keep-first de-duplication.

``dropDuplicates`` keeps an arbitrary row per key; the marts need the *first*
row in input order. The order is an explicit ordinal column (file order from
``sources.with_file_ordinal``, or any business column such as an event id),
and the winner is picked with ``min_by`` inside a hash aggregate: the
aggregate is partial on the map side, so a key holding a third of all rows
still ships one candidate per map task, never the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edumart.functions.scalar import qcol

ORDINAL = "_ordinal"


def dedupe_first(df: DataFrame, keys: str | Sequence[str], order: str = ORDINAL,
                 keep_order_col: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` value.

    Rows with a NULL key form one group (like pandas ``drop_duplicates``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys]
    if order not in df.columns:
        raise ValueError(f"ordinal column {order!r} not in {df.columns}")
    winner = F.min_by(F.struct(*[qcol(c) for c in payload]), qcol(order))
    out = df.groupBy(*keys).agg(winner.alias("_first")).select(
        *keys, *[F.col("_first")[c].alias(c) for c in payload])
    cols = [c for c in df.columns if keep_order_col or c != order]
    return out.select(*[qcol(c) for c in cols])
