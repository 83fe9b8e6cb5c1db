"""One-pass accounting of a scan (S1, V1, V2): what a landing write saw of each
delivered file, counted by the write itself.

Every file's frame carries observed metrics, so the one job that parses the
text and writes it also counts its rows, records of the wrong width and values
without their type; the text is not parsed again to count what it rejected. The
write has no shuffle below the metrics, so a task that is run again
counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from edumart.operators.union import union_editions
from edumart.sources.delimited import BROKEN, LONG, REJECTED, SHORT

COUNTS = ("n_rows", "n_short", "n_long", "n_broken", "n_unreadable")


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` (read with ``rejects=True``) with counters on it: its rows, too short,
    too long and otherwise broken records, and records with an unreadable value."""
    o, r = Observation(), F.col(REJECTED)
    width = [F.array_contains(r, x) for x in (SHORT, LONG, BROKEN)]
    value = F.exists(r, lambda x: ~x.isin(SHORT, LONG, BROKEN))
    counts = [F.count(F.lit(1)), *[F.count_if(w) for w in width], F.count_if(value)]
    return df.observe(o, *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(counts, COUNTS)]), o


def land_counted(files: Mapping[str, DataFrame], write: Callable[[DataFrame], object]) -> dict[str, dict[str, int]]:
    """Stack the frames of the delivered files by name, hand them to ``write``
    (one action), and return each file's counts from that action."""
    frames, counters = [], {}
    for name, df in files.items():
        df, counters[name] = observed(df)
        frames.append(df)
    write(union_editions(frames))
    return {name: {n: int(o.get[n]) for n in COUNTS} for name, o in counters.items()}
