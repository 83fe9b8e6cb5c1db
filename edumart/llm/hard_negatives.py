"""Hard-negative mining with Fagin's threshold algorithm.

For an anchor and one of its positives (its best rows of the same label) the
hard negatives are the best rows of other labels whose score lies in a window
below the positive's score. Scores are integer inner products of the vectors
after ``floor(scale * x)``.

Within a block of rows every dimension has a sorted list of its rows. An anchor
reads each list from the end that its component's sign favours (dimensions
where it is zero add nothing and are not read). A row met for the first time in
any list is scored at once by random access to its whole vector. After a stride
the threshold is the score of a row that would have, in each dimension, the
value last read; no unread row can score more. A window is settled once the
threshold falls strictly below its k-th score (a tie could still win by its
smaller id) or below its lower bound. Strides double, so at most twice the needed
depth is read.

Scale: rows lie in blocks of at most about ``BLOCK_ROWS`` and anchors in blocks
of about ``BLOCK_ANCHORS``, both by id hash; every pair of blocks is one bounded
group: a stated query set against all rows, in blocks. A search for positives
pairs blocks of one label (a hot label has more blocks); the search for
negatives pairs blocks of all rows and skips the anchor's own label. Only each
block's k best go on, and their ranking per anchor and window is a distributed
window function over k rows a block. Counts of rows and of anchors are the only
values the driver sees.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; of rows that share an id the smallest
(label, vector) takes part; the shorter of two vectors counts as padded with
zeros; equal scores rank by id; an anchor without positives, and a window that
is empty or holds no row, give no rows; an empty table gives an empty result;
extra columns are not read. Scores are exact integers of any size within a
block and are stored as longs; a score beyond a long is stored as the nearest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edumart.llm.common import materialize, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90             # window in percent of the positive's score
ANCHOR_EVERY = 100
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 1024
STRIDE = 16                    # first stride of the sorted access

EXACT = 2 ** 53                # below it float64 holds integer inner products exactly
LONG = 2 ** 63 - 1


# ------------------------------------------------------- one block of rows

def quantise(vectors: list | np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` per component, as float64 where that is exact, else as Python integers."""
    x = np.asarray(vectors, np.float64)
    with np.errstate(over="ignore"):
        q = np.floor(x * SCALE)
    if not q.size or np.abs(q).max() < EXACT:
        return q
    exact = [math.floor(v * SCALE) if math.isfinite(v * SCALE) else int(v) * SCALE for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def _comparable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both padded to one width, and as Python integers if inner products need them."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    if a.size and b.size and width * int(np.abs(a).max()) * int(np.abs(b).max()) >= EXACT:
        a, b = (m if m.dtype == object else np.array([int(v) for v in m.ravel()], object).reshape(m.shape) for m in (a, b))
    return a, b


class Lists:
    """The rows of a block under sorted access by dimension and random access by row."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, 0)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple], k: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Per window (lowest, highest score) the allowed rows among which its
        ``k`` best are, ties of the k-th included; and the scores read."""
        m = len(self.rows)
        up = np.flatnonzero(anchor > 0)
        down = np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            up = np.array([0])                       # all scores are zero: any list has all rows
        seen, met = np.zeros(m, bool), np.zeros(m, bool)
        scores = np.zeros(m, self.rows.dtype)
        found: list = [None] * len(windows)
        depth, stride = 0, STRIDE
        while depth < m and any(f is None for f in found):
            end = min(m, depth + stride)
            met[self.order[m - end:m - depth, up]] = True
            met[self.order[depth:end, down]] = True
            new = np.flatnonzero(met & ~seen)
            scores[new] = self.rows[new] @ anchor
            seen[new] = True
            threshold = anchor[up] @ self.values[m - end, up] + anchor[down] @ self.values[end - 1, down]
            live = seen & allowed
            for w, (low, high) in enumerate(windows):
                if found[w] is None:
                    at = np.flatnonzero(live & (scores >= low) & (scores <= high))
                    kth = np.sort(scores[at])[-k] if len(at) >= k else None
                    if end == m or threshold < low or (kth is not None and threshold < kth):
                        found[w] = at if kth is None else at[scores[at] >= kth]
            depth, stride = end, 2 * stride
        return [np.zeros(0, int) if f is None else f for f in found], scores


def best(ids: np.ndarray, scores: np.ndarray, at: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(id, score) of the ``k`` best rows of ``at``: by score descending, then id."""
    ranked = sorted(zip((-scores[at]).tolist(), ids[at].tolist()))[:k]
    return [(i, int(-s)) for s, i in ranked]


def _long(score: int) -> int:
    return max(-LONG - 1, min(LONG, score))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.chunked_array(lists).combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes == sizes[0]).all():
        return quantise(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(sizes), sizes[0]))
    out = np.zeros((len(sizes), sizes.max(initial=0)))
    for r, v in enumerate(lists.to_pylist()):
        out[r, :len(v)] = v
    return quantise(out)


# ------------------------------------------------------------- Spark plan

def usable(rows: DataFrame, id_: str, label: Column | str, vector: str) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, one per id."""
    label = F.col(label) if isinstance(label, str) else label
    r = rows.select(F.col(id_).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    r = r.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    return r.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("vec_id"), parts)


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's ``k`` best other rows of its label."""
    def blocks(of: DataFrame, size: int, name: str) -> DataFrame:
        return of.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / size).alias(name))

    grid = blocks(rows, BLOCK_ROWS, "row_blocks").join(blocks(anchors, BLOCK_ANCHORS, "anchor_blocks"), "label")
    left = rows.join(grid, "label").select("label", _part(F.col("row_blocks")).alias("rb"),
                                           _each(F.col("anchor_blocks")).alias("ab"), "vec_id", "vec")
    right = anchors.join(grid, "label").select(F.col("label").alias("q_label"), _each(F.col("row_blocks")).alias("q_rb"),
                                               _part(F.col("anchor_blocks")).alias("q_ab"),
                                               F.col("vec_id").alias("q_id"), F.col("vec").alias("q_vec"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            data, queries = _comparable(_matrix(a["vec"]), _matrix(b["q_vec"]))
            ids, lists = a["vec_id"].to_numpy(), Lists(data)
            for q, me in zip(queries, b["q_id"].to_pylist()):
                (at,), scores = lists.search(q, ids != me, [(-math.inf, math.inf)], k)
                out += [(me, i, _long(s)) for i, s in best(ids, scores, at, k)]
        return _table(out, "anchor_id", "positive_id", "positive_score")

    found = left.groupBy("label", "rb", "ab").cogroup(right.groupBy("q_label", "q_rb", "q_ab")).applyInArrow(
        search, "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def negatives(rows: DataFrame, anchors: DataFrame, pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """For each (anchor, positive) of ``pairs`` the ``k`` best rows of other labels
    with ``low * positive_score <= 100 * score <= high * positive_score``, ranked."""
    asked = anchors.join(pairs.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("pairs"))   # POSITIVES at most
        .withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    row_blocks = F.lit(max(1, math.ceil(rows.count() / BLOCK_ROWS))).cast("long")
    anchor_blocks = F.lit(max(1, math.ceil(asked.count() / BLOCK_ANCHORS))).cast("long")
    left = rows.select(_part(row_blocks).alias("rb"), _each(anchor_blocks).alias("ab"), "vec_id", "label", "vec")
    right = asked.select(_each(row_blocks).alias("q_rb"), _part(anchor_blocks).alias("q_ab"), F.col("vec_id").alias("q_id"),
                         F.col("label").alias("q_label"), F.col("vec").alias("q_vec"), F.col("pairs.positive_id").alias("pid"), F.col("pairs.positive_score").alias("pscore"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            data, queries = _comparable(_matrix(a["vec"]), _matrix(b["q_vec"]))
            ids, labels, lists = a["vec_id"].to_numpy(), a["label"].to_numpy(), Lists(data)
            for q, me, label, pid, pscore in zip(queries, *(b[c].to_pylist() for c in ("q_id", "q_label", "pid", "pscore"))):
                windows = [(-(-low * s // 100), high * s // 100) for s in pscore]
                at, scores = lists.search(q, labels != label, windows, k)
                out += [(me, p, i, s, _long(n)) for p, s, w in zip(pid, pscore, at) for i, n in best(ids, scores, w, k)]
        return _table(out, "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")

    found = left.groupBy("rb", "ab").cogroup(right.groupBy("q_rb", "q_ab")).applyInArrow(
        search, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _table(rows: list[tuple], *names: str) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def mine(rows: DataFrame, id_: str, label: Column | str, vector: str, is_anchor: Column, k_positive: int = POSITIVES,
         k_negative: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``is_anchor`` is a condition on ``vec_id``."""
    data = materialize(usable(rows, id_, label, vector), "negatives-rows")
    anchors = data.filter(is_anchor)
    pairs = materialize(positives(data, anchors, k_positive), "negatives-positives")
    return negatives(data, anchors, pairs, k_negative, low, high).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    return mine(table(spark, sf_dir, "embeddings"), "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label),
                "embedding", F.col("vec_id") % ANCHOR_EVERY == 0)


ORACLE = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
c AS (SELECT vec_id, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS d FROM r),
bad AS (SELECT DISTINCT vec_id FROM c WHERE x IS NULL OR NOT isfinite(x)),
w AS (SELECT vec_id, list(CASE WHEN isfinite(x) THEN floor(256 * x) END ORDER BY d) AS v FROM c GROUP BY vec_id),
q AS (SELECT vec_id, label, list_resize(coalesce(v, []::DOUBLE[]), (SELECT greatest(max(len(e)), 1) FROM r), 0.0::DOUBLE) AS v
  FROM r LEFT JOIN w USING (vec_id) WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS s
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b AS pos, s.b AS neg, p.s AS ps, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.s <= 100 * s.s AND 100 * s.s <= 90 * p.s)
SELECT a AS anchor_id, pos AS positive_id, rank::INTEGER AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE rank <= 10
"""
