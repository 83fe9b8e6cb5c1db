"""Embedding near-dedup: cover-tree dual traversal with exact threshold pairs.

Unit vectors with cosine >= t lie within ``tau = sqrt(2 - 2 t)`` of each other,
so the pairs are found by a metric tree:

1. Equal vectors of a label collapse into a class (hash aggregate).
2. Upper levels: from a bounded sample per label (``SAMPLE_PER_LABEL``) nested
   nets with halving radii give routing centres, kept as a table; blocks of a
   label's classes meet its centres in one task each, a class goes to its nearest
   centre and every node learns its exact covering radius. Nodes of one label
   whose centres lie further apart than both radii plus ``tau`` are pruned;
   each remaining pair of nodes is one task. Nodes above ``node_rows`` are cut
   into blocks first, so no task grows with a hot label.
3. In a task each side is built into a cover tree (levels of halving radii,
   exact covering radii), and the two trees are traversed together: a pair of
   nodes is dropped when the distance of their centres exceeds both radii plus
   ``tau``. What reaches single vectors is decided by the cosine in double
   precision.
4. Out of a task come link counts per class and a spanning forest of the links,
   never all pairs; components by randomised contraction.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing and stay their own
component; vectors of different lengths never link; repeated rows are vectors
that link with each other; a null id never becomes ``component_id`` unless all
ids of the component are null; vectors are scaled by a power of two before
any product, so components of any magnitude neither overflow nor vanish; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import components, forest, materialize, table

THRESHOLD = 0.98
NODE_ROWS = 4096
SAMPLE_PER_LABEL = 512         # rows per label, up to twice that on average, that place its centres
ROUTE_ROWS = 16384             # classes routed by one task
TOP_RADIUS = 2.0               # the unit sphere's diameter covers everything
LOW_RADIUS = 0.125             # below it a tree node is a leaf
SLACK = 1e-7                   # bounds are widened by it against rounding


# ---------------------------------------------------------------- local tree

class Tree:
    """Cover tree over the rows of ``u`` (unit vectors): node arrays ``centre``
    (row), ``radius`` (exact covering radius), children, and the leaf's rows."""

    def __init__(self, u: np.ndarray):
        self.u, self.centre, self.radius, self.children, self.rows = u, [], [], [], []
        self.root = self._node(np.arange(len(u)), 0, np.linalg.norm(u - u[0], axis=1), TOP_RADIUS)

    def _node(self, rows: np.ndarray, c: int, dist: np.ndarray, level: float) -> int:
        me = len(self.centre)
        self.centre.append(c)
        self.radius.append(float(dist.max(initial=0.0)))
        self.children.append(())
        self.rows.append(rows)
        if len(rows) > 1 and level > LOW_RADIUS:
            half, kids, left = level / 2, [], rows
            near = dist
            centre = c
            while len(left):
                inside = near <= half
                kids.append((left[inside], centre, near[inside]))
                left = left[~inside]
                if len(left):
                    centre = int(left[0])
                    near = np.sqrt(np.maximum(0.0, 2 - 2 * (self.u[left] @ self.u[centre])))
                    near[0] = 0.0
            self.children[me] = [self._node(r, c_, d, half) for r, c_, d in kids]
            self.rows[me] = rows[:0]
        return me


def dual_pairs(a: Tree, b: Tree, tau: float):
    """Yield (rows of a, rows of b) of leaf pairs that the bounds cannot exclude.
    With ``a is b`` every unordered pair of leaves comes once."""
    same = a is b
    ca, cb = np.array(a.centre), np.array(b.centre)
    ra, rb = np.array(a.radius), np.array(b.radius)
    todo = [(np.array([a.root]), np.array([b.root]))]
    while todo:
        x, y = todo.pop()
        d = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("ij,ij->i", a.u[ca[x]], b.u[cb[y]])))
        live = d <= ra[x] + rb[y] + tau + SLACK
        next_ = []
        for p, q in zip(x[live].tolist(), y[live].tolist()):
            kp, kq = a.children[p], b.children[q]
            if not kp and not kq:
                yield a.rows[p], b.rows[q]
                continue
            kp, kq = np.array(kp or [p]), np.array(kq or [q])
            i, j = _close(a.u[ca[kp]], ra[kp], b.u[cb[kq]], rb[kq], tau)
            if same and p == q:
                i, j = i[i <= j], j[i <= j]
            next_.append((kp[i], kq[j]))
        if next_:
            todo.append((np.concatenate([n[0] for n in next_]), np.concatenate([n[1] for n in next_])))


def _close(u, ru, v, rv, tau, step=512):
    """Index pairs of centres within both radii plus tau, block by block."""
    out_i, out_j = [], []
    for lo in range(0, len(u), step):
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (u[lo:lo + step] @ v.T)))
        i, j = np.nonzero(d <= ru[lo:lo + step, None] + rv[None] + tau + SLACK)
        out_i.append(i + lo)
        out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component lies in [0.5, 1)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def task_links(raw_a: np.ndarray, raw_b: np.ndarray | None, t: float) -> tuple[np.ndarray, np.ndarray]:
    """All links (i in a, j in b) with cosine >= t; ``raw_b`` None: within a, i < j."""
    tau = math.sqrt(2 - 2 * t)
    raw_a, raw_b = scaled(raw_a), None if raw_b is None else scaled(raw_b)
    na = np.sqrt(np.einsum("ij,ij->i", raw_a, raw_a))
    a = Tree(raw_a / na[:, None])
    raw_o, no, b = (raw_a, na, a) if raw_b is None else (
        raw_b, nb := np.sqrt(np.einsum("ij,ij->i", raw_b, raw_b)), Tree(raw_b / nb[:, None]))
    out_i, out_j, one_i, one_j = [], [], [], []
    for p, q in dual_pairs(a, b, tau):
        if len(p) == len(q) == 1:
            one_i.append(p[0])
            one_j.append(q[0])
            continue
        for lo in range(0, len(p), 1024):
            i, j = np.nonzero((raw_a[p[lo:lo + 1024]] @ raw_o[q].T) >= t * na[p[lo:lo + 1024], None] * no[q][None] * (1 - 1e-12))
            out_i.append(p[lo:lo + 1024][i])
            out_j.append(q[j])
    i = np.concatenate([np.array(one_i, np.int64), *out_i])
    j = np.concatenate([np.array(one_j, np.int64), *out_j])
    exact = np.concatenate([np.einsum("ij,ij->i", raw_a[i[lo:lo + 65536]], raw_o[j[lo:lo + 65536]])
                            / (na[i[lo:lo + 65536]] * no[j[lo:lo + 65536]]) >= t
                            for lo in range(0, max(1, len(i)), 65536)])
    i, j = i[exact], j[exact]
    if raw_b is None:                       # inside one leaf both orders and the row itself came
        i, j = np.minimum(i, j), np.maximum(i, j)
        both = np.unique(i[i < j] * len(raw_a) + j[i < j])
        i, j = both // len(raw_a), both % len(raw_a)
    return i, j


# ---------------------------------------------------------------- upper levels

def nets(u: np.ndarray, wanted: int) -> np.ndarray:
    """Routing centres of one label from its sample of unit vectors: nets of halving
    radii, finer until there are as many centres as nodes wanted (cut to that number)."""
    radius, centres = TOP_RADIUS, u[:1]
    while len(centres) < wanted and radius > LOW_RADIUS:
        radius /= 2
        picked = [0]
        for k in range(1, len(u)):
            if len(picked) >= wanted:
                break
            if np.sqrt(np.maximum(0, 2 - 2 * (u[picked] @ u[k]))).min() > radius:
                picked.append(k)
        centres = u[picked]
    return centres


def unit_rows(tab: pa.Table) -> np.ndarray:
    """Unit vectors of the column v, whose lists are of one length."""
    u = scaled(tab.column("v").combine_chunks().flatten().to_numpy().reshape(tab.num_rows, -1))
    return u / np.linalg.norm(u, axis=1)[:, None]


def place_centres(tab: pa.Table) -> pa.Table:
    """One label's sample (grp, node, nodes wanted, v) to its centres (grp, home, v)."""
    tab = tab.sort_by("node")
    c = nets(unit_rows(tab), tab.column("wanted")[0].as_py())
    return pa.table({"grp": pa.array([tab.column("grp")[0].as_py()] * len(c), pa.string()),
                     "home": pa.array(np.arange(len(c), dtype=np.int32)), "v": pa.array(list(c), pa.list_(pa.float64()))})


def centre_distances(tab: pa.Table) -> pa.Table:
    """Distances (grp, home, home2, d) of one label's centres, home < home2."""
    u, home = unit_rows(tab), tab.column("home").to_numpy()
    i, j = np.nonzero(home[:, None] < home[None])
    d = np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("ij,ij->i", u[i], u[j])))
    return pa.table({"grp": pa.array([tab.column("grp")[0].as_py()] * len(i), pa.string()),
                     "home": home[i], "home2": home[j], "d": d})


def route(rows: pa.Table, centres: pa.Table) -> pa.Table:
    """Each class of a block to its nearest centre."""
    home, dist = np.zeros(rows.num_rows, np.int32), np.full(rows.num_rows, TOP_RADIUS)
    if rows.num_rows and centres.num_rows:
        u, c, names = unit_rows(rows), unit_rows(centres), centres.column("home").to_numpy()
        for lo in range(0, len(u), 2048):
            d = np.sqrt(np.maximum(0, 2 - 2 * (u[lo:lo + 2048] @ c.T)))
            home[lo:lo + 2048], dist[lo:lo + 2048] = names[d.argmin(1)], d.min(1)
    return pa.table({"node": rows.column("node"), "grp": rows.column("grp"), "home": pa.array(home),
                     "dist": pa.array(dist), "v": rows.column("v"), "n_rows": rows.column("n_rows")})


def near_links(classes: DataFrame, t: float = THRESHOLD, node_rows: int = NODE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``classes`` (node, grp, v: array<double>, n_rows), materialised. Returns
    (node, n_linked rows of other classes) and edges (a, b)."""
    tau = math.sqrt(2 - 2 * t)
    # labels that need more than one node
    big = materialize(classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > node_rows), "cover-labels")
    large = classes.select("node", "grp", "v", "n_rows").join(big, "grp")
    drawn = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("n") / SAMPLE_PER_LABEL))) == 0
    centres = materialize(large.filter(drawn).select(
        "grp", "node", F.ceil(F.col("n") / F.lit(node_rows)).alias("wanted"), "v")
        .groupBy("grp").applyInArrow(place_centres, "grp string, home int, v array<double>"), "cover-centres")
    cdist = materialize(centres.groupBy("grp").applyInArrow(
        centre_distances, "grp string, home int, home2 int, d double"), "cover-distances")
    parts = F.ceil(F.col("n") / F.lit(ROUTE_ROWS)).cast("int")
    routed = large.withColumn("part", F.pmod(F.xxhash64("node", F.lit(2)), parts).cast("int")).drop("n") \
        .groupBy("grp", "part").cogroup(
            centres.join(big, "grp").select("grp", "home", "v", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
            .groupBy("grp", "part")) \
        .applyInArrow(route, "node long, grp string, home int, dist double, v array<double>, n_rows long")
    whole = classes.join(big, "grp", "left_anti").select(
        "node", "grp", F.lit(0).alias("home"), F.lit(TOP_RADIUS).alias("dist"), "v", "n_rows")
    placed = materialize(whole.unionByName(routed), "cover-placed")
    homes = placed.groupBy("grp", "home").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n"))
    k = F.ceil(F.col("n") / F.lit(node_rows)).cast("int")
    nodes = materialize(homes.withColumn("k", k), "cover-nodes")
    single = nodes.select("grp", "home", F.col("home").alias("home2"), "k", F.col("k").alias("k2"))
    other = nodes.select("grp", F.col("home").alias("home2"), F.col("r").alias("r2"), F.col("k").alias("k2"))
    pairs = nodes.join(cdist, ["grp", "home"]).join(other, ["grp", "home2"]) \
        .filter(F.col("d") <= F.col("r") + F.col("r2") + F.lit(tau + SLACK)).select("grp", "home", "home2", "k", "k2")
    # node pairs, then the blocks of both: one task each
    todo = single.unionByName(pairs) \
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("k") - 1))) \
        .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("k2") - 1))) \
        .filter((F.col("home") != F.col("home2")) | (F.col("x") <= F.col("y"))).drop("k", "k2")
    todo = materialize(todo.withColumn("task", F.monotonically_increasing_id()), "cover-tasks")
    sides = todo.select("grp", F.col("home"), F.col("x").alias("block"), "task", F.lit(0).alias("side"),
                        ((F.col("home") == F.col("home2")) & (F.col("x") == F.col("y"))).alias("own")) \
        .unionByName(todo.filter("home <> home2 or x <> y").select(
            "grp", F.col("home2").alias("home"), F.col("y").alias("block"), "task", F.lit(1).alias("side"), F.lit(False).alias("own")))
    blocked = placed.join(nodes.select("grp", "home", "k"), ["grp", "home"]) \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    work = blocked.join(sides, ["grp", "home", "block"]).select("task", "side", "own", "node", "v", "n_rows")

    def compare(tab: pa.Table) -> pa.Table:
        side, node = tab.column("side").to_numpy(), tab.column("node").to_numpy().astype(np.int64)
        rows, col = tab.column("n_rows").to_numpy(), tab.column("v").combine_chunks()
        v = col.flatten().to_numpy().reshape(len(node), -1)
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        empty = pa.table({"node": np.zeros(0, np.int64), "linked": np.zeros(0, np.int64), "to": np.zeros(0, np.int64)})
        if tab.column("own")[0].as_py():
            i, j = task_links(v[a], None, t)
            i, j = a[i], a[j]
        elif len(a) and len(b):
            i, j = task_links(v[a], v[b], t)
            i, j = a[i], b[j]
        else:
            return empty
        linked = np.bincount(i, rows[j], len(node)) + np.bincount(j, rows[i], len(node))
        to = np.arange(len(node))
        fi, fj = forest(len(node), i, j)
        to[fi] = fj
        hit = np.flatnonzero(linked)
        return pa.table({"node": node[hit], "linked": linked[hit].astype(np.int64), "to": node[to[hit]]})

    found = materialize(work.groupBy("task").applyInArrow(compare, "node long, linked long, to long"), "cover-links")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    return linked, found.filter("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b"))


def near_duplicates(df: DataFrame, vec_id: str, embedding: str, label: str, t: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    v = F.col(embedding).cast("array<double>")
    big = F.lit(float("inf"))
    sound = F.coalesce((F.size(v) > 0) & F.col(label).isNotNull()
                       & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
                       & F.exists(v, lambda x: x != 0), F.lit(False))
    # vectors compare within (label, length); 0.0 and -0.0 are one value as group keys
    rows = df.select(F.col(vec_id).alias("vec_id"), F.when(sound, F.concat_ws(
        "/", F.col(label).cast("string"), F.size(v).cast("string"))).alias("grp"), F.when(sound, F.transform(v, lambda x: x + 0.0)).alias("v"))
    classes = materialize(rows.filter("grp is not null").groupBy("grp", "v").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()), "embedding-classes")
    linked, edges = near_links(classes, t)
    comp = components(edges, "embedding-cc")
    member = classes.select("node", "n_rows", "first_id", "grp", F.xxhash64("v").alias("vh"), "v") \
        .join(linked, "node", "left").join(comp.withColumnRenamed("v", "node"), "node", "left") \
        .withColumn("root", F.coalesce("root", F.xxhash64("node")))
    firsts = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    info = member.join(firsts, "root").select(
        "grp", "vh", "v", (F.col("n_rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    out = rows.withColumn("vh", F.xxhash64("v")).join(info, ["grp", "vh", "v"], "left")
    comp_id = F.when(F.col("grp").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CASE WHEN top BETWEEN 1e-100 AND 1e100 THEN e ELSE list_transform(e, lambda x: x / top) END AS e FROM (
    SELECT vec_id, label, embedding, embedding::DOUBLE[] AS e,
      list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) AS top FROM embeddings)
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp ON comp.a = e.vec_id LEFT JOIN deg ON deg.a = e.vec_id"""
