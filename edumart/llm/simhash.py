"""SimHash near-dedup with vantage-point trees.

Fingerprint: XXH64 (seed 42) of every word shingle, repeats included; a bit is
one if it is one in more than half of the hashes.

Links (Hamming distance at most ``max_bits``) are found exactly:

1. Equal fingerprints collapse into one class (hash aggregate with map-side
   combining: a third of all rows in one class is one row afterwards).
2. A vantage-point tree is fitted on a bounded sample of classes
   (``SAMPLE_PER_SHARD`` per leaf): each node holds a vantage fingerprint and
   a radius, the median distance. It decides balance only, never results.
3. Every class walks down the tree: inside if its distance to the vantage point
   is at most the radius, else outside. If ``x`` is inside and ``y`` outside
   with ``d(x, y) <= max_bits``, the triangle inequality puts ``x`` within
   ``max_bits`` of the boundary; those also go outside. So any linked pair
   shares a leaf (shard).
4. Inside a shard the same tree is continued to small leaves, whose pairs are
   compared. Only a spanning forest of the links found leaves the task, never
   all pairs of a group. Shards above ``DENSE * shard_rows`` (dense groups that
   no radius can split) are cut into blocks, and every pair of blocks is a task.
5. Components by randomised contraction (``common.components``).

Defined results: a null text is empty; a text without words has fingerprint
zero, linked like any other; repeated rows are rows; ``component_id`` is the
smallest non-null id of the component (null if it has none); an empty table
gives an empty result; extra columns are ignored by ``near_duplicates`` and
pass through ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import components, forest, fresh, materialize, table, word_chunks

SHINGLE_WORDS = 3
MAX_BITS = 3
SHARD_ROWS = 32_768            # fingerprints per leaf before boundary copies; 8 bytes each
DENSE = 4                      # shards above DENSE * SHARD_ROWS are cut into blocks
SAMPLE_PER_SHARD = 64
MAX_SAMPLE = 65_536            # bound of the rows fetched to fit the routing tree
LEAF = 256
RUN = 65_536                   # shingle hashes held at a time
CHUNK = 1 << 20                # bytes of a text taken into words at a time


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """SimHash of a whole text as an unsigned 64-bit number."""
    total, n, tail, whole = np.zeros(64, np.int64), 0, [], True
    for words in word_chunks((text or "").encode().lower(), CHUNK):     # bytes: A-Z and ASCII spaces only
        words = tail + words
        if len(words) >= k:
            found, tail, whole = _votes(words, k, total), words[len(words) - k + 1:], False
            n += found
        else:
            tail = words
    if whole:
        if not tail:
            return 0
        n = _votes(tail, len(tail), total)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _votes(words: list[bytes], k: int, total: np.ndarray) -> int:
    """Add the bits of the hashes of all runs of ``k`` words to ``total``; their number."""
    from xxhash import xxh64_intdigest
    joined, at, starts = b" ".join(words), 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[k:]] + [len(joined)]
    view, n = memoryview(joined), len(ends)
    for lo in range(0, n, RUN):
        h = np.fromiter((xxh64_intdigest(view[a:b], 42) for a, b in zip(starts[lo:lo + RUN], ends[lo:lo + RUN])),
                        np.uint64, min(RUN, n - lo))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return n


def fingerprints(docs: DataFrame, text: str, into: str, k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint as a (signed) long column ``into``."""
    @F.arrow_udf("long")
    def udf(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((fingerprint(t.as_py(), k) for t in texts), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))
    return docs.withColumn(into, udf(F.col(text)))


# ------------------------------------------------------------ vantage-point tree

def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree, nodes 1 .. 2**depth - 1 in
    heap order. A node without sample rows keeps radius 64: all go inside."""
    vantage, radius = np.zeros(1 << depth, np.uint64), np.full(1 << depth, 64, np.int64)
    held = {1: sample}
    for node in range(1, 1 << depth):
        rows = held.pop(node, sample[:0])
        if len(rows) < 2:
            continue
        vantage[node] = rows[0]
        d = np.bitwise_count(rows ^ rows[0]).astype(np.int64)
        radius[node] = r = int(np.median(d))
        held[2 * node], held[2 * node + 1] = rows[d <= r], rows[d > r]
    return vantage, radius


def route(fp: np.ndarray, vantage: np.ndarray, radius: np.ndarray, depth: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for all leaves each fingerprint belongs to."""
    row, node = np.arange(len(fp)), np.ones(len(fp), np.int64)
    for _ in range(depth):
        d = np.bitwise_count(fp[row] ^ vantage[node]).astype(np.int64)
        inside = d <= radius[node]
        both = inside & (d > radius[node] - bits)
        row, node = np.concatenate((row, row[both])), np.concatenate((2 * node + ~inside, 2 * node[both] + 1))
    return row, node


def local_links(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links within ``bits`` among ``fp`` (positions)."""
    found_i, found_j, todo = [], [], [(np.arange(len(fp)), 0)]
    while todo:
        rows, tries = todo.pop()
        if len(rows) <= LEAF or tries >= 4:
            # a leaf, or rows that four vantage points could not part: blocks of rows against all
            for lo in range(0, len(rows), LEAF):
                near = np.bitwise_count(fp[rows[lo:lo + LEAF], None] ^ fp[rows][None, lo:]) <= bits
                a, b = np.nonzero(near)
                keep = a < b
                i, j = forest(len(rows) - lo, a[keep], b[keep])
                found_i.append(rows[lo:][i])
                found_j.append(rows[lo:][j])
            continue
        v = fp[rows[(len(rows) * (2 * tries + 1)) // 8]]
        d = np.bitwise_count(fp[rows] ^ v).astype(np.int64)
        r = int(np.median(d))
        if r == d.max():
            r -= 1
        inside, out = rows[d <= r], rows[d > r - bits]
        if max(len(inside), len(out)) > 0.9 * len(rows):
            todo.append((rows, tries + 1))
        else:
            todo += [(inside, 0), (out, 0)]
    i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
    j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
    return forest(len(fp), i, j)


def links(classes: DataFrame, fp: str = "fp", bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints whose components are
    those of all pairs within ``bits``. ``classes``: one row per fingerprint,
    materialised."""
    n = classes.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / shard_rows * 2)))
    take = min(MAX_SAMPLE, SAMPLE_PER_SHARD << depth)
    sample = [r[0] for r in classes.select(fp).orderBy(F.xxhash64(fp)).limit(take).collect()] if depth else []
    vantage, radius = fit_tree(np.array(sample, np.int64).view(np.uint64), depth)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            row, leaf = route(prints.view(np.uint64), vantage, radius, depth, bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(prints[row])], names=["shard", "fp"])

    placed = materialize(classes.select(F.col(fp).alias("fp")).mapInArrow(walk, "shard long, fp long"), "simhash-shards")
    # blocks of each shard: one row per shard (at most 2**depth), joined by Spark
    sizes = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(DENSE * shard_rows)).cast("int").alias("k"))
    block = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    tasks = placed.join(sizes, "shard").withColumn("own", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "shard", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")

    def compare(t: pa.Table) -> pa.Table:
        prints = t.column("fp").to_numpy().astype(np.int64)
        i, j = local_links(prints.view(np.uint64), bits)
        return pa.table({"a": prints[i], "b": prints[j]})

    # comparing costs far more than reading: a stated number of partitions, or small
    # shuffles would be merged by bytes into few long tasks
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << depth)
    tasks = tasks.repartition(parts, "shard", "x", "y")
    return materialize(tasks.groupBy("shard", "x", "y").applyInArrow(compare, "a long, b long"), "simhash-links")


def near_duplicates(prints: DataFrame, doc_id: str, fp: str, bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id, n_rows, rank_fp): one row per distinct fingerprint.
    ``rank_fp`` is the fingerprint whose rows hold the component's first document."""
    classes = materialize(prints.groupBy(F.col(fp).alias("fp")).agg(
        F.min(doc_id).alias("first_id"), F.count(F.lit(1)).alias("n_rows")), "simhash-classes")
    comp = components(links(classes, "fp", bits), "simhash-cc")
    member = classes.join(comp.withColumnRenamed("v", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", F.xxhash64("fp")))
    # min of a struct: nulls of first_id sort last
    first = F.min(F.struct(F.col("first_id").isNull().alias("n"), F.col("first_id").alias("i"), F.col("fp").alias("f")))
    groups = member.groupBy("root").agg(first.alias("w")).select(
        "root", F.col("w.i").alias("component_id"), F.col("w.f").alias("rank_fp"))
    return member.join(groups, "root").select("fp", "component_id", "n_rows", "rank_fp")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         k: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One document of each component of near copies, with its own columns: the
    one with the smallest id (null ids last; of rows equal in id, one)."""
    own, n = fresh(docs, "sim_text", "sim_rows")
    # a text is fingerprinted once; its rows are found again by id and a hash that needs no Python
    slim = materialize(fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("h")), "t", "fp", k)
                       .drop("t"), "simhash-prints")
    kept = near_duplicates(slim, "id", "fp", bits).filter("fp = rank_fp").select("fp", F.col("component_id").alias("w_id"))
    # the rows of the winning fingerprint that carry the winning id, nearly always one; of several texts the first by hash
    rows = slim.join(kept, "fp").filter(F.col("id").eqNullSafe(F.col("w_id"))).groupBy("w_id", "fp", "h") \
        .agg(F.count(F.lit(1)).alias("c")).groupBy("w_id", "fp").agg(F.min(F.struct("h", "c")).alias("w")) \
        .select("w_id", F.col("w.h").alias("w_h"), F.col("w.c").alias(n))
    won = docs.withColumn(own, F.xxhash64(text)).join(
        materialize(rows, "simhash-kept"), F.col(doc_id).eqNullSafe(F.col("w_id")) & (F.col(own) == F.col("w_h")))
    single = won.filter(F.col(n) == 1).select(*docs.columns)
    again = won.filter(F.col(n) > 1).dropDuplicates(["w_id", "w_h"]).select(*docs.columns)
    return single.unionByName(again)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = materialize(fingerprints(docs, "text", "fp").select("doc_id", "fp"), "simhash-prints")
    comp = near_duplicates(prints, "doc_id", "fp")
    return prints.join(comp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
