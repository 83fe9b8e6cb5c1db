"""Best-fit packing of documents into token bins under conflicts.

A bin holds ``capacity`` tokens and carries two bitmaps: the sources and the
duplicate clusters already in it. A piece goes to the bin with the smallest
residual that is large enough and whose bitmaps do not contain the piece's
source or cluster; if there is none it opens a bin. Pieces come by falling
length (ties by id, then piece). A document longer than a bin is cut into
pieces of ``capacity``; each full piece fills a bin, the rest is packed.

The residual-ordered structure is a segment tree over residuals: leaf ``r``
lists the bins with ``r`` tokens left, each inner node keeps the intersection
of the bitmaps below it. The successor search descends to the leftmost leaf at
or right of the length whose intersections lack both bits, checks its bins in
opening order and continues to the next leaf until a compatible bin is found.

``op1_best_fit_packing`` clusters near copies: texts whose ``SHINGLE`` word
shingles agree to 0.8 or more meet in one of ``BANDS`` MinHash bands with a chance
of 99.7 % (at 0.6: 42 %, at 0.5: 12 %; a pair that meets only parts bins), and
clusters are the connected components (``pack_apart``). ``pack`` itself takes
exact copies up to letter case and spacing, or the clusters it is given.

Scale: the texts are read once, chunk by chunk, for words, cluster and bands.
Bands are one row per document and band; each leads to the smallest
text of its band (map-side combining), never to all pairs. Pieces are dealt to shards of about ``shard_docs`` documents by a hash of
id and text, so neither a hot source nor a cluster of copies makes a hot shard;
bins never span shards. Tasks see lengths and codes, no texts.

Defined results: a null text is its end token; a null source or cluster
conflicts with nothing; repeated rows are documents (and share a cluster, so
they never share a bin); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import ascii_lower, components, materialize, space_words, table, word_chunks

CAPACITY = 2048
SHARD_DOCS = 8192
SHINGLE, BANDS, BAND_ROWS = 5, 32, 8
SHINGLES_HELD = 512            # shingles of a text looked at a time: half a MB of hashes, which stays in a core's cache
CHUNK = 1 << 20                # bytes of a text taken into words at a time
LONG_WORD = 4096               # longer words count by their hash
BASE = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2**64


class Bins:
    """Open bins ordered by residual, with source and cluster bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.width = 1 << capacity.bit_length()              # leaves for residuals 0 .. capacity
        self.at: list[list[int]] = [[] for _ in range(self.width)]
        self.src_all, self.clu_all = [-1] * (2 * self.width), [-1] * (2 * self.width)   # -1: no bin here
        self.src: list[int] = []
        self.clu: list[int] = []
        self.left: list[int] = []

    def _refresh(self, r: int) -> None:
        s = c = -1
        for b in self.at[r]:
            s &= self.src[b]
            c &= self.clu[b]
            if not s and not c:
                break
        i = r + self.width
        src, clu = self.src_all, self.clu_all
        src[i], clu[i] = s, c
        while i > 1:
            i >>= 1
            s, c = src[2 * i] & src[2 * i + 1], clu[2 * i] & clu[2 * i + 1]
            if src[i] == s and clu[i] == c:
                break
            src[i], clu[i] = s, c

    def _leaf(self, lo: int, s: int, c: int) -> int | None:
        """Leftmost residual >= ``lo`` whose intersections lack both bits (an
        empty leaf has all bits, a zero bit matches any leaf with bins)."""
        src, clu = self.src_all, self.clu_all
        ok = lambda i: src[i] != -1 and not src[i] & s and not clu[i] & c
        may = lambda i: (src[i] != -1 or clu[i] != -1) and not src[i] & s and not clu[i] & c
        i = lo + self.width
        if i >= 2 * self.width:
            return None
        while True:
            if may(i):
                while i < self.width:
                    i *= 2
                    if not may(i):
                        i += 1
                if ok(i):
                    return i - self.width
            # next subtree to the right
            while i & 1:
                i >>= 1
                if i <= 1:
                    return None
            if i <= 1:
                return None
            i += 1

    def place(self, n: int, s: int, c: int) -> tuple[int, int]:
        """Put a piece of ``n`` tokens with source bit ``s`` and cluster bit
        ``c`` (0: none): (bin, offset)."""
        r = self._leaf(n, s, c)
        while r is not None:
            for k, b in enumerate(self.at[r]):
                if not self.src[b] & s and not self.clu[b] & c:
                    del self.at[r][k]
                    self._refresh(r)
                    return self._put(b, n, s, c)
            r = self._leaf(r + 1, s, c)
        self.src.append(0)
        self.clu.append(0)
        self.left.append(self.capacity)
        return self._put(len(self.left) - 1, n, s, c)

    def _put(self, b: int, n: int, s: int, c: int) -> tuple[int, int]:
        offset = self.capacity - self.left[b]
        self.src[b] |= s
        self.clu[b] |= c
        self.left[b] = r = self.left[b] - n
        bins = self.at[r]
        k = len(bins)
        while k and bins[k - 1] > b:
            k -= 1
        bins.insert(k, b)
        self._refresh(r)
        return b, offset


def codes(values: list) -> list[int]:
    """One bit per distinct value that occurs more than once, 0 for the others and for nulls."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    bit = {v: 1 << k for k, v in enumerate(v for v, n in seen.items() if n > 1 and v is not None)}
    return [bit.get(v, 0) for v in values]


def pack_shard(n: list[int], source: list, cluster: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for pieces that come in packing order."""
    bins, s, c = Bins(capacity), codes(source), codes(cluster)
    return [bins.place(*x) for x in zip(n, s, c)]


def cluster_key(text: Column) -> Column:
    """Exact copies up to letter case and spacing share a cluster."""
    return F.xxhash64(F.concat_ws(" ", space_words(ascii_lower(text))))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, np.uint64(base & (1 << 64) - 1))
    out[:1] = 1
    return np.cumprod(out)


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """32-bit hashes of the runs of SHINGLE words (of all words, if fewer)."""
    if not words:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(SHINGLE, len(words))
    a, b = starts[:len(words) - k + 1], ends[k - 1:]
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * powers(BASE, len(data)))))
    h = (upto[b] - upto[a]) * powers(pow(BASE, -1, 1 << 64), len(data))[a]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32)


_RNG = np.random.default_rng(17)
_XOR, _TIMES = (_RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, np.uint32) for _ in range(2))
_TIMES |= np.uint32(1)


def read_text(text: str | None) -> tuple[int, int | None, np.ndarray]:
    """(words, hash of the words in lower case, a signed 64-bit hash per MinHash
    band) of a whole text; no hash and no bands without words."""
    low, n, tail, whole, seen = np.full(BANDS * BAND_ROWS, 0xFFFFFFFF, np.uint32), 0, [], True, xxhash.xxh64(seed=42)

    def lower(words: list[bytes]) -> None:
        h = shingle_hashes(words)
        for lo in range(0, len(h), SHINGLES_HELD):
            np.minimum(low, ((h[lo:lo + SHINGLES_HELD, None] ^ _XOR) * _TIMES).min(0), out=low)

    for words in word_chunks((text or "").encode().lower(), CHUNK):
        seen.update((b" " if n else b"") + b" ".join(words))
        n += len(words)
        if max(map(len, words)) > LONG_WORD:
            words = [w if len(w) <= LONG_WORD else xxhash.xxh128_digest(w).hex().encode() for w in words]
        words = tail + words
        if len(words) >= SHINGLE:
            lower(words)
            tail, whole = words[len(words) - SHINGLE + 1:], False
        else:
            tail = words
    if not n:
        return 0, None, np.zeros(0, np.int64)
    if whole:
        lower(tail)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in low.reshape(BANDS, BAND_ROWS).T.astype(np.uint64):
        out = (out ^ row) * np.uint64(BASE)
        out ^= out >> np.uint64(32)
    return n, seen.intdigest() - (1 << 64 if seen.intdigest() >> 63 else 0), out.view(np.int64)


def bands(text: str | None) -> np.ndarray:
    return read_text(text)[2]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, key, source, cluster, total, bands) per document, from one read
    of the texts, written down. ``cluster`` is the hash of the lower-cased words
    (exact copies up to case and spacing share it), ``total`` the tokens with the end token."""
    schema = "doc_id long, key long, source string, cluster long, total long, bands array<long>"

    def run(batches):
        for b in batches:
            found = [read_text(t.as_py()) for t in b.column(3)]
            sizes = np.cumsum([0, *(len(f[2]) for f in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array([f[1] or 0 for f in found], pa.int64()),
                pa.array([f[0] + 1 for f in found], pa.int64()),
                pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([np.zeros(0, np.int64), *(f[2] for f in found)])))],
                names=["doc_id", "key", "source", "cluster", "total", "bands"])

    return materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"),
                                   F.col(source).cast("string").alias("source"), F.col(text).alias("text")).mapInArrow(run, schema), "pack-read")


def near_copies(read: DataFrame) -> DataFrame:
    """(v, root): the cluster of near copies per ``cluster`` of ``measured`` rows that has any."""
    cells = read.select(F.col("cluster").alias("key"), F.explode("bands").alias("band"))
    first = materialize(cells.groupBy("band").agg(F.min("key").alias("a"), F.max("key").alias("z"))
                        .filter("a <> z").select("band", "a"), "pack-first")
    edges = cells.join(first, "band").filter("a <> key").select("a", F.col("key").alias("b"))
    return materialize(components(edges, "pack-cc"), "pack-near")


def pack_apart(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``pack`` with near copies as clusters; the texts are read once."""
    read = measured(docs)
    return _packed(read.drop("bands"), near_copies(read), capacity, shard_docs)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         cluster: Column | None = None, near: DataFrame | None = None, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: doc_id, piece, start (first token of the document in
    it), n_tokens, bin_id, bin_offset, shard. ``near`` (v, root) unites clusters."""
    key = F.xxhash64(F.col(doc_id), F.col(text))
    slim = materialize(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), key.alias("key"), F.col(source).cast("string").alias("source"),
        (cluster_key(F.col(text)) if cluster is None else cluster).cast("long").alias("cluster"),
        (F.size(space_words(F.col(text))) + 1).cast("long").alias("total")), "pack-lengths")
    return _packed(slim, near, capacity, shard_docs)


def _packed(slim: DataFrame, near: DataFrame | None, capacity: int, shard_docs: int) -> DataFrame:
    """Bins for written rows (doc_id, key, source, cluster, total)."""
    shards = max(1, math.ceil(slim.count() / shard_docs))
    if near is not None:
        slim = slim.join(near, F.col("cluster") == F.col("v"), "left").withColumn("cluster", F.coalesce("root", "cluster")).drop("v", "root")
    last = F.floor((F.col("total") - 1) / F.lit(capacity)).cast("int")
    pieces = slim.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int")) \
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = (F.col("piece") * F.lit(capacity)).cast("long")
    pieces = pieces.select("doc_id", "key", "source", "cluster", "shard", "piece", start.alias("start"),
                           F.least(F.lit(capacity), F.col("total") - start).cast("long").alias("n_tokens"))

    def run(t: pa.Table) -> pa.Table:
        n, piece = t.column("n_tokens").to_numpy(), t.column("piece").to_numpy()
        ids = t.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.lexsort((piece, t.column("key").to_numpy(), ids, -n))
        t = t.take(pa.array(order))
        placed = pack_shard(n[order].tolist(), t.column("source").to_pylist(), t.column("cluster").to_pylist(), capacity)
        shard = int(t.column("shard")[0].as_py())
        return pa.table({"doc_id": t.column("doc_id"), "piece": t.column("piece"), "start": t.column("start"),
                         "n_tokens": t.column("n_tokens"),
                         "bin_id": pa.array([(shard << 32) + b for b, _ in placed], pa.int64()),
                         "bin_offset": pa.array([o for _, o in placed], pa.int64()), "shard": t.column("shard")})

    return pieces.groupBy("shard").applyInArrow(
        run, "doc_id long, piece int, start long, n_tokens long, bin_id long, bin_offset long, shard int")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_apart(table(spark, sf_dir, "documents"))
