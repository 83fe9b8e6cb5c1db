"""LM scoring with a hierarchical Pitman-Yor model.

Restaurants and their parents:

    one restaurant per previous word (and one for the start of a text)
    ->  one word restaurant they share  ->  uniform over the V words and "unknown"

A restaurant ``u`` serves word ``w`` with probability
``(c_uw - d t_uw) / (theta + c_u) + (theta + d t_u) / (theta + c_u) P_parent(w)``;
each of its tables is a customer of its parent. All unknown words are one dish,
so the probabilities of the V words and of "unknown" sum to one in every context.
After a word that training never saw the context is empty and its parent speaks.

Seating is sampled by Gibbs sweeps. In a sweep all customers of a pair (u, w)
leave, their tables leave the parent, and they enter again by the
Chinese-restaurant rule; all pairs of a sweep are reseated at once, given the
tables of the others as the sweep before left them. Then the shared restaurant
is reseated the same way. A pair seen once has one customer and so one table: it
is never drawn. Draws are hashes of (pair, sweep, step), so they depend neither
on partitions nor on retries. The predictive probabilities after burn-in are
averaged restaurant by restaurant: they are linear in the tables, so the mean
tables of a context and the mean probability of its parent still sum to one.

Scale: the texts are read once, about ``RUN`` tokens at a time. A run's distinct pairs
and their counts go to the part of the pair's hash, where all counts of a pair meet;
the run keeps which text has which pair. What a part knows of its words (counts, pairs
seen once, tables) goes to the word's place, is added up there over all parts, and the
word's state returns to the parts that have the word. No key's rows are gathered: a word
in many pairs is one number to and from each part, a frequent pair one number from each
run. Parts hold about ``PART_BYTES`` of text, whatever the input. Sweeps move only words of
pairs seen twice or more. At last the parts return each pair's probability to the runs,
in the order in which the pairs came, and the runs sum them by text; what a text has in
several runs is added. Rows carry packed columns (``pack``), tables are dropped after use.

Words are told apart by XXH64 (two of 10^8 words are equal with a chance of 0.0003). The
``HEAD_WORDS`` most frequent words of a sample of about ``HEAD_ENTRIES`` tokens travel as
their rank instead of the hash; this shortens rows and changes no result. Probabilities
travel to the runs as multiples of 2^-28 of their logarithm.

Defined results: a null text is empty (its end token only); a null id is not
held out; repeated rows count and are scored each; an empty table gives an
empty result; if no row trains, N = V = 0 and every word is unknown (probability
1); extra columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import table, word_chunks
from edumart.session import scratch_path

FOLDS, HELD_OUT = 7, 2
START, END = b"", b"\n"                       # neither is ever a word
#: of the context restaurants and of the shared one
DISCOUNT, STRENGTH = (0.75, 0.6), (1.0, 5.0)
BURN_IN, SAMPLES = 2, 3
HEAD_WORDS, HEAD_ENTRIES = 65_536, 2_000_000
RUN = 1_000_000                               # tokens a task takes at once
PART_BYTES = 16 << 20                         # bytes of text whose pairs make a part
UNIT = 2.0 ** -28


# ------------------------------------------------------------------ tokens

class Vocabulary(dict):
    """Word -> its place; ``START`` has place 0."""

    def __init__(self):
        super().__init__({START: 0})

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def token_runs(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """(number of the text, place of the word before, place of the word; hashes by
    place) of all tokens in order, about ``RUN`` at a time; every text also has a
    row for its start, at place 0."""
    places, parts, owner, size, last, before = Vocabulary(), [], [], 0, START, 0

    def run():
        nonlocal places, size, before
        at = np.concatenate(parts)
        h = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in places), np.uint64, len(places)).view(np.int64)
        out = np.repeat(owner, [len(p) for p in parts]), np.concatenate([[before], at[:-1]]), at, h
        places, size = Vocabulary(), 0
        before = places[last]
        parts.clear(), owner.clear()
        return out

    for k, text in enumerate(texts):
        for words in ([START], *word_chunks((text or "").encode().lower()), [END]):
            parts.append(np.fromiter(map(places.__getitem__, words), np.int64, len(words)))
            owner.append(k)
            size, last = size + len(words), words[-1]
            if size >= RUN:
                yield run()
    if parts:
        yield run()


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


START_HASH = signed(xxhash.xxh64_intdigest(START, 42))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)


def head_words(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes of the words that travel as their rank, from texts picked by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, at, h in token_runs(t.as_py() for b in batches for t in b.column(0)):
            n = np.bincount(at, minlength=len(h))[1:]
            yield pa.RecordBatch.from_arrays([pa.array(h[1:]), pa.array(n)], names=["h", "n"])

    every = max(1, size // (6 * HEAD_ENTRIES))
    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select(F.substring("text", 1, 20_000))
    top = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(HEAD_WORDS)
    return np.array([r.h for r in top.select("h").collect()], np.int64)


def coded(h: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Ranks of the words of ``head``, hashes of the others."""
    if not len(head):
        return h
    order = np.argsort(head)
    at = order[np.minimum(np.searchsorted(head, h, sorter=order), len(head) - 1)]
    return np.where(head[at] == h, at, h)


def hashed(code: np.ndarray, head: np.ndarray) -> np.ndarray:
    low = (code >= 0) & (code < len(head))
    return np.where(low, head[np.where(low, code, 0)], code) if len(head) else code


# ------------------------------------------------------------------ seating

def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """A number in (0, 1) per key, by the finaliser of SplitMix64."""
    with np.errstate(over="ignore"):
        x = key + np.uint64((sweep * 0x632BE59BD9B4E019 + (step + 1) * 0x9E3779B97F4A7C15) % 2 ** 64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54


def binomial(u: np.ndarray, v: np.ndarray, k: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Successes among ``k`` at chance ``p`` from two uniform numbers: by
    inversion, or by the normal limit where the variance is over 100."""
    p = np.clip(p, 0.0, 1.0)
    q, out = np.minimum(p, 1 - p), np.zeros(len(k))
    wide = k * q * (1 - q) > 100
    z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
    out[wide] = np.clip(np.rint(k * q + np.sqrt(k * q * (1 - q)) * z), 0, k)[wide]
    live = np.flatnonzero(~wide & (q > 0))
    mass = (1 - q) ** np.where(wide, 0, k)
    below = mass.copy()
    while len(live := live[(u[live] > below[live]) & (out[live] < k[live])]):
        mass[live] *= (k[live] - out[live]) / (out[live] + 1) * q[live] / (1 - q[live])
        out[live] += 1
        below[live] += mass[live]
    return np.where(p > 0.5, k - out, out)


def seat(key: np.ndarray, sweep: int, c: np.ndarray, a0: np.ndarray, da: np.ndarray, d: float) -> np.ndarray:
    """Tables that ``c >= 1`` customers of each dish open: with ``i`` customers
    at ``t`` tables the next one opens a table with weight ``a0 + da * t`` against
    ``i - d * t``. The first 64 enter one by one, later ones in groups of 1/64
    of those seated (the chance moves by less than 2 % within a group)."""
    t, i, live, step = np.ones(len(c)), np.ones(len(c)), np.flatnonzero(c > 1), 0
    while len(live):
        a, n = a0[live] + da[live] * t[live], i[live]
        k = np.minimum(np.maximum(1, n // 64), c[live] - n)
        p, u = a / (a + n - d * t[live]), uniform(key[live], sweep, step)
        t[live] += u < p if k.max() == 1 else np.where(k == 1, u < p, binomial(u, uniform(key[live], sweep, step + 1), k, p))
        i[live] += k
        step += 2
        live = live[i[live] < c[live]]
    return t


# ------------------------------------------------------------------ rows between parts, words and runs

#: kind of row; number of the part, word place or run place it goes to, and of where it is from
ROW = pa.schema([("kind", pa.string()), ("to", pa.int32()), ("frm", pa.int64()), ("data", pa.binary())])
ROW_SQL = "kind string, to int, frm long, data binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns as bytes: their first bytes, their second bytes and so on, compressed."""
    names = "".join(f"{c.dtype.str[1:]}," for c in columns).encode()
    sizes = struct.pack(f"<{len(columns)}q", *map(len, columns))
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return struct.pack("<iq", len(names), len(planes)) + names + sizes + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    width, size = struct.unpack_from("<iq", data)
    types = data[12:12 + width].decode().split(",")[:-1]
    sizes = struct.unpack_from(f"<{len(types)}q", data, 12 + width)
    planes = np.frombuffer(pa.decompress(data[12 + width + 8 * len(types):], size, codec="zstd", asbytes=True), np.uint8)
    out, pos = [], 0
    for t, n in zip(types, sizes):
        w = np.dtype(t).itemsize
        out.append(planes[pos:pos + n * w].reshape(w, n).T.copy(order="C").view(t).reshape(n))
        pos += n * w
    return out


def joined(rows: list[tuple[int, bytes]], n: int) -> list[np.ndarray]:
    """The ``n`` columns of several rows, one after the other."""
    parts = [unpack(data) for _, data in rows]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(n)]


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for r in rows:
        some.append(r)
        size += len(r[-1])
        if size > 4 << 20 or len(some) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)


def received(rows: DataFrame, n: int, step: Callable[[int, dict], Iterator[tuple]]) -> DataFrame:
    """``step`` for each number that rows go to: it gets the rows by kind, each
    kind as (from, data) in order of ``frm``, and gives rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = defaultdict(lambda: defaultdict(list))
        for b in batches:
            for kind, to, frm, data in zip(*(b.column(c).to_pylist() for c in ROW.names)):
                got[to][kind].append((frm, data))

        def out():
            for to in sorted(got):
                kinds = got.pop(to)
                for k in kinds:
                    kinds[k].sort()
                yield from step(to, kinds)
        yield from batched(out(), ROW)

    return rows.repartitionById(n, "to").mapInArrow(run, ROW_SQL)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside delete their shuffle files when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


class Table:
    """Rows written to the shared folder, a folder per kind."""

    def __init__(self, rows: DataFrame, name: str):
        self.spark, self.path = rows.sparkSession, scratch_path(rows.sparkSession, name)
        # the rows are compressed already
        rows.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").partitionBy("kind").parquet(self.path)

    def of(self, *kinds: str) -> DataFrame:
        return self.spark.read.schema("to int, frm long, data binary, kind string").parquet(self.path) \
            .filter(F.col("kind").isin(*kinds)).select(*ROW.names)

    def drop(self, *kinds: str) -> None:
        for p in [f"{self.path}/kind={k}" for k in kinds] or [self.path]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# ------------------------------------------------------------------ steps

def run_place(run: int, parts: int) -> int:
    return ((run >> 20) + (run & 0xFFFFF) * 7919) % parts


def word_places(code: np.ndarray, places: int) -> np.ndarray:
    return (code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(places)


def steps_of(x: np.ndarray) -> np.ndarray:
    """Differences, which pack better than ascending numbers; ``np.cumsum`` undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


def count_runs(docs: DataFrame, parts: int, places: int, head: np.ndarray) -> DataFrame:
    """From (doc_id, text, trains). pairs, to the pairs' part: words and training
    counts of a run's distinct pairs, in the order of its words. run, to the run's place: its texts, the text
    of each token in the order of the pairs, and the tokens of each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, trains, base = TaskContext.get().partitionId(), [], [], 0

        def texts():
            for b in batches:
                for i, t, f in zip(*(b.column(k) for k in range(3))):
                    ids.append(i.as_py())
                    trains.append(f.as_py())
                    yield t.as_py()

        def out():
            nonlocal base
            for k, (own, prev, at, h) in enumerate(token_runs(texts())):
                number, lo, hi = task << 20 | k, int(own[0]), int(own[-1]) + 1
                own -= lo
                token = at > 0
                own, prev, at = own[token], prev[token], at[token]
                part = (mixed(h[prev], h[at]) >> np.uint64(20)) % np.uint64(parts)
                code = coded(h, head)
                order = np.lexsort((code, word_places(code, places)))
                rank, code = np.empty(len(h), np.int64), code[order]
                rank[order] = np.arange(len(h))
                key = part.view(np.int64) << 46 | rank[prev] << 23 | rank[at]
                order = np.argsort(key)
                key, own = key[order], own[order].astype(np.int32)
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                key = key[first]
                own_trains = np.array(trains[lo - base:hi - base], np.int64)
                n = np.add.reduceat(own_trains[own], first) if len(key) else first
                a, b = code[key >> 23 & 0x7FFFFF], code[key & 0x7FFFFF]
                cut = np.searchsorted(key >> 46, np.arange(parts + 1))
                for p in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                    s = slice(cut[p], cut[p + 1])
                    yield "pairs", p, number, pack(steps_of(a[s]), b[s], n[s])
                doc = ids[lo - base:hi - base]
                yield "run", run_place(number, parts), number, pack(
                    np.array([x or 0 for x in doc], np.int64), np.array([x is None for x in doc], np.int8),
                    np.arange(lo, hi) | task << 40, own, np.diff(np.append(first, len(own))).astype(np.int32))
                del ids[:hi - 1 - base], trains[:hi - 1 - base]        # the last one may go on
                base = hi - 1

        yield from batched(out(), ROW)

    return docs.mapInArrow(run, ROW_SQL)


def gather_pairs(places: int) -> Callable:
    """A part's pairs from those of all runs. pair: places of its two words and the
    count; back: the pair of each one a run sent; multi: those seen twice or more,
    at one table each, by the places of their words (busy); word and up: to the
    words' places. Words are in order of their place, so that rows from the
    places, one after the other, follow the words of the part."""
    def step(p: int, got: dict) -> Iterator[tuple]:
        for number, data in got.get("run", ()):
            yield "run", p, number, data
        if "pairs" not in got:
            return
        sent = [[np.cumsum(a), b, n] for a, b, n in (unpack(data) for _, data in got["pairs"])]
        a, b, n = (np.concatenate([s[k] for s in sent]) for k in range(3))
        word, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        place = word_places(word, places)
        order = np.lexsort((word, place))
        rank = np.empty(len(word), np.int64)
        rank[order] = np.arange(len(word))
        at, word, place = rank[at], word[order], place[order]
        pair, back = np.unique(at[:len(a)] << 32 | at[len(a):], return_inverse=True)
        n = np.rint(np.bincount(back, n, len(pair))).astype(np.int64)
        a, b = pair >> 32, pair & 0xFFFFFFFF
        yield "pair", p, p, pack(steps_of(a.astype(np.int32)), b.astype(np.int32), n)
        lens = np.cumsum([0, *(len(s[0]) for s in sent)])
        for (number, _), lo, hi in zip(got["pairs"], lens, lens[1:]):
            yield "back", p, number, pack(steps_of(back[lo:hi].astype(np.int32)))
        per = lambda i, w: np.rint(np.bincount(i, w, len(word))).astype(np.int64)
        busy = np.zeros(len(word), np.int8)
        busy[a[n > 1]] = busy[b[n > 1]] = 1
        columns = [word, per(b, n), per(a, n), per(a, n == 1), per(b, n == 1), busy]
        cut = np.searchsorted(place, np.arange(places + 1).astype(np.uint64))
        for q in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            word_q, *others = (x[cut[q]:cut[q + 1]] for x in columns)
            yield "word", q, p, pack(steps_of(word_q), *others)
        rank, multi = np.cumsum(busy) - 1, n > 1
        cut = np.append(0, np.cumsum(busy))[cut]
        one = np.ones(multi.sum(), np.int64)
        yield from part_rows(p, rank[a[multi]], rank[b[multi]], n[multi], one, 0 * one, word[busy > 0], cut)

    return step


def part_rows(p: int, a, b, n, t, kept, word, cut) -> Iterator[tuple]:
    if not len(n):
        return
    yield "multi", p, p, pack(steps_of(a.astype(np.int32)), b.astype(np.int32), n, t, kept, steps_of(word), cut.astype(np.int64))
    sums = [np.rint(np.bincount(i, w, len(word))).astype(np.int64) for i, w in ((a, t), (b, t), (a, kept))]
    for q in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        yield "up", q, p, pack(*(s[cut[q]:cut[q + 1]] for s in sums))


def gather_words(q: int, got: dict) -> Iterator[tuple]:
    """A place's words from all parts. state: the words with their counts; route:
    the words of each part; hop: those of its pairs seen twice or more."""
    sent = [unpack(data) for _, data in got["word"]]
    word, at = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
    c, cu, sa, sb = (np.rint(np.bincount(at, np.concatenate([s[k] for s in sent]), len(word))).astype(np.int64) for k in (1, 2, 3, 4))
    lens = np.cumsum([0, *(len(s[0]) for s in sent)])
    for (p, _), s, lo, hi in zip(got["word"], sent, lens, lens[1:]):
        yield "route", q, p, pack(steps_of(at[lo:hi].astype(np.int32)))
        if s[5].any():
            yield "hop", q, p, pack(steps_of(at[lo:hi][s[5] > 0].astype(np.int32)))
    zero = np.zeros(len(word), np.int64)
    yield "state", q, q, pack(word, c, cu, sa, sb, zero, (c > 0).astype(np.int64), np.zeros(len(word)))
    yield "sum", 0, q, pack(np.array([c.sum(), (c > 0).sum()]))


def word_state(got: dict, past: tuple | None) -> tuple[list[np.ndarray], list[np.ndarray], list]:
    """The words of a place, with the sweep ``past`` (customers, rest) added to their
    means; tables by context, by dish and kept by context; where they hop to."""
    state = unpack(got["state"][0][1])
    word, c, cu, sa, sb, c0, t0, mean = state
    if past:
        customers, rest = past
        mean += np.where(c > 0, ((c0 - DISCOUNT[1] * t0) / (STRENGTH[1] + customers) + rest) / SAMPLES, 0.0)
    sums = [np.zeros(len(word), np.int64) for _ in range(3)]
    hops = {p: np.cumsum(unpack(data)[0]) for p, data in got.get("hop", ())}
    for p, data in got.get("up", ()):
        for total, x in zip(sums, unpack(data)):
            total[hops[p]] += x
    return state, sums, hops


def seat_shared(sweep: int, tables: int, base: float, past: tuple | None, head: np.ndarray) -> Callable:
    """The shared restaurant reseated. down: to the parts, tables of the context,
    customers and tables of the dish."""
    d, th = DISCOUNT[1], STRENGTH[1]

    def step(q: int, got: dict) -> Iterator[tuple]:
        (word, c, cu, sa, sb, _, t0, mean), (ma, mb, _), hops = word_state(got, past)
        live = np.flatnonzero(c > 0)
        c0, flat = sb + mb, np.full(len(live), base)
        t0[live] = seat(hashed(word[live], head).view(np.uint64), sweep, c0[live].astype(float),
                        (th + d * (tables - t0[live])) * flat, d * flat, d).astype(np.int64)
        yield "state", q, q, pack(word, c, cu, sa, sb, c0, t0, mean)
        yield "sum", 0, q, pack(np.array([c0.sum(), t0.sum()]))
        tu = sa + ma
        for p, i in hops.items():
            yield "down", p, q, pack(tu[i], c0[i], t0[i])

    return step


def seat_contexts(sweep: int, customers: int, tables: int, base: float, keep: bool, head: np.ndarray) -> Callable:
    """Pairs reseated; their own tables have left the parent."""
    (d, d0), (th, th0) = DISCOUNT, STRENGTH

    def step(p: int, got: dict) -> Iterator[tuple]:
        a, b, n, t, kept, word, cut = unpack(got["multi"][0][1])
        a, word = np.cumsum(a, dtype=np.int32), np.cumsum(word)
        tu, c0, t0 = (x.astype(float) for x in joined(got["down"], 3))
        own, h = t.astype(float), hashed(word, head)
        left = np.maximum(c0[b] - own, 0)
        parent = (left - d0 * np.minimum(t0[b], left) + (th0 + d0 * tables) * base) / (th0 + customers - own)
        t = seat(mixed(h[a], h[b]), sweep, n.astype(float), (th + d * (tu[a] - own)) * parent, d * parent, d).astype(np.int64)
        yield from part_rows(p, a, b, n, t, kept + t if keep else kept, word, cut)

    return step


def word_values(past: tuple, unseen: float, named: bool) -> Callable:
    """side: to all parts that have the word, its count, how much that differs as a
    context, mean tables as a context times ``SAMPLES``, the shared probabilities and
    which of them it has (and, if ``named``, the word)."""
    def step(q: int, got: dict) -> Iterator[tuple]:
        (word, c, cu, sa, *_, mean), (_, _, kept), _ = word_state(got, past)
        columns = c, cu - c, sa * SAMPLES + kept
        mean, at = np.unique(np.where(c > 0, mean, unseen), return_inverse=True)
        for p, data in got["route"]:
            i = np.cumsum(unpack(data)[0])
            some, own = np.unique(at[i], return_inverse=True)
            yield "side", p, q, pack(*(x[i] for x in columns), mean[some], own.astype(np.int32), *([word[i]] if named else []))

    return step


def side_values(rows: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """Of a part's words: count, count as a context, shared probability, backoff as a context (and the word)."""
    d, th = DISCOUNT[0], STRENGTH[0]
    parts = []
    for _, data in rows:
        c, more, tables, mean, own, *word = unpack(data)
        cu = c + more
        parts.append([c, cu, mean[own], np.where(cu > 0, (th + d * (tables / SAMPLES)) / (th + cu), 1.0), *word])
    return [np.concatenate(x) for x in zip(*parts)]


def pair_values(got: dict) -> tuple[np.ndarray, ...]:
    """Of a part's pairs: places of the words, count, count of the word, log10 of
    the word's probability after the context, the same by backoff only."""
    d, th = DISCOUNT[0], STRENGTH[0]
    a, b, n = unpack(got["pair"][0][1])
    a = np.cumsum(a)
    c, cu, mean, backoff, *_ = side_values(got["side"])
    kept = np.where(n == 1, float(SAMPLES), 0.0)
    if "multi" in got:
        kept[n > 1] = unpack(got["multi"][0][1])[4]
    fall = backoff[a] * mean[b]
    return a, b, n, c[b], np.log10(np.where(n > 0, (n - d * kept / SAMPLES) / (th + cu[a]), 0.0) + fall), np.log10(fall)


def return_values(parts: int) -> Callable:
    """value: to the run, of each pair it sent, the probability and the word's count."""
    def step(p: int, got: dict) -> Iterator[tuple]:
        _, _, _, c, lp, _ = pair_values(got)
        lp = np.rint(lp / UNIT).astype(np.int64)
        for number, data in got["back"]:
            i = np.cumsum(unpack(data)[0])
            yield "value", run_place(number, parts), number << 16 | p, pack(lp[i], c[i])

    return step


# ------------------------------------------------------------------ training

class Model:
    """A model trained on the rows of ``docs`` (doc_id, text, trains) with ``trains``
    and all that scores its rows. N, V: tokens and words; unseen: the shared
    probability of "unknown"."""

    def __init__(self, docs: DataFrame, named: bool = False):
        spark = docs.sparkSession
        d0, th0 = DISCOUNT[1], STRENGTH[1]
        with shuffles_dropped(spark):
            size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
            self.parts = parts = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES)), 1 << 16)
            places = max(min(parts, 8), parts // 4)
            self.head = head = head_words(docs, size)
            self.pairs = Table(received(count_runs(docs, parts, places, head), parts, gather_pairs(places)), "py-pairs")
            words = fixed = Table(received(self.pairs.of("word"), places, gather_words), "py-words")
            self.pairs.drop("word")
            self.N, self.V = self.sums(words)
            base, tables, self.unseen, past = 1 / (self.V + 1), self.V, 0.0, None
            self.multi = self.pairs
            for k in range(BURN_IN + SAMPLES):
                # the tables of the sweep before go when the next are written
                rows = words.of("state").union(fixed.of("hop")).union(self.multi.of("up"))
                old, words = words, Table(received(rows, places, seat_shared(k, tables, base, past, head)), "py-words")
                old.drop("state")
                customers, tables = self.sums(words)
                rest, keep = (th0 + d0 * tables) / (th0 + customers) * base, k >= BURN_IN
                past = (customers, rest) if keep else None
                self.unseen += rest / SAMPLES if keep else 0.0
                rows = self.multi.of("multi").union(words.of("down"))
                old, self.multi = self.multi, Table(received(rows, parts, seat_contexts(k, customers, tables, base, keep, head)), "py-multi")
                old.drop("multi", "up")
                words.drop("down")
            rows = words.of("state").union(fixed.of("hop", "route")).union(self.multi.of("up"))
            self.words = Table(received(rows, places, word_values(past, self.unseen, named)), "py-values")
            words.drop(), fixed.drop(), self.multi.drop("up")

    @staticmethod
    def sums(words: Table) -> list[int]:
        found = [unpack(r.data)[0] for r in words.of("sum").select("data").collect()]
        return [int(x) for x in np.sum(found, axis=0)] if found else [0, 0]

    def sides(self) -> DataFrame:
        return self.pairs.of("pair", "back").union(self.multi.of("multi")).union(self.words.of("side"))

    def scores(self) -> DataFrame:
        """(doc_id, n_tokens, n_known, base, score) of each row; the tables of the model go."""
        with shuffles_dropped(self.pairs.spark):
            values = Table(received(self.sides(), self.parts, return_values(self.parts)), "py-back")
        for t in (self.multi, self.words):
            t.drop()
        self.pairs.drop("pair", "back")
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("base", pa.float64()), ("score", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            runs, back = {}, defaultdict(list)
            for x in batches:
                for kind, frm, data in zip(*(x.column(c).to_pylist() for c in ("kind", "frm", "data"))):
                    if kind == "run":
                        runs[frm] = data
                    else:
                        back[frm >> 16].append((frm, data))
            for number in sorted(runs):
                ids, null, row, own, m = unpack(runs.pop(number))
                lp, c = (np.repeat(x, m) for x in joined(sorted(back.pop(number, [])), 2))
                add = lambda w=None: np.bincount(own, w, len(ids))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(ids, mask=null > 0), pa.array(add()), pa.array(add(c > 0).astype(np.int64)),
                     pa.array(add(np.log10(c + 1.0))), pa.array(add(lp * UNIT))], schema=schema)

        rows = self.pairs.of("run").union(values.of("value")).repartitionById(self.parts, "to")
        return rows.mapInArrow(run, "row long, doc_id long, n_tokens long, n_known long, base double, score double") \
            .groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score"))).drop("row")


def train(texts: DataFrame) -> tuple[DataFrame, dict]:
    """(entries, figures). Entries: (a, b, n, value, known) with a row per word
    (known: true; a: 0; value: log10 of its shared probability times its backoff
    as a context) and per pair (known: false; value: what it adds to that).
    Figures: N, V, log10 of the shared probability of "unknown", and as tables
    all shared probabilities (b, mean) and backoffs (a, backoff)."""
    text = F.col(texts.columns[0])
    model = Model(texts.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"), F.lit(True).alias("trains")), named=True)
    head = model.head

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for data in x.column("data").to_pylist():
                *columns, word = side_values([(0, data)])
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (hashed(word, head), *columns)], names=["h", "c", "cu", "mean", "backoff"])

    per = model.words.of("side").mapInArrow(words, "h long, c long, cu long, mean double, backoff double").dropDuplicates(["h"])
    shared = per.filter("c > 0").select(F.col("h").alias("b"), "c", "mean", "backoff")
    gains = received(model.sides(), model.parts, pair_gains)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for data in x.column("data").to_pylist():
                a, b, n, value = unpack(data)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (hashed(a, head), hashed(b, head), n, value)], names=["a", "b", "n", "value"])

    entries = shared.select(F.lit(0).cast("long").alias("a"), "b", F.col("c").alias("n"), F.log10(F.col("mean") * F.col("backoff")).alias("value"), F.lit(True).alias("known")) \
        .union(gains.mapInArrow(pairs, "a long, b long, n long, value double").withColumn("known", F.lit(False)))
    return entries, {"N": model.N, "V": model.V, "unseen": math.log10(model.unseen), "shared": shared.select("b", "mean"),
                     "backoff": per.filter("cu > 0").select(F.col("h").alias("a"), "backoff")}


def pair_gains(p: int, got: dict) -> Iterator[tuple]:
    """gain: the training pairs of a part with what each adds to its backoff."""
    a, b, n, _, lp, fall = pair_values(got)
    *_, word = side_values(got["side"])
    seen = n > 0
    yield "gain", p, p, pack(word[a][seen], word[b][seen], n[seen], (lp - fall)[seen])


# ------------------------------------------------------------------ scoring

def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", (~held_out("doc_id")).alias("trains"))
    model = Model(docs)
    return model.scores().select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(model.N).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(model.N + model.V + 1)).alias("base_score"), "score")
