"""The dealt operators on a small fixture with nulls, empty and long texts,
repeated rows, ties, empty tables and clashing extra columns, against brute force."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import DataFrameWriter

import corpus_pipeline
from edumart.llm import (bpe, embedding_dedup, language_id, license_scan, mixing, packing, pitman_yor,
                         quality_rules, simhash, token_counts, token_records)
from edumart.llm.common import components, forest
from edumart.llm.queries import ORACLE_SQL, QUERIES
from edumart.session import scratch_path

SF = "/root/testdata/sf0.001"
SYL = {"en": "the an er ing on th re ha st ou nd tion".split(), "fr": "le es eau que ai ou eux é ê tre ment en".split()}


def make_docs():
    rng, rows = random.Random(5), []
    for i in range(160):
        lang = "en" if i % 3 else "fr"
        n = rng.choice([1, 8, 30, 60, 200])
        words = ["".join(rng.choice(SYL[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]
        rows.append([i, " ".join(words) + ".", lang, f"src{0 if i % 2 else i % 5}"])
    rows[7][1] = rows[6][1]                                       # exact copy
    w = rows[9][1].split()
    rows[8][1] = " ".join(rows[4][1].split() * 3)
    rows[10][1] = rows[9][1] + " Released under the MIT License."
    rows[11][1] = "line one two three\n" * 30 + " ".join(w)
    rows[12][1] = "### $$$ *** " * 40
    rows[13][1] = "word " * 30_000
    rows += [[None, None, None, None], [200, None, "en", "src1"], [201, "", "fr", None], [None, "the an er", None, "src2"],
             rows[20][:], rows[20][:], [None, "one line\none line\nlast", "en", "src1"], [205, "p q\np q", "en", "src3"], [205, "p q", "en", "src3"], [202, " \t\n ", "en", "src1"], [203, "x y 中文 <|endoftext|> z  w", "en-GB", "src1"]]
    return rows


ROWS = make_docs()
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs = pa.table({n: pa.array([r[k] for r in ROWS], t) for k, (n, t) in enumerate(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])})
    for clash in ("kept", "words", "q_verdict", "host", "row_", "fp", "mix_topic", "h_host", "rule", "n"):
        docs = docs.append_column(clash, pa.array([1] * len(ROWS)))
    pq.write_table(docs, f"{d}/documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([1, 2, 3, None], pa.int64()), "quality": pa.array([1, 0, None, 1], pa.int32()),
                             "toxic": pa.array([0, 1, None, 1], pa.int32())}), f"{d}/labels.parquet")
    pq.write_table(pa.table({"page_id": pa.array([1, 2, None], pa.int64()), "url": ["https://www.a.example.fr/x", None, "nonsense"],
                             "html": ['<html lang="fr"><p>' + ROWS[0][1], None, "<b></b>"]}), f"{d}/pages.parquet")
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 8))
    vecs = [base[0] + 0.03 * rng.normal(size=8) for _ in range(40)] + list(base) + [2 * base[3], base[4], base[4], -0.0 * base[0]]
    vecs = [v.tolist() for v in vecs] + [None, [], [math.nan] * 8, [math.inf] + [0.0] * 7, [1.0, None] + [0.0] * 6, [1.0, 2.0]]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vecs)), pa.int64()), "embedding": pa.array(vecs, pa.list_(pa.float64())),
                             "label": pa.array([None if i % 17 == 0 else i // 100 for i in range(len(vecs))], pa.int32())}),
                   f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="module")
def empty(sf, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name in os.listdir(sf):
        pq.write_table(pq.read_table(f"{sf}/{name}").slice(0, 0), f"{d}/{name}")
    return d


def result(spark, name, sf):
    return [r.asDict() for r in QUERIES[name](spark, sf).collect()]


def key(r):
    return (r is None, r or 0)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert result(spark, name, empty) == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("which", ["edge", "driver"])
def test_sql(spark, sf, name, which):
    d = sf if which == "edge" else SF
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    cols, rows = want.columns, want.fetchall()
    got = [tuple(r[c] for c in cols) for r in result(spark, name, d)]
    order = lambda t: tuple(map(repr, t))
    assert sorted(got, key=order) == sorted(rows, key=order)


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_packing_equals_plain_best_fit(spark, sf):
    rows = result(spark, "op1_best_fit_packing", sf)
    assert sum(r["n_tokens"] for r in rows) == sum(len(words_of(r[1])) + 1 for r in ROWS)
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for b in bins.values():
        b.sort(key=lambda r: r["bin_offset"])
        assert [r["bin_offset"] for r in b] == np.cumsum([0] + [r["n_tokens"] for r in b])[:-1].tolist()
        assert sum(r["n_tokens"] for r in b) <= packing.CAPACITY
    text = {r[0]: r for r in ROWS}
    for b in bins.values():
        src = [text[r["doc_id"]][3] for r in b if r["doc_id"] is not None and text[r["doc_id"]][3]]
        assert len(src) == len(set(src))


def plain_best_fit(n, s, c, cap):
    bins, out = [], []
    for x, a, b in zip(n, s, c):
        fit = [(left, k) for k, (left, ss, cc) in enumerate(bins) if left >= x and a not in ss and b not in cc]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([cap, set(), set()])
        out.append((k, cap - bins[k][0]))
        bins[k][0] -= x
        bins[k][1] |= {a} - {None}
        bins[k][2] |= {b} - {None}
    return out


@pytest.mark.parametrize("cap,sources,clusters", [(16, 3, 4), (100, 1, 9), (64, 40, 2), (7, 2, 1)])
def test_bins_against_brute_force(cap, sources, clusters):
    rng = random.Random(cap)
    n = sorted((rng.randint(1, cap) for _ in range(500)), reverse=True)
    s = [rng.choice([None, *range(sources)]) for _ in n]
    c = [rng.choice([None, *range(clusters), *range(1000, 1400)]) for _ in n]
    assert packing.pack_shard(n, s, c, cap) == plain_best_fit(n, s, c, cap)


def test_near_copies_share_no_bin(spark, tmp_path):
    rng, rows = random.Random(8), []
    for i in range(40):
        w = ["".join(rng.choice(SYL["en"]) for _ in range(3)) for _ in range(90)]
        rows.append((2 * i, " ".join(w), f"a{i}"))
        w[rng.randrange(90)] = "other"
        rows.append((2 * i + 1, " ".join(w).upper(), f"b{i}"))
    pq.write_table(pa.table(dict(zip(("doc_id", "text", "source"), map(list, zip(*rows))))), f"{tmp_path}/documents.parquet")
    bins = {r["doc_id"]: r["bin_id"] for r in result(spark, "op1_best_fit_packing", str(tmp_path))}
    assert all(bins[2 * i] != bins[2 * i + 1] for i in range(40)) and len(set(bins.values())) < 20
    plain = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    words = [r[1].lower().encode().split() for r in rows]
    joint = [tuple(w[k:k + 5]) for w in words for k in range(len(w) - 4)]
    assert len(set(joint)) == len(set(np.concatenate([packing.shingle_hashes(w) for w in words]).tolist()))
    assert len(plain(words[0])) == len(packing.shingle_hashes(words[0]))


def test_license_scan(spark, sf):
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                  for r in result(spark, "op3_license_scan", sf))
    want = Counter()
    for i, text, *_ in ROWS:
        low = (text or "").translate({k: k + 32 for k in range(65, 91)})
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(p, l) for p in range(len(w)) for l, ph in license_scan.PHRASES if w[p:p + len(ph.split())] == ph.split()]
        want[(i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({l for _, l in at})))] += 1
    assert got == want


def test_license_bands(spark):
    mit = license_scan.TEMPLATES[0][1]
    w = mit.split()
    texts = ["lorem ipsum " * 5 + mit + " dolor", " ".join(w[:12] + ["extra", "words"] + w[12:30]), " ".join(w[:6]),
             "mit license mit license", "of the rights to the public " * 50]
    docs, spans = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    by = defaultdict(list)
    for r in spans.collect():
        if r.cover >= license_scan.MIN_COVER:
            by[r.doc_id].append(r)
    assert [(r.first, r.cover, r.label) for r in by[0]] == [(10, 1.0, "mit")]
    assert len(by[1]) == 1 and by[1][0].cover < 1
    assert sorted(r.first for r in by[3]) == [0, 2] and not by[2] and not by[4]


def test_pieces_give_the_librarys_ids():
    enc = bpe.encoder(bpe.read_spec())
    rng = random.Random(3)
    signs = ["a", "b", " ", " ", "\n", "\t", "\xa0", "\x1c", "\x85", "'s", "don't", ".", "é", "1", "<|endoftext|>", "\r", "中", " the", "\x0b", "!!"]
    for _ in range(3000):
        s = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(enc.ids(s), f"<u{enc.width}").tolist() == enc.tokenizer.encode(s, add_special_tokens=False).ids, repr(s)


def test_token_records(spark, sf):
    enc = bpe.encoder(bpe.read_spec())
    want, at = [], 0
    # Spark's XXH64 of a text: seed 42, signed; of null: 42
    hash_ = lambda t: 42 if t is None else (xxhash.xxh64_intdigest(t.encode(), 42) + 2 ** 63) % 2 ** 64 - 2 ** 63
    for i, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, hash_(r[1]), r[1] is not None, (r[1] or "").encode())):
        ids = enc.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in result(spark, "op4_token_records", sf)]
    assert sorted(got, key=lambda r: r[1]) == want


def test_records_by_index_and_damage(spark, sf):
    folder = scratch_path(spark, "records")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    index = token_records.write_records(docs, "doc_id", "text", folder, bpe.read_spec()).collect()
    for r in random.Random(1).sample(index, 20):
        k, ids = token_records.read_at(folder, r["shard"], r["byte_offset"])
        assert k == r["key"] and len(ids) == r["n_tokens"] and ids[-1] == 0
    path = f"{folder.removeprefix('file://')}/shard-{index[0]['shard']:06d}.bin"
    data = bytearray(open(path, "rb").read())
    data[14] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        token_records.read_at(folder, index[0]["shard"], 0)


def test_token_counts(spark, sf):
    enc = token_counts._encoding(token_counts.read_ranks())
    want = defaultdict(lambda: [0, 0])
    for i, text, lang, source in ROWS:
        if i == 2:
            continue                                        # toxic
        if text is not None:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        want[(source, lang)][0] += 1
        want[(source, lang)][1] += len(enc.encode_ordinary(text or ""))
    got = {(r["source"], r["lang"]): [r["docs"], r["tokens"]] for r in result(spark, "op5_token_counts", sf)}
    assert got == dict(want)


def test_rollup_batches_are_idempotent(spark):
    row = "doc_id long, source string, lang string, tokenizer_version string, n_tokens long"
    a = spark.createDataFrame([(1, "s", "en", "v", 5), (2, "s", "en", "v", 7)], row)
    b = spark.createDataFrame([(2, "s", "en", "v", 9)], row)
    store = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    assert store.totals().collect() == []
    assert store.commit("1", token_counts.changes(a)) and not store.commit("1", token_counts.changes(a))
    assert store.commit("2", token_counts.changes(b, a.filter("doc_id = 2")))
    os.makedirs(f"{store.path.removeprefix('file://')}/batch=3")              # a batch that died half-way
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "v", 2, 14)] and store.committed() == ["1", "2"]
    copy = store.compact(token_counts.Rollup(spark, scratch_path(spark, "rollup")), "base")
    assert copy.totals().collect() == store.totals().collect()
    store.commit("4", token_counts.changes(deleted=spark.createDataFrame([(1, "s", "en", "v", 5), (2, "s", "en", "v", 9)], row)))
    assert store.totals().collect() == []


def test_lm_scoring(spark, sf):
    docs = [(r[0], (r[1] or "").encode().lower().split() + [b"\n"]) for r in ROWS]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in docs if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in docs)
    rows = result(spark, "op6_lm_scoring", sf)
    assert want == Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def hashes(text):
    return [pitman_yor.signed(xxhash.xxh64_intdigest(w, 42)) for w in [b"", *(text or "").encode().lower().split(), b"\n"]]


def test_lm_probabilities_sum_to_one_and_make_the_scores(spark, sf, monkeypatch):
    """Every context's probabilities sum to one, the query's scores are the plain
    sums of their logarithms, whichever words are head words and however the
    tables are partitioned."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    train = lambda: pitman_yor.train(texts.filter(~pitman_yor.held_out("doc_id")).select("text"))
    entries, figures = train()
    rows = entries.collect()
    shared, backoff = (dict(map(tuple, figures[t].collect())) for t in ("shared", "backoff"))
    assert len(shared) == figures["V"] and set(backoff) == set(shared) - {hashes("")[-1]} | {hashes("")[0]}
    gain = {(r.a, r.b): r.value for r in rows if not r.known}
    counts = Counter((a, b) for i, t, *_ in ROWS if not (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)
                     for h in [hashes(t)] for a, b in zip(h, h[1:]))
    assert {(r.a, r.b): r.n for r in rows if not r.known} == counts
    followers = defaultdict(list)
    for a, b in gain:
        followers[a].append(b)
    unknown = 10 ** figures["unseen"]
    assert abs(sum(shared.values()) + unknown - 1) < 1e-9
    for a, seen in followers.items():
        p = sum(shared[b] * backoff[a] * 10 ** gain[a, b] for b in seen)
        assert abs(p + backoff[a] * (1 - sum(shared[b] for b in seen)) - 1) < 1e-9

    plain = lambda t: sum(math.log10(backoff.get(a, 1.0) * shared.get(b, unknown)) + gain.get((a, b), 0.0)
                          for h in [hashes(t)] for a, b in zip(h, h[1:]))
    want = sorted((key(i), round(plain(t), 6)) for i, t, *_ in ROWS)
    got = lambda: sorted((key(r["doc_id"]), round(r["score"], 6)) for r in result(spark, "op6_lm_scoring", sf))
    close = lambda x, y: len(x) == len(y) and all(i == j and abs(s - t) < 1e-5 for (i, s), (j, t) in zip(x, y))
    assert close(got(), want)
    monkeypatch.setattr(pitman_yor, "HEAD_WORDS", 3)
    monkeypatch.setattr(pitman_yor, "HEAD_ENTRIES", 5)
    monkeypatch.setattr(pitman_yor, "RUN", 50)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert close(got(), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in result(spark, "op6_lm_scoring", SF) if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_lm_keeps_its_tables_small(spark, tmp_dir, monkeypatch):
    """Tables of training go as soon as they are used: their largest sum on the way
    and what is left for the result are bounded by the text."""
    rng = np.random.default_rng(11)
    words = np.minimum(rng.zipf(1.3, 300_000), 50_000)
    texts = [" ".join(f"w{w:x}" for w in part) for part in np.split(words, 1000)]
    pq.write_table(pa.table({"doc_id": pa.array(range(1000), pa.int64()), "text": texts}), f"{tmp_dir}/documents.parquet")
    root = re.sub("^file:/*", "/", scratch_path(spark, "x").rsplit("/", 1)[0])
    size = lambda: sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(root) for f in fs)
    before, held, write = size(), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (write(self, *a, **k), held.append(size() - before))[0])
    rows = QUERIES["op6_lm_scoring"](spark, tmp_dir).collect()
    assert len(rows) == 1000 and {r.train_tokens for r in rows} == {sum(r.n_tokens for r in rows if not r.held_out)}
    text = sum(map(len, texts))
    assert 0 < size() - before < 1.2 * text and max(held) < 2 * text, ((size() - before) / text, max(held) / text)


def test_lm_seating_does_not_depend_on_the_batch():
    n = 4000
    key, c = np.arange(n, dtype=np.uint64) * np.uint64(2654435761), np.where(np.arange(n) % 2, 400.0, 129 + np.arange(n) % 70)
    draw = lambda s: pitman_yor.seat(key[s], 1, c[s], np.full(len(c[s]), 2.0), np.full(len(c[s]), 0.5), 0.75)
    whole = draw(slice(None))
    last = np.flatnonzero(c == 129)                     # one customer is left when the others come in twos
    assert len(last) > 50 and draw(last).tolist() == whole[last].tolist()


def test_lm_packed_columns_come_back():
    for n in (0, 1, 2, 1000):
        columns = [np.arange(n) - 5 << 40, np.linspace(-3, 3, n), np.arange(n, dtype=np.int32), np.ones(n, np.int8), np.arange(3)]
        back = pitman_yor.unpack(pitman_yor.pack(*columns))
        assert [(x.dtype, x.tolist()) for x in back] == [(x.dtype, x.tolist()) for x in columns]
        assert all(x.flags.writeable for x in back) and np.cumsum(pitman_yor.steps_of(columns[0])).tolist() == columns[0].tolist()


@pytest.mark.parametrize("c, a0, d", [(2, 0.3, 0.75), (40, 2.0, 0.75), (400, 0.02, 0.6)])
def test_lm_seating_follows_the_rule(c, a0, d):
    """Tables drawn for many dishes against the exact distribution."""
    n, da = 40_000, 0.01
    t = pitman_yor.seat(np.arange(n, dtype=np.uint64) * np.uint64(2654435761), 3, np.full(n, float(c)), np.full(n, a0), np.full(n, da), d)
    p = {1: 1.0}
    for i in range(1, c):
        step = defaultdict(float)
        for k, x in p.items():
            new = (a0 + da * k) / (a0 + da * k + i - d * k)
            step[k + 1] += x * new
            step[k] += x * (1 - new)
        p = step
    mean = sum(k * x for k, x in p.items())
    spread = math.sqrt(sum((k - mean) ** 2 * x for k, x in p.items()))
    assert abs(t.mean() - mean) < 5 * spread / math.sqrt(n) + 0.02 * (mean - 1) and abs(t.std() - spread) < 0.05 * spread
    few = np.full(n, 5000.0)
    wide = pitman_yor.binomial(*(pitman_yor.uniform(np.arange(n, dtype=np.uint64), 1, s) for s in (0, 1)), few, np.full(n, 0.9))
    assert abs(wide.mean() - 4500) < 1 and abs(wide.std() - math.sqrt(450)) < 1


def plain_simhash(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, sf):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in result(spark, "op7_simhash_dedup", sf)),
                 key=lambda r: (key(r[0]), r[1]))
    fp = [plain_simhash(r[1]) for r in ROWS]
    n = len(ROWS)
    root = np.arange(n)
    i, j = np.nonzero([[(a ^ b).bit_count() <= 3 for a in fp] for b in fp])
    v, r = forest(n, i, j)
    root[v] = r
    first = {x: min((ROWS[k][0] for k in np.flatnonzero(root == x) if ROWS[k][0] is not None), default=None) for x in set(root)}
    want = sorted(((ROWS[k][0], f"{fp[k]:016x}", first[root[k]]) for k in range(n)), key=lambda r: (key(r[0]), r[1]))
    assert got == want
    kept = corpus_pipeline.dedup(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert kept.count() == len(set(root)) and kept.columns[:4] == ["doc_id", "text", "lang", "source"]


@pytest.mark.parametrize("shard_rows", [16, 64])
def test_vantage_point_shards_lose_no_link(spark, shard_rows):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 40, np.uint64)
    fp = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6))) for c in centre for _ in range(12)}
    fp |= {int(centre[0]) ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)}             # a dense ball
    fp = np.array(sorted(fp), np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    comp = {r.v: r.root for r in components(simhash.links(frame, shard_rows=shard_rows)).collect()}
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]) <= 3)
    root = np.arange(len(fp))
    v, r = forest(len(fp), i, j)
    root[v] = r
    mine = [comp.get(int(x), -1 - k) for k, x in enumerate(fp.view(np.int64))]
    assert len(set(zip(mine, root.tolist()))) == len(set(mine)) == len(set(root.tolist()))


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.root].add(r.v)
    assert sorted(map(sorted, by.values())) == [list(range(61)), list(range(100, 160)), list(range(200, 207))]


@pytest.mark.parametrize("node_rows", [8, 50])
def test_cover_tree_nodes(spark, sf, node_rows, monkeypatch):
    whole = sorted(tuple(r.items()) for r in result(spark, "op2_embedding_dedup", sf))
    plain = embedding_dedup.near_links
    monkeypatch.setattr(embedding_dedup, "near_links", lambda c, t: plain(c, t, node_rows))
    assert sorted(tuple(r.items()) for r in result(spark, "op2_embedding_dedup", sf)) == whole
    assert sum(r[1][1] > 0 for r in whole) > 30


def test_mixing_reaches_its_targets(spark):
    cell = spark.createDataFrame([(s, l, "x", int(10 + 7 * k)) for k, (s, l) in enumerate((s, l) for s in "abc" for l in "de")],
                                 "source string, lang string, topic string, tokens long")
    want = {"source": {"a": .5, "b": .3, "c": .2}, "lang": {"d": .6, "e": .4}, "topic": {"x": 1.0}}
    given = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in want.items()}
    rows = mixing.rates(cell, list(want), given=given).collect()
    for d, t in want.items():
        for value, share in t.items():
            assert abs(sum(r.weight for r in rows if r[d] == value) - share) < 1e-6
    total = sum(r.tokens * r.rate for r in rows)
    assert abs(total / sum(r.tokens for r in rows) - mixing.SHARE) < 1e-6
    assert abs(sum(r.tokens * r.rate for r in rows if r.source == "a") / total - .5) < 1e-6


def test_one_stray_document_leaves_the_rates_of_the_others(spark):
    rng = random.Random(3)
    rows = [(s, g, t, rng.randint(20_000, 900_000)) for s in "abcd" for g in "de" for t in "xy"]
    shape, dims = "source string, lang string, topic string, tokens long", ["source", "lang", "topic"]
    rate = lambda x: {tuple(r)[:3]: r.rate for r in mixing.rates(spark.createDataFrame(x, shape), dims).collect()}
    plain, more = rate(rows), rate([*rows, ("nowhere", "zz", "x", 30)])
    assert more.pop(("nowhere", "zz", "x")) > 1 and all(abs(more[c] / r - 1) < 0.02 for c, r in plain.items())


def test_repeated_mix_gives_each_document_its_copies(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = Counter()
    for r in result(spark, "op8_source_mixing", sf):
        assert r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1) and r["kept"] == (r["copies"] > 0)
        want[key(r["doc_id"])] += r["copies"]
    out = mixing.repeat_mix(docs)
    assert out.columns == docs.columns and Counter(key(r.doc_id) for r in out.collect()) == +want


def test_one_stray_document_moves_the_sample_little(spark):
    docs = spark.read.parquet(f"{SF[:-5]}0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    stray = spark.createDataFrame([(-1, "one two three " * 10, "xx", "nowhere")], docs.schema)
    plain, more = [{r.doc_id for r in corpus_pipeline.mixing(spark, d, SF).select("doc_id").collect()} for d in (docs, docs.union(stray))]
    assert -1 in more and len(plain ^ (more - {-1})) < 0.03 * len(plain)


def test_budgeted_mix_reaches_budget_and_targets(spark):
    rng = random.Random(4)
    rows = [(s, g, t, rng.randint(2_000, 90_000)) for s in "abcd" for g in "de" for t in "xy"] + [("thin", "zz", "x", 30), (None, "d", "y", 400)]
    cell = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    dims, total = ["source", "lang", "topic"], sum(r[3] for r in rows)
    got = mixing.budgeted(cell, dims).collect()
    assert all(0 < r.probability <= 1 for r in got)
    assert abs(sum(r.tokens * r.probability for r in got) / total - mixing.SHARE) < 1e-6
    for k, d in enumerate(dims):
        x = {v: sum(r[3] for r in rows if r[k] == v) ** mixing.TEMPERATURE[d] for v in {r[k] for r in rows}}
        cap = {v: sum(r[3] for r in rows if r[k] == v) / total / mixing.SHARE for v in x}
        lo, hi = 0.0, 1.0
        for _ in range(80):
            m = (lo + hi) / 2
            lo, hi = (m, hi) if sum(min(cap[v], m * x[v]) for v in x) < 1 else (lo, m)
        for v in x:
            assert abs(sum(r.weight for r in got if r[d] == v) - min(cap[v], lo * x[v])) < 0.005
    everything = mixing.budgeted(cell, dims, share=1.0).collect()
    assert all(r.probability > 0.999999 for r in everything)


def test_quality_filter_keeps_rows_as_they_are(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = Counter(map(tuple, corpus_pipeline.quality(spark, docs, sf).collect()))
    verdict = Counter(r["doc_id"] for r in result(spark, "op9_quality_rules", sf) if r["kept"])
    assert Counter(t[0] for t in kept.elements()) == verdict and not kept - Counter(map(tuple, docs.collect()))


def test_sketch_bucket_error(spark):
    rows = spark.range(0, 5000, 7).select("id", quality_rules.bucket(quality_rules.F.col("id")).alias("b")).collect()
    assert all(r.b <= r.id < r.b * (1 + 2 ** -(quality_rules.SUB_BITS - 1)) + 1 for r in rows)


def test_language_id(spark, sf):
    rows = result(spark, "op10_language_id", sf)
    assert len(rows) == len(ROWS) + 3
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for i, text, lang, _ in ROWS:
        if i is not None and i not in (7, 10, 11) and re.search("[^\\W\\d_]", text or "") and len(text) > 60 and lang in SYL:
            assert by[i]["language"] == lang and by[i]["kept"], i
        if not (text or "").strip() and i is not None:
            assert not by[i]["kept"] and by[i]["language"] == "und"
    kept = corpus_pipeline.language(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert kept.columns == spark.read.parquet(f"{sf}/documents.parquet").columns
    assert kept.filter("text is null").count() == 0


def test_language_evidence_outweighs_a_wrong_declaration(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choice(SYL[g]) for _ in range(2)) for _ in range(40)), g, f"http://{g}.example.{g}/") for i in range(60) for g in SYL]
    rows += [(99, rows[1][1], "en", "http://fr.example.fr/x"), (98, "an", None, "http://fr.example.fr/y")]
    df = spark.createDataFrame(rows, "id long, t string, d string, a string")
    f = language_id.F.col
    out = {r.id: r.v for r in language_id.identify(df, f("t"), f("d"), f("a"), "v").collect()}
    assert out[99].language == "fr" and out[99].kept


def test_rare_declared_languages_are_kept(spark):
    rng = random.Random(3)
    syl = {**SYL, "eu": "tx ak ez ko ra gu ze tz bil ari".split(), "mt": "xx ħa qo ij ġu wa".split()}
    say = lambda g, n=60: " ".join("".join(rng.choice(syl[g]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(g), g, f"{g}.example.{g}") for i in range(60) for g in SYL]
    rows += [(100, say("mt"), "mt", "news.mt"), *[(101 + k, say("eu"), "eu", "berri.eus") for k in range(5)]]
    rows += [(120, say("en"), "xq", "en.example.en")]               # a slip of the pen: English by text and host
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs, SF).filter("doc_id >= 100").collect()}
    assert got == {100: "mt", 120: "en", **{101 + k: "eu" for k in range(5)}}


def test_text_scores_against_plain_sums():
    rng = np.random.default_rng(1)
    n = rng.integers(0, 4, (3, language_id.BUCKETS)) * (rng.random((3, language_id.BUCKETS)) < 0.2)
    lang, bucket = np.nonzero(n)
    model = language_id.TextModel(["a", "b", "c"], bucket, lang, n[lang, bucket])
    pool = (n.sum(0) + language_id.SMOOTH) / (n.sum() + language_id.SMOOTH * language_id.BUCKETS)
    mix = lambda k: np.log(0.9 * k / k.sum() + 0.1 * pool)
    for c, said in ((np.minimum(n[1], 1), "b"), (np.minimum(n[2], n[1]), "b"), (n[0], None)):
        plain = [c @ mix(n[0]), c @ mix(n[1]), c @ mix(n[2])]
        if said and max(plain[0], plain[2]) > c @ np.log(pool):
            plain[1] = c @ mix(n[1] - c)
        assert np.allclose(model.score(c, said), [*plain, -c.sum() * np.log(language_id.BUCKETS)])


def test_pipeline_is_its_stages_and_brute_force_holds(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf)
        path = scratch_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == before.columns and 0 < docs.count() <= before.count()
    fp = [plain_simhash(r.text) for r in docs.collect()]
    assert all((a ^ b).bit_count() > 3 for k, a in enumerate(fp) for b in fp[:k])
    last = Counter((r.doc_id, r.piece, r.start, r.n_tokens) for r in corpus_pipeline.packing(spark, docs, sf).collect())
    assert last == Counter((r["doc_id"], r["piece"], r["start"], r["n_tokens"]) for r in result(spark, "pipeline", sf))


def test_fences_move_with_the_group(spark):
    """Fences follow each group's own tail; a clean group still rejects junk, and a small group takes its language's."""
    rng, rows = random.Random(3), []
    for s, (noise, words) in {"prose": (0, 200), "short": (0, 50), "code": (40, 200), "few": (0, 200)}.items():
        for k in range(30 if s == "few" else 300):
            w = ["".join(rng.choice(SYL["en"]) for _ in range(2)) for _ in range(words)]
            for i in rng.sample(range(words), rng.randint(0, noise)):
                w[i] = "#"
            if k % 20 == 0 and s != "code":
                w = ["#$%"] * 30 + w[:100]
            rows.append((s, k, " ".join(w)))
    docs = quality_rules.measures(spark.createDataFrame([("en", *r) for r in rows], "lang string, source string, k int, text string"), "text", "m")
    th = quality_rules.thresholds(quality_rules.sketch(docs, "lang", "source", "m"))
    got = {r.source: r for r in th.collect()}
    assert got["short"].fence_symbols > got["prose"].fence_symbols > 0
    assert got["code"].fence_symbols > 2000 and len({r.fence_symbols for r in got.values()}) == 4
    kept = {(r.source, r.k) for r in quality_rules.filter_quality(
        spark.createDataFrame([("en", *r) for r in rows], "lang string, source string, k int, text string")).collect()}
    assert all((s, k) in kept for s, k, _ in rows if s == "code" or k % 20)
    assert not any((s, k) in kept for s, k, _ in rows if s in ("prose", "short") and k % 20 == 0)


def test_quality_keeps_documents_labelled_good(spark):
    """No document labelled good is lost beside those of the base rules; most labelled bad ones go."""
    d = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [(label[r.doc_id], r.kept) for r in QUERIES["op9_quality_rules"](spark, d).collect()
           if r.doc_id in label and not r.base_failed]
    good, bad = [k for q, k in got if q == 1], [k for q, k in got if q == 0]
    assert len(good) > 100 and all(good) and sum(bad) < len(bad) / 2


@pytest.mark.parametrize("node_rows", [4096, 3])
def test_links_do_not_depend_on_magnitude(spark, tmp_path, monkeypatch, node_rows):
    """Near-parallel vectors link at any magnitude, whatever row comes first, and orthogonal ones do not."""
    a, b, c = [1.0, 0.01, 0.0], [1.0, 0.0, 0.01], [0.0, 1.0, 0.0]
    vecs = [[m * x for x in v] for m in (1e-170, 1e160, 1.0, 5e-300, 1e-170, 1e300) for v in (a, b)] + [[m * x for x in c] for m in (1e160, 1e-170)]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vecs)), pa.int64()), "embedding": pa.array(vecs, pa.list_(pa.float64())),
                             "label": pa.array([0] * len(vecs), pa.int32())}), f"{tmp_path}/embeddings.parquet")
    plain = embedding_dedup.near_links
    monkeypatch.setattr(embedding_dedup, "near_links", lambda k, t: plain(k, t, node_rows))
    want = [(i, 11, 0, i == 0) if i < 12 else (i, 1, 12, i == 12) for i in range(14)]
    assert sorted(tuple(r.values()) for r in result(spark, "op2_embedding_dedup", str(tmp_path))) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    assert sorted(con.sql(ORACLE_SQL["op2_embedding_dedup"]).fetchall()) == want
