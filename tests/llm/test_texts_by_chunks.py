"""Whole texts read chunk by chunk: fingerprints, packing keys and bands do not
depend on the chunk; recall of the bands; language evidence against plain sums."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from edumart.llm import language_id, packing, simhash
from edumart.llm.common import word_chunks


def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeFé中") for _ in range(rng.randint(1, 9)))
    out = ["", " \t\n", "one", "One two", "a b c", "a b c d", "x" * 500, " lead and trail ", "tab\tnew\nline\x0bv\x0cf\rr", "nbsp\xa0stays \x1c too"]
    return out + [" ".join(word() for _ in range(n)) for n in (4, 5, 6, 40, 300)] + ["w " * 200 + "y" * 90]


def plain_fingerprint(text, k=3):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("chunk", [1, 3, 17, 64, 1 << 20])
def test_results_do_not_depend_on_the_chunk(monkeypatch, chunk):
    monkeypatch.setattr(packing, "LONG_WORD", 64)
    want = [packing.read_text(t) for t in texts()]
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(packing, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "RUN", 7)
    monkeypatch.setattr(packing, "SHINGLES_HELD", 5)
    for t, w in zip(texts(), want):
        data = t.encode().lower()
        assert [x for c in word_chunks(data, chunk) for x in c] == data.split()
        assert simhash.fingerprint(t) == plain_fingerprint(t)
        got = packing.read_text(t)
        assert got[:2] == w[:2] and got[0] == len(data.split()) and got[2].tolist() == w[2].tolist()
    assert packing.read_text(None)[0] == 0 and simhash.fingerprint(None) == 0


def test_bands_find_near_copies():
    """Of pairs whose five-word shingles agree to 0.8 or more nearly all meet in a band."""
    rng, met, n, far = random.Random(4), 0, 0, 0
    shingles = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    while n < 300:
        a = [str(rng.randrange(5000)) for _ in range(rng.randint(60, 300))]
        b = a[:]
        for _ in range(rng.randint(1, max(1, len(a) // 45))):
            b[rng.randrange(len(b))] = "changed"
        x, y = shingles(a), shingles(b)
        if len(x & y) / len(x | y) >= 0.8:
            n += 1
            met += bool(set(packing.bands(" ".join(a)).tolist()) & set(packing.bands(" ".join(b)).tolist()))
        c = [str(rng.randrange(5000)) for _ in a]
        far += bool(set(packing.bands(" ".join(a)).tolist()) & set(packing.bands(" ".join(c)).tolist()))
    assert met >= 297 and far == 0


def test_packing_query_equals_plain_best_fit_with_clusters(spark):
    """One shard: the bins of the query are those of a plain best fit over all open bins."""
    rng, rows = random.Random(6), []
    for i in range(120):
        w = [str(rng.randrange(900)) for _ in range(rng.choice([3, 20, 90, 400, 700]))]
        rows.append([i, " ".join(w), f"s{rng.randrange(70)}"])
    for i in range(0, 60, 2):
        w = rows[i][1].split()
        rows[i + 1][1] = " ".join(w if len(w) < 90 else [*w[:-1], "other"])          # copies and near copies
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.bin_id, r.bin_offset) for r in packing.pack_apart(df, capacity=1024).collect()}
    words = {i: len(t.split()) + 1 for i, t, _ in rows}
    cluster = {i: i - 1 if i % 2 and i < 60 else i for i, _, _ in rows}
    source = {i: s for i, _, s in rows}
    bins = []                                                                          # [left, docs]
    for i in sorted(words, key=lambda i: (-words[i], i)):
        fit = [b for b in bins if b[0] >= words[i] and not any(source[j] == source[i] or cluster[j] == cluster[i] for j in b[1])]
        best = min(fit, key=lambda b: b[0], default=None)
        if best is None:
            bins.append(best := [1024, []])
        best[0] -= words[i]
        best[1].append(i)
    by = defaultdict(set)
    for i, (b, _) in got.items():
        by[b].add(i)
    # equal residuals may be taken in another order: as many bins, the same residuals, no conflict
    assert sorted(1024 - sum(words[i] for i in b) for b in by.values()) == sorted(b[0] for b in bins)
    for b in by.values():
        assert len({source[i] for i in b}) == len({cluster[i] for i in b}) == len(b)


def test_language_posterior_equals_plain_sums(spark):
    rng = random.Random(2)
    codes = ["en", "fr", "xx", None]
    rows = []
    for i in range(80):
        letters = "abcd" if i % 2 else "wxyz"
        rows.append((i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(rng.choice([0, 1, 12]))),
                     rng.choice(["en", "en", "en", None, "xx"]) if i % 2 else rng.choice(["fr", "fr", "fr", "not a code"]),
                     rng.choice(["a.example.com", "b.example.org", "books", None])))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.v for r in language_id.identify(df, F.col("text"), F.col("lang"), F.col("source"), "v").collect()}
    li, langs = language_id, sorted({r[2] for r in rows if r[2] in ("en", "fr", "xx") and r[1]})
    assert langs == ["en", "fr", "xx"]
    counts = {i: li.counted(t) for i, t, *_ in rows}
    cells = defaultdict(int)
    for i, _, lang, _ in rows:
        if lang in langs:
            for b, c in enumerate(counts[i]):
                if c:
                    cells[b, langs.index(lang)] += int(c)
    b, g = np.array([k[0] for k in cells]), np.array([k[1] for k in cells])
    model = li.TextModel(langs, b, g, np.array(list(cells.values())))
    ll = {i: model.score(counts[i], lang if lang in langs else None) for i, _, lang, _ in rows}
    used = {i: langs[int(np.argmax(ll[i][:-1]))] for i in ll if counts[i].sum()}
    said = {i: lang if lang in langs else None for i, _, lang, _ in rows}
    suffix = lambda h: h.rsplit(".", 1)[-1] if h and "." in h else ""
    by, pair, host, suf = Counter(used.values()), Counter(), Counter(), Counter()
    for i, l in used.items():
        pair[said[i], l] += 1
        host[rows[i][3], l] += 1
        suf[suffix(rows[i][3]), l] += 1
    n_of = lambda c, k: sum(v for (a, _), v in c.items() if a == k)
    whole = {l: (by[l] + li.SMOOTH) / (sum(by.values()) + li.SMOOTH * 3) for l in langs}
    for i, text, lang, h in rows:
        if not counts[i].sum():
            assert (out[i].language, out[i].kept) == ("und", False)
            continue
        score = []
        for k, l in enumerate(langs):
            ps = (suf[suffix(h), l] + li.SUFFIX_K * whole[l]) / (n_of(suf, suffix(h)) + li.SUFFIX_K)
            ph = (host[h, l] + li.HOST_K * ps) / (n_of(host, h) + li.HOST_K)
            pd = (pair[said[i], l] + li.SMOOTH) / (by[l] + li.SMOOTH * 4)
            score.append(li.TEMPER * ll[i][k] + math.log(ph) + math.log(pd))
        score.append(li.TEMPER * ll[i][-1] + math.log(li.UND_PRIOR))
        top = max(score)
        post = 1 / sum(math.exp(x - top) for x in score)
        assert out[i].language == [*langs, "und"][score.index(top)] and out[i].posterior == pytest.approx(post)
        assert out[i].kept == (post >= 0.5 and out[i].language != "und")
    assert codes


def test_many_declared_codes_make_no_longer_plan(spark):
    """300 codes, some with one row: every code is in the inventory and its rows keep it."""
    rng = random.Random(1)
    codes = [a + b + c for a in "abcdefghij" for b in "klmnop" for c in "uvwxy"]
    rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(30)), codes[i % 300], f"s{i % 9}") for i in range(330)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = language_id.identify(df, F.col("text"), F.col("lang"), F.col("source"), "v")
    assert len(got._jdf.queryExecution().analyzed().toString()) < 200_000
    assert got.count() == 330


def test_language_id_bounds_the_bytes_of_a_batch(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from edumart.llm.language_id import filter_language
    from edumart.session import BYTES_A_BATCH

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    docs = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some plain words "), 500).alias("text"), F.lit("en").alias("lang"), F.lit("a.org").alias("source"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    try:
        assert filter_language(docs).count() == 2000
        got = docs.select("text").mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 2000 and max(r["size"] for r in got) < 1.1 * BYTES_A_BATCH
        spark.conf.set(name, str(1 << 20))                       # the user's own bound stays
        filter_language(docs.limit(5))
        assert spark.conf.get(name) == str(1 << 20)
    finally:
        spark.conf.unset(name)
