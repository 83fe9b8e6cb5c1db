"""The threshold algorithm and the mining query against brute force over Python integers."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from edumart.llm import hard_negatives as hn


def floor_scaled(x):
    return math.floor(x * 256) if math.isfinite(x * 256) else int(x) * 256


def brute(rows, every=100):
    best = {}
    for i, e, l in rows:
        if i is None or l is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        l = int(math.fmod(l + 1, 10)) if i % 7 == 0 else l
        best[i] = min(best.get(i, (l, e)), (l, e))
    q = {i: (l, [floor_scaled(x) for x in e]) for i, (l, e) in best.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    out = []
    for a, (la, va) in q.items():
        if a % every:
            continue
        ranked = sorted((-dot(va, v), i, l) for i, (l, v) in q.items() if i != a)
        for s, p, l in [r for r in ranked if r[2] == la][:5]:
            ps = clip(-s)
            hits = [(i, clip(-t)) for t, i, l_ in ranked if l_ != la and 30 * ps <= -100 * t <= 90 * ps][:10]
            out += [(a, p, r, i, ps, t) for r, (i, t) in enumerate(hits, 1)]
    return sorted(out)


def fixture():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 6))
    vecs = [(centres[i % 4] * rng.choice([0.3, 1.0]) + 0.3 * rng.normal(size=6)).round(1).tolist() for i in range(700)]
    rows = [(i - 100, v, None if i % 31 == 0 else i % 5 % 3) for i, v in enumerate(vecs)]
    rows += [(1000, [0.0] * 6, 1), (1001, [0.0] * 6, 1), (1002, [0.0] * 6, 2), (1100, None, 1), (1200, [math.nan] * 6, 1),
             (1300, [math.inf] + [0.0] * 5, 0), (1400, [1.0, None] + [0.0] * 4, 0), (None, [1.0] * 6, 0),
             (1500, [1.0, 1.0], 0), (1501, [], 0), (1600, [1.0] * 9, 2), (1700, vecs[0], 1), (1700, vecs[0], 1), (1700, vecs[1], 0)]
    return rows + [(2000 + i, vecs[5], i % 3) for i in range(120)]       # one very common vector


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("blocks", [(8192, 1024), (64, 3)])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, blocks):
    monkeypatch.setattr(hn, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", blocks[1])
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit(1), "vec": F.lit("x"), "rb": F.lit(0)})
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hn.op12_hard_negatives(spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_huge_components_and_empty_table(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1, -1]) * rng.choice([1e9, 3e9, 1.5]) for _ in range(3)], i % 4) for i in range(60)]
    rows += [(100, [1e308, -1e308, 1.0], 0), (104, [1e308, 0.0, 0.0], 0), (200, [1e-320, 0.0, 0.0], 1), (201, [2.0, 0.0, 1e300], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hn.op12_hard_negatives(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert hn.op12_hard_negatives(spark, f"{tmp_path}/none").count() == 0


def test_search_is_exact_and_stops_early():
    rng = np.random.default_rng(0)
    for trial in range(60):
        m, d = int(rng.integers(1, 400)), int(rng.integers(1, 7))
        rows = np.floor(rng.normal(size=(m, d)) * rng.choice([1, 3, 40]))
        anchor = np.floor(rng.normal(size=d) * 3) * (rng.random(d) < 0.8)
        allowed, ids = rng.random(m) < 0.7, rng.permutation(m)
        windows = [(-math.inf, math.inf), (-5, 7), (0, 0), (10, 60), (1e9, 2e9)]
        found, scores = hn.Lists(rows).search(anchor, allowed, windows, 4)
        true = rows @ anchor
        for (low, high), at in zip(windows, found):
            want = [int(i) for i in np.lexsort((ids, -true)) if allowed[i] and low <= true[i] <= high][:4]
            assert hn.best(ids, scores, at, 4) == [(int(ids[i]), int(true[i])) for i in want]
    rows = np.floor(1e5 * rng.random((5000, 3)) ** 6)                     # few rows are large anywhere
    found, scores = hn.Lists(rows).search(np.array([3.0, 1.0, 2.0]), np.ones(5000, bool), [(-math.inf, math.inf)], 5)
    assert np.count_nonzero(scores) < 1000


def test_sql_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = duckdb.sql(hn.ORACLE).fetchall()
    assert sorted(map(tuple, hn.op12_hard_negatives(spark, d).collect())) == sorted(want)
