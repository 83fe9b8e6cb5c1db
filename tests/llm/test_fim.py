"""Fill-in-middle against a plain regex-and-slice model, and exact round trips."""

import hashlib
import random
import re

import pytest

from edumart.llm import fim

TEXTS = ["", " ", "a", "ab cd", "é", "中文 a b", "x<P>y", "<", "P>", "a\nb\r\n\tc", "zz" * 50, "é" * 40, "a1" * 60, "<S", "M> <M", "\x00a\x00",
         "The quick brown fox, jumps over 12 dogs. " * 9]


def model(key, text):
    x = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i:i + 8], 16) for i in range(0, 32, 8))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 20
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def run(key, text):
    data = text.encode()
    n, form, a, b = fim.choose(key, data)
    buffer = bytearray(data)
    sizes = (None, None) if form == "plain" else (fim._chars(buffer, 0, a), fim._chars(buffer, a, b))
    fim.transform(buffer, form, a, b)
    out = buffer.decode()
    fim.restore(buffer, form)
    assert buffer == data
    return n, form, *sizes, out


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 20])
def test_rotations_equal_slices_at_every_block_size(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    for text in TEXTS:
        for key in (None, 0, 1, 5, -3, 12, 77, 123456789012):
            assert run(key, text) == model(key, text), (key, text)


def test_random_texts_and_rotations(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(fim, "BLOCK", 5)
    forms = set()
    for key in range(400):
        text = "".join(rng.choice("abZ <>PSM\né中😀0") for _ in range(rng.randint(0, 60)))
        got = run(key, text)
        assert got == model(key, text)
        forms.add(got[1])
    assert forms == {"plain", "psm", "spm"}
    for _ in range(200):
        x = bytearray(rng.randbytes(rng.randint(0, 30)))
        lo, mid, hi = sorted(rng.randint(0, len(x)) for _ in range(3))
        want = x[:lo] + x[mid:hi] + x[lo:mid] + x[hi:]
        fim.rotate(x, lo, mid, hi)
        assert x == want


def test_query_with_nulls_long_and_repeated_rows(spark, tmp_path):
    long = "word é " * 400_000
    rows = [(1, long), (1, long), (2, None), (None, "a b c d"), (None, None), *[(i, t) for i, t in enumerate(TEXTS, 10)]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, output string, key long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = fim.op13_fill_in_middle(spark, str(tmp_path)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key, text in rows:
        n, form, p, m, out = model(key, text or "")
        want.append((key, n, form, p, m, sha(out), sha(text or "")))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    plain = fim.fill_in_middle(df, "doc_id", "text").filter("key = 1").first()
    assert plain.output == model(1, long)[4] and plain.restored is None
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fim.op13_fill_in_middle(spark, f"{tmp_path}/none").count() == 0
