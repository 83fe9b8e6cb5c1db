"""Fill-in-middle transformation by in-place block rotation.

A text is held as one bytearray of its UTF-8 bytes. A scan over blocks counts
its units (runs of ASCII letters, or single other code points), a second one
finds the byte offsets of the two cuts. The sentinels are inserted at the cuts,
and segments change places by a rotation of the buffer: reverse the left block,
reverse the right block, reverse both together. Restoring reads the sentinels
of the output, turns the same rotation back and takes the sentinels out.

    psm   <P>prefix <S>suffix <M>middle   rotates [<M>middle][<S>suffix]
    spm   <S>suffix <P>prefix <M>middle   rotates [<P>prefix<M>middle][<S>suffix]

A text that holds a sentinel stays plain, so the first sentinels of an output
are its own: a sentinel has its only ``<`` in front and its only ``>`` at the
end, so none can arise across a seam.

Scale: no shuffle; rows stream through Arrow, one text in memory at a time as
one buffer plus blocks of a fixed size (the scans and reversals never build an
object per unit).

Defined results: a null text is an empty one; an empty text is plain with 0
units; a null key is hashed as the empty string; repeated rows get equal
results; an empty table gives an empty result; only the key and text columns
are read, so extra or clashing columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import table

# Sentinels and rates of the query contract.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = "1:"
PLAIN_FROM, SPM_BELOW = 90, 20     # h3 % 100 from which a text stays plain; h4 % 100 below which it is spm

BLOCK = 1 << 20                    # bytes looked at or exchanged at a time
FLUSH = 4 << 20                    # bytes of output held before a batch goes out
SCHEMA = ("key long, n long, form string, prefix_chars long, middle_chars long, "
          "output string, restored string")


def draws(key: int | None) -> list[int]:
    """h1 to h4: the first four 8-digit groups of the salted key's sha256."""
    digest = hashlib.sha256(f"{SALT}{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def _starts(data: memoryview) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, mask of the bytes that begin a unit) for each block of the text."""
    carry = False                  # is the byte before the block a letter?
    for at in range(0, len(data), BLOCK):
        b = np.frombuffer(data[at:at + BLOCK], np.uint8)
        folded = b | 0x20
        letter = (folded >= 97) & (folded <= 122)
        before = np.empty_like(letter)
        before[0], before[1:] = carry, letter[:-1]
        carry = bool(letter[-1])
        yield at, ((b & 0xC0) != 0x80) & ~(letter & before)


def count_units(data: bytes | bytearray) -> int:
    with memoryview(data) as view:
        return sum(int(np.count_nonzero(s)) for _, s in _starts(view))


def offsets(data: bytes | bytearray, cuts: tuple[int, int]) -> list[int]:
    """Byte offsets at which ``cuts`` (ascending numbers of units) end."""
    found, seen = [], 0
    with memoryview(data) as view:
        for at, starts in _starts(view):
            here = int(np.count_nonzero(starts))
            while len(found) < len(cuts) and cuts[len(found)] < seen + here:
                found.append(at + int(np.flatnonzero(starts)[cuts[len(found)] - seen]))
            if len(found) == len(cuts):
                return found
            seen += here
    return found + [len(data)] * (len(cuts) - len(found))


def reverse(a: np.ndarray, lo: int, hi: int) -> None:
    """Reverse ``a[lo:hi]`` in place, exchanging blocks from both ends."""
    while hi - lo > 1:
        k = min(BLOCK, (hi - lo) // 2)
        left = a[lo:lo + k].copy()
        a[lo:lo + k] = a[hi - k:hi][::-1]
        a[hi - k:hi] = left[::-1]
        lo, hi = lo + k, hi - k


def rotate(buffer: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange the neighbouring blocks ``[lo, mid)`` and ``[mid, hi)`` in place."""
    a = np.frombuffer(buffer, np.uint8)
    reverse(a, lo, mid)
    reverse(a, mid, hi)
    reverse(a, lo, hi)


def transform(buffer: bytearray, form: str, a: int, b: int) -> None:
    """Turn the text in ``buffer``, cut at bytes ``a`` and ``b``, into its form."""
    if form == "plain":
        return
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = a + 3, b + 6
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))


def restore(buffer: bytearray, form: str) -> None:
    """Turn an output back into the text, from the output and its form alone."""
    if form == "plain":
        return
    if form == "psm":
        first, second = buffer.index(SUFFIX), buffer.index(MIDDLE)   # <S>suffix | <M>middle
        rotate(buffer, first, second, len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))         # <S>suffix | <P>prefix<M>middle
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at:at + len(sentinel)]


def choose(key: int | None, data: bytes) -> tuple[int, str, int, int]:
    """(units, form, first cut, second cut in bytes) of a text."""
    n, (h1, h2, h3, h4) = count_units(data), draws(key)
    if not data or h3 % 100 >= PLAIN_FROM or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", 0, 0
    a, b = offsets(data, tuple(sorted((h1 % (n + 1), h2 % (n + 1)))))
    return n, "spm" if h4 % 100 < SPM_BELOW else "psm", a, b


def _chars(data: bytearray, lo: int, hi: int) -> int:
    """Code points of ``data[lo:hi]``."""
    with memoryview(data) as view:
        return sum(int(np.count_nonzero((np.frombuffer(view[at:min(at + BLOCK, hi)], np.uint8) & 0xC0) != 0x80))
                   for at in range(lo, hi, BLOCK))


def fill_in_middle(docs: DataFrame, key: str, text: str, with_restored: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, units, form, code points of prefix and
    middle (null if plain), the output text and, if asked for, the text restored
    from output and form (else null)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                k, data = k.as_py(), t.as_buffer().to_pybytes() if t.is_valid else b""
                n, form, a, b = choose(k, data)
                buffer = bytearray(data)
                sizes = (None, None) if form == "plain" else (_chars(buffer, 0, a), _chars(buffer, a, b))
                transform(buffer, form, a, b)
                out = bytes(buffer)
                if with_restored:
                    restore(buffer, form)
                held.append((k, n, form, *sizes, out, bytes(buffer) if with_restored else None))
                size += len(out)
                if size >= FLUSH or len(held) >= 4096:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(rows, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays([*columns[:5], *(c.cast(pa.string()) for c in columns[5:])],
                                      ["key", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"), "doc_id", "text", with_restored=True).select(
        F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
  ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h),
c AS (SELECT *, len(w)::BIGINT AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM s
"""
