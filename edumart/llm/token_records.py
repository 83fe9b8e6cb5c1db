"""Token-ID / binary output: length-delimited binary records with masked
checksums, and a separate offset index for shuffled reads.

File format of a shard (all integers little-endian): per document one record

    uint64 length | uint32 masked CRC-32 of the 8 length bytes
    payload       | uint32 masked CRC-32 of the payload

where the payload is int64 key, uint8 key-is-null, uint8 bytes per id (2 for a
vocabulary of at most 65,536 ids, else 4), then the token ids. A
checksum is masked as ``rotate_right(crc, 15) + 0xA282EAD8`` so that a checksum
over data that holds checksums stays useful. Shard ``k`` holds the ``k``-th
range of the ascending key order; the index is a Parquet table with one row per
record (shard, ordinal, key, byte offset, token count).

Scale: one range exchange of (key, text); every task encodes and appends its
own shard with one record in memory; shard files go to the shared folder under
an attempt's own name and are moved into place when complete, so a lost
executor only repeats its shard. Global token positions need the total of each
earlier shard only: one row per shard, summed by Spark.

Defined results: a null text is an empty one (only the end id); null keys come
first in the order; rows with equal keys are ordered by the hash of their text,
then by text, and each keep their own record; an empty table gives no shard rows and an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edumart.llm import bpe
from edumart.llm.common import materialize, table
from edumart.session import scratch_path

END_ID = 0
_LEN, _CRC, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB")
INDEX = "shard int, ordinal long, key long, byte_offset long, n_tokens long"
FLUSH = 4 << 20                # bytes buffered before a write, and read at a time


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = _LEN.pack(len(payload))
    return b"".join((head, _CRC.pack(masked(head)), payload, _CRC.pack(masked(payload))))


def pack(key: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(key or 0, key is None, width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Key and token ids (uint32) of a payload."""
    key, null, width = _HEAD.unpack_from(payload)
    return (None if null else key), np.frombuffer(payload, f"<u{width}", offset=_HEAD.size).astype("<u4", copy=False)


def read_record(f) -> bytes | None:
    """The next payload of an open file, None at its end; raises on damage."""
    head = f.read(12)
    if not head:
        return None
    if len(head) < 12 or _CRC.unpack(head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    n = _LEN.unpack(head[:8])[0]
    body = f.read(n + 4)
    if len(body) < n + 4 or _CRC.unpack(body[n:])[0] != masked(body[:n]):
        raise ValueError("damaged record")
    return body[:n]


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(path: str) -> str:
    return f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path


def write_records(docs: DataFrame, key: str, text: str, folder: str, spec: str, end_id: int = END_ID) -> DataFrame:
    """Encode and write all rows; returns the materialised index (``INDEX``)."""
    folder = _uri(folder)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId()
        enc, out, size, at, buffer = bpe.encoder(spec), None, 0, 0, []
        fs, root = _fs(folder)
        temp, final = f"{root}/tmp-{k:06d}-{uuid.uuid4().hex}", f"{root}/shard-{k:06d}.bin"
        rows, ordinal = [], 0
        for b in batches:
            for key_, text_ in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(temp)
                ids = enc.ids(text_.as_py() or "") + end_id.to_bytes(enc.width, "little")
                record = frame(pack(key_, ids, enc.width))
                rows.append((k, ordinal, key_, at, len(ids) // enc.width))
                buffer.append(record)
                at, size, ordinal = at + len(record), size + len(record), ordinal + 1
                if size >= FLUSH:
                    out.write(b"".join(buffer))
                    buffer, size = [], 0
                if len(rows) >= 10_000:
                    yield _batch(rows, INDEX_ARROW)
                    rows = []
        if out is not None:
            out.write(b"".join(buffer))
            out.close()
            fs.move(temp, final)
        if rows:
            yield _batch(rows, INDEX_ARROW)

    # ranges of key and text hash: the sampled bounds that reach the driver hold no texts
    ordered = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t")) \
        .repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t").select("k", "t")
    return materialize(ordered.mapInArrow(shard, INDEX), "records-index")


INDEX_ARROW = pa.schema([("shard", pa.int32()), ("ordinal", pa.int64()), ("key", pa.int64()),
                         ("byte_offset", pa.int64()), ("n_tokens", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def shard_starts(index: DataFrame) -> DataFrame:
    """(shard, base): tokens in all earlier shards; one row per shard."""
    per = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """All records, read back from the files shard by shard and verified:
    (key, start, n_tokens, ids_crc32, shard, byte_offset)."""
    folder = _uri(folder)
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("shard", pa.int32()), ("byte_offset", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, root = _fs(folder)
                rows, at = [], 0
                with fs.open_input_stream(f"{root}/shard-{k:06d}.bin", buffer_size=FLUSH) as f:
                    while (payload := read_record(f)) is not None:
                        key, ids = unpack(payload)
                        rows.append((key, base, len(ids), zlib.crc32(ids), k, at))
                        base, at = base + len(ids), at + len(payload) + 16
                        if len(rows) >= 10_000:
                            yield _batch(rows, schema)
                            rows = []
                if rows:
                    yield _batch(rows, schema)

    shards = shard_starts(materialize(index.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")), "records-shards"))
    # a stated number of tasks: a row per shard is too little for Spark to deal out by size
    return shards.repartition(max(1, shards.count()), F.col("shard")).mapInArrow(
        read, "key long, start long, n_tokens long, ids_crc32 long, shard int, byte_offset long")


def read_at(folder: str, shard: int, byte_offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its index entry: (key, token ids). For shuffled reads."""
    fs, root = _fs(_uri(folder))
    with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
        f.seek(byte_offset)
        payload = read_record(f)
    return unpack(payload)


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    index = write_records(table(spark, sf_dir, "documents"), "doc_id", "text", folder, bpe.read_spec())
    return read_records(spark, folder, index).withColumnRenamed("key", "doc_id")
