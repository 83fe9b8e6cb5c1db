"""Token counts as delta-maintained rollups.

Totals by (source, lang, tokenizer version) are additive: a batch of changes is
signed rows (+ an inserted document's count, - a deleted one's; a revision is
both), summed to a delta per group and committed under the batch's id. The
totals are the sum of the committed deltas. Committing an id again changes
nothing: the delta lies in the batch's own folder, a half-written folder (no
``_SUCCESS`` mark) is not read and is overwritten by the retry.

Scale: only changed documents are tokenized, groups are combined on the map
side (a hot source is one group), a batch adds at most a row per group.
``compact`` folds committed deltas into one.

Defined results: a null text has no tokens; null source or lang is a group of
its own; repeated rows count each; an empty batch commits an empty delta;
groups whose documents and tokens are both zero are left out of the totals;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.bpe import PIECE
from edumart.llm.common import materialize, table
from edumart.session import scratch_path

GROUP = ["source", "lang", "tokenizer_version"]
VERSION = "byte_bpe_50k"
CHUNK = 1 << 20                # characters of a text encoded at a time


def read_ranks(path: str | None = None) -> bytes:
    """Content of a rank file (under 1 MB; it is sent to the tasks)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        return f.read()


_ENCODINGS: dict[bytes, object] = {}


def _encoding(ranks: bytes):
    if ranks not in _ENCODINGS:
        import base64

        import public_tokenizers
        import tiktoken
        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODINGS[ranks] = tiktoken.Encoding("rollup", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_, special_tokens={})
    return _ENCODINGS[ranks]


def count_text(encoding, text: str | None) -> int:
    """Tokens of a whole text; long ones in chunks cut where a token always ends."""
    if not text:
        return 0
    if len(text) <= CHUNK:
        return len(encoding.encode_ordinary(text))
    n, run, size = 0, [], 0
    for m in PIECE.finditer(text):
        run.append(m.group())
        size += len(run[-1])
        if size >= CHUNK:
            n, run, size = n + len(encoding.encode_ordinary("".join(run))), [], 0
    return n + len(encoding.encode_ordinary("".join(run)))


def counts(docs: DataFrame, ranks: bytes, version: str = VERSION, doc_id: str = "doc_id",
           text: str = "text", source: str = "source", lang: str = "lang",
           flag: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens, flag), one row per row;
    ``flag`` is a boolean of the row that its count shall keep (default false)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks)
        for b in batches:
            n = [count_text(encoding, t.as_py()) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), b.column(4)],
                                             names=["doc_id", "source", "lang", "n_tokens", "flag"])

    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                      F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
                      F.coalesce(F.lit(False) if flag is None else flag, F.lit(False)).alias("flag")) \
        .mapInArrow(run, "doc_id long, source string, lang string, n_tokens long, flag boolean")
    return out.select("doc_id", "source", "lang", F.lit(version).alias("tokenizer_version"), "n_tokens", "flag")


def changes(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Signed rows of a batch from rows of ``counts``; a revision is its old row
    among ``deleted`` and its new one among ``inserted``."""
    signed = [df.select(*GROUP, F.lit(sign).alias("docs"), (F.lit(sign) * F.col("n_tokens")).alias("tokens"))
              for df, sign in ((inserted, 1), (deleted, -1)) if df is not None]
    out = signed[0]
    for s in signed[1:]:
        out = out.unionByName(s)
    return out


class Rollup:
    """Totals under ``path`` (a folder all executors share)."""

    SCHEMA = "source string, lang string, tokenizer_version string, docs long, tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not batch or any(not (c.isalnum() or c in "-_.") for c in batch):
            raise ValueError(f"not a batch id: {batch!r}")
        return f"{self.path}/batch={batch}"

    def _list(self) -> list[str]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = [f.getPath() for f in fs.listStatus(root)]
        return sorted(p.getName().removeprefix("batch=") for p in done
                      if p.getName().startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def committed(self) -> list[str]:
        """Ids of the committed batches, in name order."""
        return self._list()

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Apply a batch once; False if its id is committed already."""
        if batch in self._list():
            return False
        delta = signed.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        delta.write.mode("overwrite").parquet(self._folder(batch))
        return True

    def totals(self) -> DataFrame:
        done = [self._folder(b) for b in self._list()]
        deltas = self.spark.read.schema(self.SCHEMA).parquet(*done) if done else self.spark.createDataFrame([], self.SCHEMA)
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")) \
            .filter("docs <> 0 or tokens <> 0")

    def compact(self, into: Rollup, batch: str) -> Rollup:
        """Fold all committed deltas into one batch of another (empty) store."""
        into.commit(batch, self.totals())
        return into


def without_repeated_lines(text: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(text, "\n")), "\n")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; toxic ones are deleted; documents with
    repeated lines are revised to their text without them; the first two batches
    arrive again. The flag of a loaded count says whether its row is revised, so
    rows that share an id, or have none, are revised each on its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    ranks = read_ranks()
    line = without_repeated_lines(F.col("text"))
    first = materialize(counts(docs, ranks, flag=line != F.col("text")), "token-counts")
    store = Rollup(spark, scratch_path(spark, "token-rollup"))
    load, removal = changes(first), changes(deleted=first.join(toxic, "doc_id", "left_semi"))
    store.commit("0-load", load)
    store.commit("1-toxic", removal)
    revised = docs.filter(line != F.col("text")).join(toxic, "doc_id", "left_anti")
    old = first.filter("flag").join(toxic, "doc_id", "left_anti")
    store.commit("2-lines", changes(counts(revised.withColumn("text", line), ranks), old))
    store.commit("0-load", load)
    store.commit("1-toxic", removal)
    return store.totals()
