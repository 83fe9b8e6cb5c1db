"""Language identification by Bayesian evidence fusion.

For every language ``l`` of the inventory

    log P(l | row) ~ TEMPER * log P(text | l) + log P(declared | l) + log P(l | host)

* text: byte trigrams of the lower-cased text, hashed to ``BUCKETS`` cells;
  counts per declared language over all rows, mixed with the pooled counts of
  all languages in the proportion POOL, give the likelihoods. Where another
  language explains a row better than the pool does, the row's own counts do not
  count for its declared language: a slip of the pen cannot prove itself, a
  language with a single row can. TEMPER allows for neighbouring trigrams not being independent. A uniform
  background language "und" competes, so text like no language loses.
* declared: P(declared language | l), from counts of (declared, best language by
  text alone) over all rows; a declaration seen in no row with text says nothing;
* host: P(l | host) from counts of (host, best by text), smoothed towards the
  address suffix, which is smoothed towards the whole table:
  (n(host, l) + K P(l | suffix)) / (n(host) + K).

A row is rejected (``kept`` false) if its text has no trigram or the best
posterior is below ``MIN_POSTERIOR`` or belongs to "und".

Scale: three reads of the texts (train, evidence counts, verdict), no text is
shuffled; texts travel to Python in batches of bounded bytes (``bound_batches``). Every count table is a grouped aggregate with map-side combining, so
a host with a third of all rows is one row of it; rows join the host table by
key with skew splitting, or by broadcast when its measured size allows. The
likelihood table holds the cells that occur, per language of the inventory:
every two- or three-letter code that is declared, however few rows have it.

Defined results: a null or empty text has no evidence and is rejected; a null
or malformed declared language and a null address are values of their own;
repeated rows get equal results; with no usable declaration at all the
inventory is empty and every row is rejected; an empty table gives an empty
result; extra columns pass through whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.llm.common import fresh, materialize, table
from edumart.session import bound_batches

BUCKETS = 1 << 14
TEMPER = 0.2
SMOOTH = 0.5
POOL = 0.1                      # share of the pooled counts in a language's likelihood
HOST_K, SUFFIX_K = 20.0, 50.0
MIN_POSTERIOR = 0.5
UND_PRIOR = 0.01
SENT_LANGS = 256               # the table of declarations is broadcast up to so many languages (half a MB)
HELD_LANGS = 256               # languages whose counts a task holds at a time
CHUNK = 1 << 20                # bytes of a text looked at a time


def primary_subtag(declared: Column) -> Column:
    """'en-GB' -> 'en'; anything else than a language tag: null."""
    code = F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(code != "", code)


def host_of(address: Column) -> Column:
    """Host of a URL, or the address itself where it is none; without 'www.'."""
    host = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.regexp_replace(F.lower(F.when(host != "", host).otherwise(address)), r"^www\.", "")


def suffix_of(host: Column) -> Column:
    """Last label of a host with dots; '' for names without."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise(F.lit(""))


def page_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags become blanks."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


def declared_in(html: Column) -> Column:
    return F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)


_BLANK = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of a whole text, chunk by chunk; trigrams that
    start with a blank and hold no letter are left out."""
    data = (text or "").lower().encode().translate(_BLANK)
    for lo in range(0, max(len(data) - 2, 0), CHUNK):
        b = np.frombuffer(data[lo:lo + CHUNK + 2], np.uint8).astype(np.uint32)
        h = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
        yield (h ^ (h >> np.uint32(15)))[(b[:-2] != 32) | (b[1:-1] != 32)] % np.uint32(BUCKETS)


class TextModel:
    """Trigram counts of the languages, as sorted cells of those that occur."""

    def __init__(self, langs: list[str], bucket: np.ndarray, lang: np.ndarray, n: np.ndarray):
        order = np.lexsort((lang, bucket))
        self.langs, self.place = langs, {g: k for k, g in enumerate(langs)}
        self.lang, self.n = lang[order].astype(np.int32), n[order].astype(float)
        self.first = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        pooled = np.bincount(bucket, n, BUCKETS) + SMOOTH
        self.pool = pooled / pooled.sum()
        self.total = np.bincount(lang, n, len(langs))
        at = np.repeat(np.arange(BUCKETS), np.diff(self.first))
        self.more = self.above(self.n, self.total[self.lang], self.pool[at])

    @staticmethod
    def above(n, total, pool) -> np.ndarray:
        """Log of (1 - POOL) n / total + POOL pool, above that of POOL pool."""
        return np.log1p((1 - POOL) * n / np.maximum(total, 1) / (POOL * pool))

    def score(self, counts: np.ndarray, declared: str | None) -> np.ndarray:
        """Log-likelihood per language and und of a row with ``counts`` per bucket."""
        ids = np.flatnonzero(counts)
        c, size = counts[ids].astype(float), float(counts.sum())
        width = self.first[ids + 1] - self.first[ids]
        ends = np.cumsum(width)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[ids] - ends + width, width)
        of, lang = np.repeat(c, width), self.lang[at]
        # relative to the pool
        ll = np.bincount(lang, of * self.more[at], len(self.langs)) + size * np.log(POOL)
        own = self.place.get(declared)
        if own is not None and np.delete(ll, own).max(initial=0.0) > 0:
            mine, rest = lang == own, self.total[own] - size
            left = self.above(self.n[at[mine]] - of[mine], rest, np.repeat(self.pool[ids], width)[mine])
            ll[own] = of[mine] @ left + size * np.log(POOL) if rest > 0 else 0.0
        return np.append(ll + c @ np.log(self.pool[ids]), -size * np.log(BUCKETS))


def counted(text: str | None) -> np.ndarray:
    c = np.zeros(BUCKETS, np.int64)
    for ids in trigrams(text):
        c += np.bincount(ids, minlength=BUCKETS)
    return c


def text_model(rows: DataFrame, text: str, lang: str) -> TextModel:
    """Counts of every declared language, from all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def emit():
            for g, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                                  pa.array(c[at])], names=["lang", "bucket", "n"])
            counts.clear()
        for b in batches:
            for t, g in zip(b.column(0), b.column(1).to_pylist()):
                if g is not None:
                    if g not in counts and len(counts) >= HELD_LANGS:
                        yield from emit()
                    c = counts.setdefault(g, np.zeros(BUCKETS, np.int64))
                    for ids in trigrams(t.as_py()):
                        c += np.bincount(ids, minlength=BUCKETS)
        yield from emit()

    cells = rows.select(text, lang).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = cells.toArrow()                                           # at most BUCKETS rows per language
    names = got.column("lang").combine_chunks().dictionary_encode() if got.num_rows else pa.array([], pa.string()).dictionary_encode()
    langs = sorted(names.dictionary.to_pylist())
    place = np.array([langs.index(g) for g in names.dictionary.to_pylist()], np.int64)
    return TextModel(langs, got.column("bucket").to_numpy().astype(np.int64), place[names.indices.to_numpy()] if langs else place,
                     got.column("n").to_numpy())


def likelihoods(df: DataFrame, text: str, declared: str, into: str, model: TextModel) -> DataFrame:
    """``df`` with an array column: log-likelihood per language and und, then the number of trigrams."""
    width = len(model.langs) + 2

    @F.arrow_udf("array<double>")
    def udf(texts: pa.Array, said: pa.Array) -> pa.Array:
        out = np.empty((len(texts), width))
        for row, t, d in zip(out, texts, said):
            c = counted(t.as_py())
            row[:-1] = model.score(c, d.as_py())
            row[-1] = c.sum()
        return pa.ListArray.from_arrays(pa.array(np.arange(0, width * len(texts) + 1, width, dtype=np.int32)), pa.array(out.ravel()))
    return df.withColumn(into, udf(F.col(text), F.col(declared)))


def constant(values) -> Column:
    """An array or map as one literal that Spark folds, whatever its length."""
    kind = "map<string,int>" if isinstance(values, dict) else "array<string>" if values and isinstance(values[0], str) else "array<double>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def argmax(scores: Column, names: list[str]) -> Column:
    """Name of the largest score; of equal ones the first."""
    return F.get(constant(names), F.array_position(scores, F.array_max(scores)).cast("int") - 1)


def _dense(best: str, n: str, size: int) -> Column:
    """Aggregate: counts by place 0 .. size - 1 as an array (a place occurs once per group)."""
    at = F.map_from_entries(F.collect_list(F.struct(best, n)))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0)).cast("double"))


def evidence(slim: DataFrame, langs: list[str]) -> tuple[DataFrame, DataFrame]:
    """From rows (declared, host, ll): tables (said, d_prior: log P(declared | l)
    per language l) and (h_host, h_prior: log prior per language).

    One aggregate over the rows, in long form (declared, host, best, n), serves
    both; its plan does not grow with the languages. ``said`` is the declared
    language's place in the inventory, null for any other value."""
    k = len(langs)
    own = F.slice("ll", 1, k)
    rows = slim.filter(F.get("ll", F.lit(k + 1)) > 0).select(
        place_of(langs).alias("said"), "host", (F.array_position(own, F.array_max(own)) - 1).cast("int").alias("best"))
    cells = materialize(rows.groupBy("said", "host", "best").agg(F.count(F.lit(1)).alias("n")), "language-evidence")
    # one count per language reaches the driver
    by = {r["best"]: r["n"] for r in cells.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    total = [by.get(i, 0) for i in range(k)]
    whole = [(n + SMOOTH) / (sum(total) + SMOOTH * k) for n in total]
    log = lambda values, weights: F.zip_with(values, weights, lambda x, y: F.log(x / y))
    said = cells.groupBy("said", "best").agg(F.sum("n").alias("n")).groupBy("said").agg(_dense("best", "n", k).alias("d")) \
        .select("said", log(F.transform("d", lambda x: x + SMOOTH), constant([n + SMOOTH * (k + 1) for n in total])).alias("d_prior"))
    hosts = cells.groupBy("host", "best").agg(F.sum("n").alias("n")).withColumn("suffix", suffix_of(F.col("host")))
    suffixes = hosts.groupBy("suffix", "best").agg(F.sum("n").alias("n")).groupBy("suffix").agg(
        _dense("best", "n", k).alias("d"), F.sum("n").alias("sn")).select(F.col("suffix").alias("s"), F.zip_with(
            "d", constant([SUFFIX_K * w for w in whole]), lambda x, y: x + y).alias("d"), (F.col("sn") + SUFFIX_K).alias("sn"))
    table_ = hosts.groupBy("host", "suffix").agg(_dense("best", "n", k).alias("h"), F.sum("n").alias("hn")) \
        .join(suffixes, F.col("suffix").eqNullSafe(F.col("s"))).select(F.col("host").alias("h_host"), F.zip_with(
            "h", "d", lambda x, y: F.log((x + HOST_K * y / F.col("sn")) / (F.col("hn") + HOST_K))).alias("h_prior"))
    return materialize(said, "language-said"), materialize(table_, "language-hosts")


def place_of(langs: list[str]) -> Column:
    return F.try_element_at(constant({g: i for i, g in enumerate(langs)}), F.col("declared"))


def fuse(slim: DataFrame, langs: list[str], said: DataFrame, hosts: DataFrame, into: str) -> DataFrame:
    """``slim`` (declared, host, ll and any other columns) plus the struct
    ``into``: language, posterior, kept."""
    k = len(langs)
    s, m, at = fresh(slim, "fuse_scores", "fuse_max", "fuse_said")
    if k <= SENT_LANGS:                                     # at most SENT_LANGS + 1 rows of as many numbers
        said = F.broadcast(said)
    joined = slim.withColumn(at, place_of(langs)).join(said, F.col(at).eqNullSafe(F.col("said")), "left") \
        .join(hosts, F.col("host").eqNullSafe(F.col("h_host")), "left")
    # a host none of whose rows had text takes the prior of no evidence: uniform; likewise a declaration
    none = F.transform(F.slice("ll", 1, k), lambda _: F.lit(-float(np.log(k))))
    scores = F.concat(F.zip_with(F.zip_with(F.slice("ll", 1, k), F.coalesce("h_prior", none), lambda a, b: a * TEMPER + b),
                                 F.coalesce("d_prior", none), lambda a, b: a + b),
                      F.array(F.get("ll", F.lit(k)) * TEMPER + float(np.log(UND_PRIOR))))
    out = joined.withColumn(s, scores).withColumn(m, F.array_max(s))
    norm = F.aggregate(F.transform(s, lambda x: F.exp(x - F.col(m))), F.lit(0.0), lambda a, x: a + x)
    language, posterior = argmax(F.col(s), [*langs, "und"]), F.lit(1.0) / norm
    some = F.get("ll", F.lit(k + 1)) > 0
    return out.withColumn(into, F.struct(
        F.when(some, language).otherwise("und").alias("language"), F.when(some, posterior).otherwise(0.0).alias("posterior"),
        (some & (posterior >= MIN_POSTERIOR) & (language != "und")).alias("kept"))).drop(s, m, at, "said", "d_prior", "h_host", "h_prior")


def identify(df: DataFrame, text: Column, declared: Column, address: Column, into: str) -> DataFrame:
    """``df`` plus the struct column ``into`` (language, posterior, kept)."""
    bound_batches(df.sparkSession)
    t, d, h, ll = fresh(df, "lid_text", "lid_declared", "lid_host", "lid_ll")
    own = df.columns
    rows = df.withColumns({t: text, d: primary_subtag(declared), h: host_of(address)})
    model = text_model(rows.select(F.col(t).alias("text"), F.col(d).alias("lang")), "text", "lang")
    langs = model.langs
    if not langs:
        return df.withColumn(into, F.struct(F.lit("und").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept")))
    rows = likelihoods(rows, t, d, ll, model)
    said, hosts = evidence(rows.select(F.col(d).alias("declared"), F.col(h).alias("host"), F.col(ll).alias("ll")), langs)
    # user columns travel in a struct, out of the way of the names used here
    boxed = rows.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row_"), F.col(d).alias("declared"),
                        F.col(h).alias("host"), F.col(ll).alias("ll"))
    return fuse(boxed, langs, said, hosts, "verdict_").select("row_.*", F.col("verdict_").alias(into))


def filter_language(docs: DataFrame) -> DataFrame:
    """Documents whose language is identified, with their own columns; ``lang``
    becomes the language found."""
    v = fresh(docs, "lid_verdict")[0]
    out = identify(docs, F.col("text"), F.col("lang"), F.col("source"), v).filter(F.col(v)["kept"])
    return out.withColumn("lang", F.col(v)["language"]).select(*docs.columns)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (declared: lang, address: source) and pages (declared: the
    markup's lang, address: url) as one table of evidence."""
    none = F.lit(None).cast("long")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", none.alias("page_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("address"))
    pages = table(spark, sf_dir, "pages").select(
        none.alias("doc_id"), "page_id", page_text(F.col("html")).alias("text"),
        declared_in(F.col("html")).alias("declared"), F.col("url").alias("address"))
    rows = docs.unionByName(pages)
    return identify(rows, F.col("text"), F.col("declared"), F.col("address"), "v").select(
        "doc_id", "page_id", "declared", "v.language", "v.posterior", "v.kept")
