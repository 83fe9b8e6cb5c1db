"""Quality rules whose thresholds come from mergeable quantile sketches per
language and source instead of fixed cut-offs.

Sketch: a log-linear histogram. A non-negative integer keeps its leading
``SUB_BITS`` binary digits (relative error below 2**-(SUB_BITS-1)), so a sketch
is a count per (lang, source, rule, bucket). Counts add: partial aggregates
merge in any order with the same result, and languages or the whole corpus are
the sums of their sources' sketches. A group smaller than ``min_docs`` takes
the threshold of its language, a small language that of the corpus.

Each rule has a value per document (an integer, per 10,000 words) and a percent
``p`` of the documents that set its threshold; a document fails above the
group's fence ``qp + fence * max(qp - q50, step)``, ``q`` being sketch
quantiles. No constant is a cut-off: where most documents tie (no symbols at
all) the spread is ``step``, one occurrence in the group's median document, its
length being a sketch quantile too. The percents say what a rule is for: up to
a tenth of a group may be full of symbols, a twentieth of overlong words; repeats
and doubled lines also stand in good prose, so only their last hundredth tells.

Scale: DataFrame functions only. One pass builds the sketch (its exchange holds
buckets, not documents: map-side combining, so a hot source is no hot key), a
second pass evaluates the rules next to the joined thresholds. The threshold
table has one row per (lang, source); Spark broadcasts it when its measured
size allows and otherwise joins by key with skew splitting.

Defined results: a null text has no words; null lang or source is a group of
its own (null-safe join); repeated rows are judged alike; an empty table gives
an empty result; extra columns pass through ``filter_quality`` whatever their
names, since all internal names are made fresh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edumart.llm.common import SPACE, fresh, materialize, space_words, table

WINDOW_WORDS = 8
SUB_BITS = 6
FENCE = 3
MIN_DOCS = 100
#: rule -> (percent of the documents that set the threshold, size of one occurrence:
#: a repeat takes two windows of words)
RULES = {"symbols": (90, 1), "dup_lines": (99, 1), "repeats": (99, 2 * WINDOW_WORDS), "long_words": (95, 1)}


def measures(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with a struct column ``into``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (all long).

    The steps are plain columns, each read several times by the next one: Spark
    then evaluates each once per row instead of inside the lambdas.
    """
    w, ln, h, d, p = fresh(df, *[f"{into}_{k}" for k in ("words", "lines", "hashes", "twice", "places")])
    n, t = WINDOW_WORDS, F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({w: space_words(F.col(text)), ln: F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))})
    # one hash per window; position i starts a window of the words i .. i + 7
    # (slice() would copy the whole array for each window)
    df = df.withColumn(h, F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(0), F.size(w) - n),
        lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>")))
    # windows seen twice: sorted by hash, equal neighbours; texts without any skip the sort
    df = df.withColumn(d, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(
        h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).otherwise(
            F.array().cast("array<struct<h:bigint,p:int>>")))
    df = df.withColumn(p, F.sort_array(F.transform(F.filter(F.col(d), lambda x, i: (
        F.get(F.col(d), i - 1)["h"].eqNullSafe(x["h"])) | (F.get(F.col(d), i + 1)["h"].eqNullSafe(x["h"]))),
        lambda x: x["p"])))
    # words covered by those windows: each adds its own 8, less the overlap with the next
    covered = F.aggregate(F.transform(F.col(p), lambda x, i: F.least(
        F.lit(n), F.coalesce(F.get(F.col(p), i + 1) - x, F.lit(n)))), F.lit(0).cast("long"), lambda s, x: s + x)
    # The condition always holds; being non-deterministic it keeps later filters above this
    # projection. Pushed below, they would evaluate whole arrays inside the lambdas.
    return df.withColumn(into, F.when(F.monotonically_increasing_id() >= 0, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words")))).drop(w, ln, h, d, p)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (F.lit(100) * m["n_repeat_words"] > F.lit(30) * m["n_words"])


def rule_values(m: Column) -> dict[str, Column]:
    """Integer value per rule, per 10,000 words (0 for texts without words)."""
    per = lambda c: F.coalesce(F.floor(c * 10000 / F.nullif(m["n_words"], F.lit(0))), F.lit(0)).cast("long")
    return {"symbols": per(m["n_symbols"]), "dup_lines": per(m["n_dup_lines"]),
            "repeats": per(m["n_repeat_words"]), "long_words": per(m["word_chars"])}


def bucket(v: Column) -> Column:
    """Lower edge of the sketch bucket of a non-negative long."""
    shift = F.greatest(F.length(F.bin(v)) - SUB_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return v - F.pmod(v, step)


def sketch(df: DataFrame, lang: str, source: str, m: str) -> DataFrame:
    """Counts (lang, source, rule, edge, n) over the documents that pass the base rules."""
    values = rule_values(F.col(m)) | {"words": F.col(m)["n_words"]}
    long = df.filter(~base_failed(F.col(m))).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bucket(v).alias("edge"))
                            for r, v in values.items()])).alias("x"))
    return long.groupBy("lang", "source", "x.rule", "x.edge").agg(F.count(F.lit(1)).alias("n"))


def merged(sk: DataFrame, keys: list[str]) -> DataFrame:
    return sk.groupBy(*keys, "rule", "edge").agg(F.sum("n").alias("n"))


def fences(sk: DataFrame, keys: list[str], fence: int, rules: dict[str, tuple[int, int]]) -> DataFrame:
    """(keys, docs, rule, fence) from a sketch: the window runs over the buckets of one sketch."""
    w = Window.partitionBy(*keys, "rule")
    upto = w.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    q = sk.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(w).alias("docs"))
    at = lambda r, p: F.min(F.when((F.col("rule") == r) & (F.col("upto") * 100 >= F.col("docs") * p), F.col("edge")))
    quantiles = q.groupBy(*keys).agg(
        F.max("docs").alias("docs"), at("words", 50).alias("words"),
        *[at(r, p).alias(f"high_{r}") for r, (p, _) in rules.items()], *[at(r, 50).alias(f"mid_{r}") for r in rules])
    edge = lambda r, size: F.col(f"high_{r}") + fence * F.greatest(
        F.col(f"high_{r}") - F.col(f"mid_{r}"), F.floor(F.lit(10000 * size) / F.col("words")))
    return quantiles.select(*keys, "docs", F.inline(F.array(*[
        F.struct(F.lit(r).alias("rule"), edge(r, size).alias("fence")) for r, (_, size) in rules.items()])))


def thresholds(sk: DataFrame, fence: int = FENCE, min_docs: int = MIN_DOCS,
               rules: dict[str, tuple[int, int]] = RULES) -> DataFrame:
    """One row per (lang, source) with a fence per rule (columns ``fence_<rule>``),
    backed off to the language and the corpus for small groups."""
    by_lang = merged(sk, ["lang"])
    own = fences(sk, ["lang", "source"], fence, rules)
    lang = fences(by_lang, ["lang"], fence, rules).select(
        F.col("lang").alias("l"), F.col("rule").alias("lr"), F.col("docs").alias("ld"), F.col("fence").alias("lf"))
    # every rule has a row of the corpus-wide sketch: at most len(RULES) rows
    corpus = fences(merged(by_lang, []), [], fence, rules).select(
        F.col("rule").alias("cr"), F.col("fence").alias("cf"))
    pick = F.when(F.col("docs") >= min_docs, F.col("fence")).when(F.col("ld") >= min_docs, F.col("lf")).otherwise(F.col("cf"))
    all_ = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("lr"))) \
        .join(corpus, F.col("rule") == F.col("cr")).select("lang", "source", "rule", pick.alias("fence"))
    return all_.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("fence"))).alias(f"fence_{r}") for r in rules])


def judge(measured: DataFrame, m: str, th: DataFrame, lang: str = "lang", source: str = "source") -> tuple[DataFrame, str]:
    """``measured`` (with the measures struct ``m``) plus a verdict struct:
    base_failed, kept, failed (names of the rules failed); and its name."""
    v, kl, ks, *fence_names = fresh(measured, "q_verdict", "q_lang", "q_source", *[f"fence_{r}" for r in RULES])
    th = th.select(F.col("lang").alias(kl), F.col("source").alias(ks),
                   *[F.col(f"fence_{r}").alias(n) for r, n in zip(RULES, fence_names)])
    failed = F.array_compact(F.array(*[
        F.when(value > F.col(n), F.lit(r)) for (r, value), n in zip(rule_values(F.col(m)).items(), fence_names)]))
    joined = measured.join(th, F.col(lang).eqNullSafe(F.col(kl)) & F.col(source).eqNullSafe(F.col(ks)), "left")
    out = joined.withColumn(v, F.struct(
        base_failed(F.col(m)).alias("base_failed"),
        (~base_failed(F.col(m)) & (F.size(failed) == 0)).alias("kept"), F.array_join(failed, ",").alias("failed")))
    return out.drop(kl, ks, *fence_names), v


def filter_quality(docs: DataFrame, fence: int = FENCE, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents that the rules keep, with their own columns. Reads the
    texts twice (sketch, then verdict) rather than shuffling them."""
    m = fresh(docs, "q_measures")[0]
    slim = measures(docs.select("text", "lang", "source"), "text", m)
    # written first: its size is then known when the texts' join is planned
    th = materialize(thresholds(sketch(slim, "lang", "source", m), fence, min_docs), "quality-thresholds")
    out, v = judge(measures(docs, "text", m), m, th)
    return out.filter(F.col(v)["kept"]).select(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = materialize(measures(docs, "text", "m").drop("text"), "quality")
    out, v = judge(measured, "m", thresholds(sketch(measured, "lang", "source", "m")))
    return out.select("doc_id", "m.*", f"{v}.base_failed", f"{v}.kept", f"{v}.failed")
