"""Mixing sources to target weights: iterative proportional fitting.

Token counts are aggregated to cells (source, lang, topic). Cell weights start
at the cells' tokens and are raked in turn to the target shares of the three
marginals; one draw per document from a hash of its id makes the sample
repeatable on any cluster. Two scales of the probabilities:

* ``sample_mix`` (the pipeline's stage) keeps ``share`` of the tokens. A cell's
  expected tokens are at most its tokens: targets above what their values hold
  are lowered to that and the others raised, raking keeps full cells full and
  moves the rest, and the common factor gives the budget exactly. A thin cell is
  then kept whole and takes its few tokens from the others.
* ``rates`` (``op8_source_mixing``) gives every cell its raked share of the same
  budget, exactly: a rate is the expected copies of a cell's documents. Rates over 1
  are repeats: the whole part as copies, the rest as one draw. A thin cell is
  repeated, and what the others get does not hang on it.

Targets: a share per value may be given; otherwise a value's share is its
tokens to the power ``temperature`` over the sum (1 keeps the natural mix, 0
levels it). Values missing from given targets have share 0 and are not kept.

Scale: DataFrame functions only. Documents are read once for the cells (map-side
combining) and once to sample; raking works on the cell table, whose size is
the number of value combinations, by window sums per marginal value (one
exchange each, plan linear in the sweeps). The documents join the cells on
their three values; a small cell table is broadcast by measured size.

Defined results: null source, lang or topic is a value of its own; a null text
is one token (the end); a null id draws from its text; equal ids draw alike; an
empty table gives an empty result; extra columns pass through ``sample_mix``
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edumart.llm.common import fresh, materialize, space_words, table

SWEEPS = 8
SWEEPS_PER_PLAN = 4
SEED = 11
#: share of the tokens that ``sample_mix`` keeps
SHARE = 0.5
#: marginal -> temperature of its target shares
TEMPERATURE = {"source": 0.7, "lang": 0.6, "topic": 0.8}


def n_tokens(text: Column) -> Column:
    """Words of a text plus its end."""
    return (F.size(space_words(text)) + 1).cast("long")


def topic(text: Column) -> Column:
    """Kind of text by its form: tables, shouting, symbol noise, else by length."""
    t = F.coalesce(text, F.lit(""))
    n = F.char_length(t)
    return (F.when(t.contains(" | "), "table").when(t.contains("!! "), "shout").when(t.contains("%%% "), "noise")
            .when(n < 600, "short").when(n < 3000, "medium").otherwise("long"))


def cells(df: DataFrame, dims: list[str], tokens: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.sum(tokens).alias("tokens"))


def targets(cell: DataFrame, dim: str, temperature: float) -> DataFrame:
    """(value, share) of one marginal from its token totals."""
    per = cell.groupBy(F.col(dim).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temperature)).alias("x"))
    return per.select("value", (F.col("x") / per.agg(F.sum("x")).scalar()).alias("share"))


def factor(parts: DataFrame, part: str, cap: str, whole: float) -> float:
    """The ``k`` at which ``least(cap, k * part)`` adds up to ``whole`` (or to all
    that the caps allow). The sum is concave in ``k``, so Newton's steps from
    below only add full parts and end when none is added."""
    k = 0.0
    while True:
        full = F.col(part) * k >= F.col(cap)
        r = parts.agg(F.sum(F.when(full, F.col(cap)).otherwise(0.0)).alias("full"),
                      F.sum(F.when(full, 0.0).otherwise(F.col(part))).alias("free")).first()
        up = (whole - r["full"]) / r["free"] if r["free"] else k
        if up <= k * (1 + 1e-12):
            return k
        k = up


def reachable(cell: DataFrame, dim: str, share: DataFrame) -> DataFrame:
    """(value, share) with no share above the caps of its value's cells; the
    others share what that leaves in their own proportions."""
    per = cell.groupBy(F.col(dim).alias("v_")).agg(F.sum("cap").alias("cap"))
    both = materialize(per.join(share, F.col("v_").eqNullSafe(F.col("value")), "left")
                       .select(F.col("v_").alias("value"), "cap", F.coalesce("share", F.lit(0.0)).alias("x")), "mix-targets")
    return both.select("value", F.least("cap", F.col("x") * factor(both, "x", "cap", 1.0)).alias("share"))


def rake(cell: DataFrame, dims: list[str], shares: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cell`` plus ``weight``: shares over all cells whose marginals approach
    the target shares. With a column ``cap``, ``least(weight, cap)`` does: the
    weights remain products of a factor per value, and a value's factor is set
    so that its full cells stay full and the others make up the rest."""
    capped = "cap" in cell.columns
    whole = F.lit(cell.agg(F.sum("tokens").cast("double")).first()[0]) if capped else F.lit(1.0)
    out = cell.withColumn("weight", F.col("tokens").cast("double") / whole)
    for d in dims:
        s = shares[d].select(F.col("value").alias("v_"), F.col("share").alias(f"share_{d}"))
        out = out.join(s, F.col(d).eqNullSafe(F.col("v_")), "left").drop("v_").fillna(0.0, [f"share_{d}"])
    out = materialize(out, "mix-cells")
    for k in range(sweeps):
        for d in dims:
            if capped:
                out = bounded(out, d)
                continue
            total = F.sum("weight").over(Window.partitionBy(d))
            out = out.withColumn("weight", F.coalesce(F.col("weight") * F.col(f"share_{d}") / F.nullif(total, F.lit(0.0)), F.lit(0.0)))
        if (k + 1) % SWEEPS_PER_PLAN == 0 or k + 1 == sweeps:
            out = materialize(out, "mix-raked")
    return out


def bounded(out: DataFrame, d: str) -> DataFrame:
    """One step of bounded raking for the marginal ``d``."""
    w, share, full = Window.partitionBy(d), F.col(f"share_{d}"), F.col("weight") >= F.col("cap")
    out = out.withColumns({"full_": F.sum(F.when(full, F.col("cap")).otherwise(0.0)).over(w),
                           "free_": F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).over(w)})
    k = F.when(share <= 0, 0.0).when((share > F.col("full_")) & (F.col("free_") > 0), (share - F.col("full_")) / F.col("free_")) \
        .when(share < F.col("full_"), share / (F.col("full_") + F.col("free_"))).otherwise(1.0)
    return out.withColumn("weight", F.col("weight") * k).drop("full_", "free_")


def shares_of(cell: DataFrame, dims: list[str], temperature: dict[str, float], given: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    return {d: (given or {}).get(d, targets(cell, d, temperature[d])) for d in dims}


def budgeted(cell: DataFrame, dims: list[str], share: float = SHARE, temperature: dict[str, float] = TEMPERATURE,
             given: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """(dims, tokens, weight, probability) per cell: expected tokens are
    ``share`` of all tokens."""
    cell = materialize(cell, "mix-counts")
    total = cell.agg(F.sum("tokens")).first()[0]
    if not total:
        return cell.select(*dims, "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("probability"))
    cell = cell.withColumn("cap", F.col("tokens") / F.lit(share * total))
    shares = {d: reachable(cell, d, s) for d, s in shares_of(cell, dims, temperature, given).items()}
    raked = rake(cell, dims, shares, sweeps)
    weight = F.least("cap", F.col("weight") * factor(raked, "weight", "cap", 1.0))
    return raked.select(*dims, "tokens", weight.alias("weight"), F.round(weight / F.col("cap"), 9).alias("probability"))


def rates(cell: DataFrame, dims: list[str], share: float = SHARE, temperature: dict[str, float] = TEMPERATURE,
          given: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """(dims, tokens, weight, rate) per cell: expected copies of its documents when
    the sample has ``share`` of all tokens in the raked mix."""
    cell = materialize(cell, "mix-counts")
    raked = rake(cell, dims, shares_of(cell, dims, temperature, given), sweeps)
    budget = F.lit(share) * cell.agg(F.sum("tokens").cast("double")).scalar()
    return raked.select(*dims, "tokens", "weight", F.round(F.col("weight") * budget / F.col("tokens"), 9).alias("rate"))


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Uniform number in [0, 1) from a document's id (its text if the id is null)."""
    key = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def sample_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               lang: str = "lang", seed: int = SEED, **how) -> DataFrame:
    """The sampled documents, with their own columns."""
    p, on = _with_rate(docs, doc_id, text, source, lang, budgeted, "probability", **how)
    return p.filter(draw(F.col(doc_id), F.col(text), seed) < F.col(on)).select(*docs.columns)


def repeat_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               lang: str = "lang", seed: int = SEED, **how) -> DataFrame:
    """The documents, each as often as its rate and its draw say, with their own columns."""
    p, on = _with_rate(docs, doc_id, text, source, lang, rates, "rate", **how)
    times, = fresh(p, "mix_times")
    n = copies(F.col(on), F.col(doc_id), F.col(text), seed)
    return p.withColumn(times, F.explode(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))))).select(*docs.columns)


def copies(rate: Column, doc_id: Column, text: Column, seed: int = SEED) -> Column:
    return (F.floor(rate) + (draw(doc_id, text, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def _with_rate(docs, doc_id, text, source, lang, measure, name, **how) -> tuple[DataFrame, str]:
    top, tok, rate, *keys = fresh(docs, "mix_topic", "mix_tokens", "mix_rate", "mix_source", "mix_lang", "mix_kind")
    valued = docs.withColumns({top: topic(F.col(text)), tok: n_tokens(F.col(text))})
    slim = valued.select(F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(top).alias("topic"), F.col(tok).alias("n"))
    dims = ["source", "lang", "topic"]
    per = materialize(measure(cells(slim, dims, "n"), dims, **how), "mix-rates") \
        .select(*[F.col(d).alias(k) for d, k in zip(dims, keys)], F.col(name).alias(rate))
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip((source, lang, top), keys)])
    return valued.join(per, match).drop(*keys), rate


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    p, rate = _with_rate(docs, "doc_id", "text", "source", "lang", rates, "rate")
    n = copies(F.col(rate), F.col("doc_id"), F.col("text"))
    return p.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
                    F.col(rate).alias("rate"), n.alias("copies"), (n > 0).alias("kept"))


def oracle(docs: str = "documents", sweeps: int = SWEEPS, seed: int = SEED) -> str:
    """DuckDB SQL of ``op8_source_mixing`` over the relation ``docs``, as CTEs and a final select."""
    ctes = [f"""d AS (SELECT doc_id, text, source, lang,
  CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, '!! ') THEN 'shout' WHEN contains(t, '%%% ') THEN 'noise'
       WHEN length(t) < 600 THEN 'short' WHEN length(t) < 3000 THEN 'medium' ELSE 'long' END AS topic,
  (len(list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '')) + 1)::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM {docs}))""",
            "r0 AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE AS w FROM d GROUP BY ALL)"]
    for dim, a in TEMPERATURE.items():
        ctes.append(f"s_{dim} AS (SELECT {dim} AS v, pow(sum(tokens)::DOUBLE, {a}) / sum(pow(sum(tokens)::DOUBLE, {a})) OVER () AS share FROM r0 GROUP BY {dim})")
    last, k = "r0", 0
    for _ in range(sweeps):
        for dim in TEMPERATURE:
            k += 1
            ctes.append(f"r{k} AS MATERIALIZED (SELECT source, lang, topic, tokens, w * share / sum(w) OVER (PARTITION BY {dim}) AS w "
                        f"FROM {last} JOIN s_{dim} ON {dim} IS NOT DISTINCT FROM v)")
            last = f"r{k}"
    ctes.append(f"p AS (SELECT source, lang, topic, round(w * ({SHARE}::DOUBLE * sum(tokens) OVER ()::DOUBLE) / tokens, 9) AS rate FROM {last})")
    u = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '') || ':{seed}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    ctes.append(f"""c AS (SELECT doc_id, d.source, d.lang, d.topic, n_tokens, rate, floor(rate)::BIGINT + ({u} < rate - floor(rate))::BIGINT AS copies
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic)""")
    return "WITH " + ",\n".join(ctes) + "\nSELECT *, copies > 0 AS kept FROM c"
