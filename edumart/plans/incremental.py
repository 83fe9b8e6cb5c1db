"""Incremental marts (C3 over A1, A2, A3): a changed delivery replaces only its
own share.

Every delivered file is reduced once to its *partial state*: mergeable facts per
(edition, course) that add up over files,

    kind "score"   item, n, total       exact decimal sum and count of a score column
    kind "answer"  item, code, n        counted answers of an item
    kind "age"     level, n             how often a value occurs

and the states lie in a snapshot table with one part per file. A delivery is
compared with the manifest first: a file whose length and modification time are
known is not opened, one whose bytes have a known checksum is not parsed. The
states of changed files are computed in one job, committed in one manifest, and only
the editions they touch get new mart parts; all other parts stay the same
folders. Readers see the marts of before or after, never a mixture (see
``sources.snapshots``).

Scale: the text of a file is parsed once in its life. States have a row per
(course, code) or (course, level) and file, made by partial aggregates, so a
course with a third of all rows is no larger than others. A mart part is
computed from the states of its editions only. States and marts are written with
tasks sized by the rows read (``session.sized``): what a task joins, aggregates
and sorts for its files stays the same when the input grows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.functions.scalar import round_half_even
from edumart.operators import answers_long, count_long, dedupe_first, histogram_stats, join_suffixed, union_editions
from edumart.operators.columns import drop_null_keys
from edumart.operators.dedupe import ORDINAL
from edumart.plans.marts import (
    ExtractLayout, course_mart_from, expected_files, institution_mart_from, labelled, raw_code, read_relation)
from edumart.schemas import (
    AGE_COL, AGE_STATS, COUNTED, COURSE, COURSE_REGISTRY, EDITION, INSTITUTION, INSTITUTION_REGISTRY, QUESTIONS, SCORE_COLS,
    Question)
from edumart.session import sized
from edumart.sources import (
    REJECTED, Part, Snapshot, commit, file_digests, file_stamps, read_snapshot, resolve, write_runs)

#: bytes of an extract's text that count as a row when the tasks of its parse are sized
ROW_BYTES = 32
STATE = "kind string, item string, code string, level double, n long, total decimal(38,18)"
FILE = "_file"


# ---------------------------------------------------------------- states

def score_state(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Sum and count per score column; a key without any value keeps its rows (n = 0)."""
    sums = drop_null_keys(df, keys).groupBy(*keys).agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.sum(F.col(c).cast("decimal(38,18)")).alias(f"t_{i}") for i, c in enumerate(cols)])
    facts = F.array(*[F.struct(F.lit(c).alias("item"), F.col(f"n_{i}").alias("n"), F.col(f"t_{i}").alias("total"))
                      for i, c in enumerate(cols)])
    return _state(sums.select(*keys, F.explode(facts).alias("f")).select(*keys, "f.*"), keys, "score")


def answer_state(counts: DataFrame, keys: Sequence[str], item: str = "question", code: str = "code", n: str = "n") -> DataFrame:
    """Long answer counts (``operators.count_long``) as state."""
    return _state(counts.select(*keys, F.col(item).cast("string").alias("item"), F.col(code).alias("code"), F.col(n).alias("n")),
                  keys, "answer")


def level_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Histogram of a column with few distinct values per key; missing values count too."""
    hist = drop_null_keys(df, keys).groupBy(*keys, F.col(value).cast("double").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return _state(hist, keys, "age")


def _state(df: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    columns = dict(c.split() for c in STATE.split(", ")[1:])
    return df.select(*keys, F.lit(kind).alias("kind"),
                     *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


# ---------------------------------------------------------------- merging

def merged_scores(states: DataFrame, keys: Sequence[str], cols: Sequence[str], zero_fill: bool = True, places: int = 2) -> DataFrame:
    """Rounded exact means per key, as ``operators.mean_scores`` gives from raw rows."""
    s, out = states.filter("kind = 'score'"), []
    for c in cols:
        n = F.sum(F.when(F.col("item") == c, F.col("n")))
        total = F.sum(F.when(F.col("item") == c, F.col("total")))
        mean = round_half_even(F.when(n > 0, total.cast("double") / n), places)
        out.append((F.coalesce(mean, F.lit(0.0)) if zero_fill else mean).alias(c))
    return s.groupBy(*keys).agg(*out)


def merged_counts(states: DataFrame, keys: Sequence[str], item_type: str = "tinyint") -> DataFrame:
    """(keys, question, code, n) as ``operators.count_long`` gives from raw rows."""
    return states.filter("kind = 'answer'").groupBy(*keys, F.col("item").cast(item_type).alias("question"), "code") \
        .agg(F.sum("n").alias("n"))


def merged_levels(states: DataFrame, keys: Sequence[str], names: tuple[str, str, str], round_places: int | None = None) -> DataFrame:
    """Mean, median and deviation as ``operators.value_stats`` gives from raw rows."""
    hist = states.filter("kind = 'age'").groupBy(*keys, "level").agg(F.sum("n").alias("n"))
    return histogram_stats(hist, keys, "level", "n", names, round_places)


# ---------------------------------------------------------------- deliveries

@dataclass
class Delivery:
    """What a delivery changes against a snapshot of the states."""

    changed: dict[str, Mapping] = field(default_factory=dict)       # file -> facts to keep with its part
    same: dict[str, Mapping] = field(default_factory=dict)          # touched on disk, same bytes
    gone: list[str] = field(default_factory=list)


def compare(spark: SparkSession, root: str, files: Sequence[str], base: Snapshot, known: Sequence[str]) -> Delivery:
    """Which of ``files`` (names below ``root``) differ from the manifest's
    parts; ``known`` are the manifest's keys the delivery speaks for."""
    wanted, out = set(files), Delivery()
    stamps = {r.file_name: r for r in file_stamps(spark, root).filter(F.col("file_name").isin(sorted(wanted))).collect()}
    fresh = {}
    for name, r in stamps.items():
        old = base.parts[name].info if name in base.parts else {}
        if (old.get("length"), old.get("modified")) != (r.length, r.modified):
            fresh[name] = r
    digests = file_digests(spark, [r.path for r in fresh.values()])
    for name, r in fresh.items():
        info = {"length": r.length, "modified": r.modified, "sha256": digests[r.path]}
        old = base.parts[name].info if name in base.parts else {}
        (out.same if old.get("sha256") == info["sha256"] else out.changed)[name] = info
    out.gone = sorted(set(known) - stamps.keys())
    return out


def land(spark: SparkSession, rows: DataFrame | None, table: str, base: Snapshot, delivery: Delivery) -> Snapshot:
    """Commit ``rows`` (with column ``FILE``) as the parts of the changed files;
    each replaces exactly its own file's earlier part."""
    parts = {k: Part(base.parts[k].folder, base.parts[k].schema, info) for k, info in delivery.same.items()}
    if delivery.changed:
        parts |= write_runs(rows, table, F.col(FILE), sorted(delivery.changed), delivery.changed)
    return commit(spark, table, base, parts, drop=delivery.gone)


def inputs(snapshot: Snapshot, files: Sequence[str]) -> str:
    """Checksum of the named files' checksums: what a result built from them depends on."""
    seen = [(f, snapshot.parts[f].info.get("sha256")) for f in sorted(files) if f in snapshot.parts]
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()


# ---------------------------------------------------------------- survey extracts

@dataclass
class Refresh:
    """What a refresh did: files parsed, files gone, editions whose marts were rebuilt."""

    changed: list[str]
    gone: list[str]
    editions: list[int]


def extract_states(spark: SparkSession, root: str, files: Mapping[str, tuple[str, int]], layout: ExtractLayout = ExtractLayout(),
                   questions: Sequence[Question] = QUESTIONS) -> DataFrame | None:
    """Partial states of the given files (name -> relation, edition) with column
    ``FILE``: one aggregate per kind over all of them."""
    def rows(relations: Sequence[str]) -> list[tuple[str, DataFrame]]:
        return [(rel, read_relation(spark, root, rel, [ed], layout, questions).withColumn(FILE, F.lit(f)))
                for f, (rel, ed) in sorted(files.items()) if rel in relations]

    keys, out = [EDITION, COURSE, FILE], []
    if scores := rows(["scores"]):
        out.append(score_state(union_editions([df for _, df in scores]), keys, SCORE_COLS))
    if ages := rows(["ages"]):
        out.append(level_state(union_editions([df for _, df in ages]), keys, AGE_COL))
    items = {f"answers_{q.name}": (i, q) for i, q in enumerate(questions)}
    if answers := rows(list(items)):
        long = union_editions([answers_long(df, keys, raw_code(items[rel][1]), items[rel][0], counted=COUNTED) for rel, df in answers])
        out.append(answer_state(count_long(long, keys), keys))
    return union_editions(out) if out else None


def registry_rows(spark: SparkSession, root: str, files: Mapping[str, tuple[str, int]], layout: ExtractLayout = ExtractLayout(),
                  questions: Sequence[Question] = QUESTIONS) -> DataFrame | None:
    """Typed rows of the given registry files with their file order."""
    frames = [read_relation(spark, root, rel, [ed], layout, questions).drop(REJECTED)
              .withColumns({"relation": F.lit(rel), FILE: F.lit(f)}) for f, (rel, ed) in sorted(files.items())]
    return union_editions(frames) if frames else None


def marts_from_states(states: DataFrame, registries: DataFrame, questions: Sequence[Question] = QUESTIONS) -> dict[str, DataFrame]:
    """Both marts from partial states and registry rows, as ``build_marts`` makes them from raw rows."""
    keys = [EDITION, COURSE]

    def registry(relation: str, columns, key: str) -> DataFrame:
        rows = registries.filter(F.col("relation") == relation).select(EDITION, *[c for c, _ in columns], ORDINAL)
        return dedupe_first(rows, [EDITION, key])

    institutions = registry("institution_registry", INSTITUTION_REGISTRY, INSTITUTION)
    courses = join_suffixed(registry("course_registry", COURSE_REGISTRY, COURSE), institutions, [EDITION, INSTITUTION], how="inner")
    scores, counts = merged_scores(states, keys, SCORE_COLS), merged_counts(states, keys)
    ages = merged_levels(states, keys, AGE_STATS)
    return {"course_mart": course_mart_from(scores, courses, counts, ages, questions),
            "institution_mart": institution_mart_from(scores, courses, counts, ages, institutions, questions)}


def refresh_marts(spark: SparkSession, root: str, editions: Sequence[int], lake: str,
                  layout: ExtractLayout = ExtractLayout(), questions: Sequence[Question] = QUESTIONS) -> Refresh:
    """Bring both marts up to the files under ``root``: parse what changed in the
    given editions, merge, and rebuild the parts of the editions touched.

    State tables ``<lake>/silver/states`` (facts) and ``<lake>/silver/registries``,
    mart tables ``<lake>/gold/course_mart_parts`` and ``.../institution_mart_parts``,
    read with ``read_snapshot``. A mart part keeps a checksum of the files it was
    built from, so a refresh that died between the two is made good by the next
    one. A file that is gone takes its state with it. Of two refreshes at once
    the later commit is refused (``RunConflict``); it can simply be run again.
    """
    silver, gold = f"{lake.rstrip('/')}/silver", f"{lake.rstrip('/')}/gold"
    of = {r.file_name: (r.relation, r.edition) for r in expected_files(spark, editions, layout, questions).collect()}
    changed, gone, now = [], [], {}
    for name, make, is_registry in (("states", extract_states, False), ("registries", registry_rows, True)):
        table = f"{silver}/{name}"
        files = [f for f, (rel, _) in of.items() if rel.endswith("_registry") == is_registry]
        now[name] = base = resolve(spark, table)
        d = compare(spark, root, files, base, [f for f in files if f in base.parts])
        if d.changed or d.same or d.gone:
            rows = make(spark, root, {f: of[f] for f in d.changed}, layout, questions)
            with sized(spark, sum(i["length"] for i in d.changed.values()) // ROW_BYTES):
                now[name] = land(spark, rows, table, base, d)
        changed += sorted(d.changed)
        gone += d.gone

    def facts(edition: int) -> dict:
        files = [f for f, (_, ed) in of.items() if ed == edition]
        return {name: inputs(s, files) for name, s in now.items()}

    tables = {n: f"{gold}/{n}_parts" for n in ("course_mart", "institution_mart")}
    bases = {n: resolve(spark, t) for n, t in tables.items()}
    stale = {n: [e for e in editions if str(e) not in b.parts or dict(b.parts[str(e)].info) != facts(e)] for n, b in bases.items()}
    for n, todo in stale.items():
        if todo:
            files = {name: [f for f, (_, ed) in of.items() if ed in todo and f in s.parts] for name, s in now.items()}
            if not all(files.values()):
                raise ValueError(f"editions {todo}: no facts or no registries under {root}")
            rows = [read_snapshot(spark, f"{silver}/{name}", now[name], files[name]) for name in ("states", "registries")]
            mart = labelled(marts_from_states(*rows, questions)[n], questions)
            with sized(spark, sum(r.count() for r in rows)):
                parts = write_runs(mart, tables[n], F.col(EDITION).cast("string"), [str(e) for e in todo], {str(e): facts(e) for e in todo})
            commit(spark, tables[n], bases[n], parts)
    return Refresh(changed, gone, sorted({e for todo in stale.values() for e in todo}))
