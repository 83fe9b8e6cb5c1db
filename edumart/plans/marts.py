"""Course and institution marts for all editions in one Spark job.

The original produced one mart pair per edition year in a serial chain of
single-process runs. Here the edition is a key column: every aggregate is
keyed by ``(edition, …)``, so all editions go through the same stages.

Plan shape, per relation:

* answers: 14 question files -> narrow long rows -> ONE hash aggregate over
  ``(edition, course, question, code)`` (partial on the map side) -> the
  per-course counts; institution counts are a rollup of those counts, not a
  second pass over the facts.
* scores: one hash aggregate with exact decimal sums per course; the
  institution score is the unweighted mean of the rounded course means.
* ages: histogram per ``(edition, course, age)`` then window statistics.
* registries: keep-first de-duplication (``min_by`` over the file ordinal),
  inner join course x institution on ``(edition, CO_IES)``.
* widening to 99 count columns and the registry enrichment happen last, on
  per-course / per-institution rows.

``build_marts`` writes the shared intermediates (registry, long counts,
course statistics) to the silver layer first: both marts read them back, so
the fact files are scanned once, lineage is cut, and a lost executor
recomputes from the written tables instead of from the raw extracts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.functions.scalar import qcol
from edumart.operators import (
    answers_long, avg_of_stats, chain_left, count_long, count_rejects, dedupe_first,
    duplicate_keys, join_suffixed, long_domain_violations, mean_of_means, mean_scores, move_first, rename,
    rollup, union_editions, value_stats, widen)
from edumart.schemas import (
    AGE_COL, AGE_STATS, AGES, AGES_FILE_NO, COUNTED, MISSING, COURSE, COURSE_REGISTRY, EDITION,
    INSTITUTION, INSTITUTION_REGISTRY, QUESTIONS, SCORE_COLS, SCORES, SCORES_FILE_NO,
    Question, all_cells, display_names, item_cells)
from edumart.sources import (
    COUNTS, LATIN1, REJECTED, land_counted, list_files, manifest_report, read_delimited, read_layer, route_expr, write_layer,
    write_mart)

#: a literal not-answered code in the text, kept apart from the filled one until the marts (K7)
RAW_MISSING = f"{MISSING} (raw)"


@dataclass(frozen=True)
class ExtractLayout:
    """Where the files of one edition live, relative to the landing root."""

    answers: str = "microdados{edition}_arq{n}.csv"
    course_registry: str = "MICRODADOS_CADASTRO_CURSOS_{edition}.CSV"
    institution_registry: str = "MICRODADOS_CADASTRO_IES_{edition}.CSV"
    sep: str = ";"
    encoding: str = LATIN1
    decimal_comma: bool = False
    registry_missing: str = "error"     # "null": absent registry columns read as NULL


@dataclass
class Extracts:
    """Lazily read inputs; every frame carries an ``edition`` column."""

    scores: DataFrame
    ages: DataFrame
    answers: Mapping[str, DataFrame]          # question name -> raw answer rows
    course_registry: DataFrame                # with the file-order ordinal
    institution_registry: DataFrame
    rejects: DataFrame | None = None          # (relation, edition, column, n), see ``count_rejects``


def read_relation(spark: SparkSession, root: str, name: str, editions: Sequence[int],
                  layout: ExtractLayout = ExtractLayout(),
                  questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """One extract relation (``scores``, ``ages``, ``answers_<item>``,
    ``course_registry``, ``institution_registry``) for the given editions,
    stacked by name. Rows carry the ``REJECTED`` array of their unreadable
    columns and of records of the wrong width."""
    return union_editions(list(relation_files(spark, root, name, editions, layout, questions).values()))


def relation_files(spark: SparkSession, root: str, name: str, editions: Sequence[int],
                   layout: ExtractLayout = ExtractLayout(),
                   questions: Sequence[Question] = QUESTIONS) -> dict[tuple[int, str], DataFrame]:
    """The frames of a relation by (edition, file name): one read per file, since
    columns are matched by header name and headers differ between editions."""
    root = root.rstrip("/")
    items = {f"answers_{q.name}": q for q in questions}
    if name == "scores":
        pattern, cols, ordinal, missing, n = layout.answers, SCORES, False, "error", SCORES_FILE_NO
    elif name == "ages":
        pattern, cols, ordinal, missing, n = layout.answers, AGES, False, "error", AGES_FILE_NO
    elif name in items:
        q = items[name]
        pattern, cols, ordinal, missing, n = layout.answers, q.schema(), False, "error", q.file_no
    elif name == "course_registry":
        pattern, cols, ordinal, missing, n = (layout.course_registry, COURSE_REGISTRY, True,
                                              layout.registry_missing, None)
    elif name == "institution_registry":
        pattern, cols, ordinal, missing, n = (layout.institution_registry, INSTITUTION_REGISTRY,
                                              True, layout.registry_missing, None)
    else:
        raise ValueError(f"unknown relation {name!r}")
    parts = {}
    for ed in editions:
        file = pattern.format(edition=ed, n=n)
        parts[ed, file] = read_delimited(
            spark, f"{root}/{file}", cols, sep=layout.sep, encoding=layout.encoding,
            decimal_comma=layout.decimal_comma, ordinal=ordinal,
            extra={EDITION: F.lit(int(ed))}, missing=missing, rejects=True)
    return parts


def read_extracts(spark: SparkSession, root: str, editions: Sequence[int],
                  layout: ExtractLayout = ExtractLayout(),
                  questions: Sequence[Question] = QUESTIONS) -> Extracts:
    """All relations of the given editions, read lazily from the text files."""
    return _extracts({n: read_relation(spark, root, n, editions, layout, questions)
                      for n in _relations_names(questions)}, questions)


def _extracts(frames: Mapping[str, DataFrame], questions: Sequence[Question]) -> Extracts:
    """Frames by relation name -> ``Extracts``. Rejects are counted from the
    ``REJECTED`` arrays: of landed tables a tiny column, of text files a second
    parse, so land large extracts first."""
    bad = [count_rejects(df.select(F.lit(n).alias("relation"), EDITION, REJECTED), REJECTED, ["relation", EDITION])
           for n, df in frames.items() if REJECTED in df.columns]
    clean = {n: df.drop(REJECTED) for n, df in frames.items()}
    return Extracts(
        scores=clean["scores"], ages=clean["ages"],
        answers={q.name: clean[f"answers_{q.name}"] for q in questions},
        course_registry=clean["course_registry"],
        institution_registry=clean["institution_registry"],
        rejects=union_editions(bad) if bad else None)


def expected_files(spark: SparkSession, editions: Sequence[int],
                   layout: ExtractLayout = ExtractLayout(),
                   questions: Sequence[Question] = QUESTIONS, edition_type: str = "int") -> DataFrame:
    """Manifest ``(relation, edition, file_name)`` of every extract file the
    layout expects (about 18 per edition)."""
    rows = []
    for ed in editions:
        rows.append(("scores", ed, layout.answers.format(edition=ed, n=SCORES_FILE_NO)))
        rows.append(("ages", ed, layout.answers.format(edition=ed, n=AGES_FILE_NO)))
        rows += [(f"answers_{q.name}", ed, layout.answers.format(edition=ed, n=q.file_no))
                 for q in questions]
        rows.append(("course_registry", ed, layout.course_registry.format(edition=ed)))
        rows.append(("institution_registry", ed, layout.institution_registry.format(edition=ed)))
    return spark.createDataFrame(rows, f"relation string, edition {edition_type}, file_name string")


def land_extracts(spark: SparkSession, root: str, editions: Sequence[int], lake_root: str,
                  run_date: str, layout: ExtractLayout = ExtractLayout(),
                  questions: Sequence[Question] = QUESTIONS) -> dict[str, str]:
    """Parse every extract relation once into Parquet under
    ``<lake>/silver/extracts/<relation>``, partitioned by ``date`` and
    ``edition`` (dynamic overwrite: landing one edition again replaces only
    that edition). Registries keep their file-order ordinal. Later builds
    read columnar, prunable tables instead of re-parsing Latin-1 text.

    What each file held (rows, records of the wrong width, unreadable ones) is
    counted by the same write into the silver table ``accounting`` (read with
    ``read_layer``; the paths returned are those of the relations).

    Files the layout expects but the folder lacks are reported (key
    ``"absent"``) and that relation is landed for the other editions only,
    like the original's file selection, which skipped absent files."""
    manifest = expected_files(spark, editions, layout, questions)
    absent = sorted((r.relation, r.edition, r.file_name)
                    for r in manifest_report(spark, manifest, root).collect())
    missing = {(rel, ed) for rel, ed, _ in absent}
    out: dict = {"absent": [f for _, _, f in absent]}
    accounts = []
    for name in _relations_names(questions):
        eds = [ed for ed in editions if (name, ed) not in missing]
        if not eds:
            continue
        files = relation_files(spark, root, name, eds, layout, questions)

        def write(df: DataFrame) -> None:
            out[name] = write_layer(df, lake_root, "silver", f"extracts/{name}", run_date, [EDITION],
                                    keep_other_partitions=True)

        for (ed, file), n in land_counted(files, write).items():
            accounts.append((name, ed, file, *(n[c] for c in COUNTS)))
    if accounts:
        schema = "relation string, edition int, file_name string, " + ", ".join(f"{c} long" for c in COUNTS)
        write_layer(spark.createDataFrame(accounts, schema), lake_root, "silver", "accounting", run_date,
                    [EDITION], keep_other_partitions=True)
    return out


def _relations_names(questions: Sequence[Question]) -> list[str]:
    return (["scores", "ages", "course_registry", "institution_registry"]
            + [f"answers_{q.name}" for q in questions])


def read_landed_extracts(spark: SparkSession, lake_root: str, run_date: str,
                         editions: Sequence[int] | None = None,
                         questions: Sequence[Question] = QUESTIONS) -> Extracts:
    """The landed extracts of one run date; ``editions`` prunes partitions."""
    def rel(name: str) -> DataFrame:
        df = read_layer(spark, lake_root, "silver", f"extracts/{name}", run_date)
        if editions is not None:
            df = df.filter(F.col(EDITION).isin([int(e) for e in editions]))
        return df.drop("date")

    return _extracts({n: rel(n) for n in _relations_names(questions)}, questions)


# ---------------------------------------------------------------- building blocks

def institution_registry(ex: Extracts) -> DataFrame:
    """First row per (edition, CO_IES) in file order."""
    return dedupe_first(ex.institution_registry, [EDITION, INSTITUTION])


def course_registry(ex: Extracts) -> DataFrame:
    """Course registry x institution registry (inner on (edition, CO_IES)),
    each de-duplicated keep-first; shared names get ``_x`` / ``_y``."""
    courses = dedupe_first(ex.course_registry, [EDITION, COURSE])
    return join_suffixed(courses, institution_registry(ex), [EDITION, INSTITUTION], how="inner")


def answer_counts(ex: Extracts, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """(edition, CO_CURSO, question, code, n) over all questions at once;
    ``question`` is the item's catalogue position (a narrow shuffle key). A
    not-answered code that stands in the text itself is counted as ``RAW_MISSING``,
    unless the raw codes of the item include it."""
    keys = [EDITION, COURSE]
    long = union_editions([answers_long(ex.answers[q.name], keys, raw_code(q), i, counted=COUNTED)
                           for i, q in enumerate(questions)])
    return count_long(long, keys)


def raw_code(q: Question):
    """The item's code as it stands in the text, a literal not-answered one marked."""
    raw = F.col(q.column)
    return F.when(raw == MISSING, F.lit(RAW_MISSING)).otherwise(raw)


def folded(counts: DataFrame) -> DataFrame:
    """Counts as the marts take them: a raw not-answered code is not answered."""
    return counts.withColumn("code", F.when(F.col("code") == RAW_MISSING, F.lit(MISSING)).otherwise(F.col("code")))


def repeated_registry_keys(ex: Extracts) -> DataFrame:
    """(edition, registry, key, n): registry keys of which only the first row is kept (V4)."""
    parts = [duplicate_keys(df, [EDITION, key]).select(EDITION, F.lit(name).alias("registry"), F.col(key).alias("key"), "n")
             for name, df, key in (("course", ex.course_registry, COURSE), ("institution", ex.institution_registry, INSTITUTION))]
    return union_editions(parts)


def course_scores(ex: Extracts) -> DataFrame:
    """Rounded course means; a course with no score at all reads 0 (K2)."""
    return mean_scores(ex.scores, [EDITION, COURSE], SCORE_COLS, zero_fill=True)


def course_ages(ex: Extracts) -> DataFrame:
    return value_stats(ex.ages, [EDITION, COURSE], AGE_COL, AGE_STATS)


def violations(spark: SparkSession, counts: DataFrame,
               questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """Answer codes outside each item's domain, per edition (V1), with the
    item named."""
    v = long_domain_violations(spark, counts, item_cells(questions), keys=[EDITION])
    names = F.array(*[F.lit(q.name) for q in questions])
    return v.select(EDITION, F.element_at(names, F.col("question").cast("int") + 1).alias("question"),
                    "code", "n")


# ---------------------------------------------------------------- marts

def course_mart_from(scores: DataFrame, registry: DataFrame, counts: DataFrame,
                     ages: DataFrame, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """One row per scored course: scores, registry, 99 counts, age stats."""
    keys = [EDITION, COURSE]
    wide = widen(folded(counts), keys, item_cells(questions))
    reg = registry.drop("_ordinal") if "_ordinal" in registry.columns else registry
    base = join_suffixed(scores, reg, keys, how="left")
    return chain_left(base, [wide, ages], keys)


def institution_mart_from(scores: DataFrame, registry: DataFrame, counts: DataFrame,
                          ages: DataFrame, inst_registry: DataFrame,
                          questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """One row per institution with at least one scored, registered course."""
    keys = [EDITION, INSTITUTION]
    mapping = registry.select(EDITION, COURSE, INSTITUTION)
    inst_scores = mean_of_means(scores, mapping, COURSE, INSTITUTION, SCORE_COLS, keys=[EDITION])
    inst_counts = widen(rollup(folded(counts), mapping, COURSE, INSTITUTION, keys=[EDITION]), keys,
                        item_cells(questions))
    inst_ages = avg_of_stats(ages, mapping, COURSE, INSTITUTION, AGE_STATS, keys=[EDITION])
    sex = [c for q in questions if q.name == "sex" for _, _, c in q.cells()]
    rest = [c for _, _, c in all_cells(questions) if c not in sex]
    mart = chain_left(inst_scores, [inst_counts, inst_ages], keys)
    mart = mart.select(*keys, *SCORE_COLS, *sex, *AGE_STATS, *rest)
    ireg = inst_registry.drop("_ordinal") if "_ordinal" in inst_registry.columns else inst_registry
    return join_suffixed(mart, ireg, keys, how="left")


def course_mart(ex: Extracts, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    return course_mart_from(course_scores(ex), course_registry(ex), answer_counts(ex, questions),
                            course_ages(ex), questions)


def institution_mart(ex: Extracts, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    return institution_mart_from(course_scores(ex), course_registry(ex),
                                 answer_counts(ex, questions), course_ages(ex),
                                 institution_registry(ex), questions)


def labelled(df: DataFrame, questions: Sequence[Question] = QUESTIONS) -> DataFrame:
    """Internal cell ids -> display labels (only at the sink)."""
    return rename(df, display_names(questions))


def sorted_for_sink(df: DataFrame, key: str) -> DataFrame:
    """Mart row order (O1): by edition, then mean general score descending,
    key as tie-break. A range-partitioned sort: each part file holds a
    contiguous slice, no single task sees the whole mart."""
    return df.orderBy(F.col(EDITION), F.col("NT_GER").desc_nulls_last(), F.col(key))


def build_marts(spark: SparkSession, ex: Extracts, lake_root: str, run_date: str,
                questions: Sequence[Question] = QUESTIONS, csv_copy: bool = True,
                max_rejects: int | None = 0) -> dict[str, str]:
    """Materialise intermediates (silver), both marts and the check tables
    ``rejects``, ``violations`` and ``repeated_keys`` (gold). More than
    ``max_rejects`` unreadable values stop the build once they are written down
    (None: report only); read as missing they would turn into zero scores and
    lost rows."""
    checks = {}
    if ex.rejects is not None:
        checks["rejects"] = write_layer(ex.rejects, lake_root, "gold", "rejects", run_date)
        n = read_layer(spark, lake_root, "gold", "rejects", run_date).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if max_rejects is not None and n > max_rejects:
            raise ValueError(f"{n} values do not have their column's type (tolerance {max_rejects}): see {checks['rejects']}")
    checks["repeated_keys"] = write_layer(repeated_registry_keys(ex), lake_root, "gold", "repeated_keys", run_date, [EDITION])
    silver = {
        "registry": write_layer(course_registry(ex), lake_root, "silver", "registry", run_date, [EDITION]),
        "institution_registry": write_layer(institution_registry(ex), lake_root, "silver",
                                            "institution_registry", run_date, [EDITION]),
        "answer_counts": write_layer(answer_counts(ex, questions), lake_root, "silver",
                                     "answer_counts", run_date, [EDITION]),
        "course_scores": write_layer(course_scores(ex), lake_root, "silver", "course_scores",
                                     run_date, [EDITION]),
        "course_ages": write_layer(course_ages(ex), lake_root, "silver", "course_ages",
                                   run_date, [EDITION]),
    }

    def s(name):
        return read_layer(spark, lake_root, "silver", name, run_date).drop("date")

    reg, ireg, counts = s("registry"), s("institution_registry"), s("answer_counts")
    scores, ages = s("course_scores"), s("course_ages")
    cm = course_mart_from(scores, reg, counts, ages, questions)
    im = institution_mart_from(scores, reg, counts, ages, ireg, questions)
    out = {**checks, **silver}
    out["course_mart"] = write_layer(labelled(sorted_for_sink(cm, COURSE), questions), lake_root, "gold",
                                     "course_mart", run_date, [EDITION])
    out["institution_mart"] = write_layer(labelled(sorted_for_sink(im, INSTITUTION), questions), lake_root,
                                          "gold", "institution_mart", run_date, [EDITION])
    out["violations"] = write_layer(violations(spark, counts, questions), lake_root, "gold",
                                    "violations", run_date, [EDITION])
    if csv_copy:
        for name, key in (("course_mart", COURSE), ("institution_mart", INSTITUTION)):
            mart = read_layer(spark, lake_root, "gold", name, run_date).drop("date")
            out[f"{name}_csv"] = write_mart(sorted_for_sink(mart, key),
                                            f"{lake_root}/gold/csv/date={run_date}/{name}",
                                            fmt="csv", partition_by=[EDITION])
    return out


def all_editions_mart(spark: SparkSession, lake_root: str, name: str, run_date: str) -> DataFrame:
    """All editions of one gold mart, edition first."""
    return move_first(read_layer(spark, lake_root, "gold", name, run_date).drop("date"), EDITION)


# Prefixes of mart folder names and the relation of each.
MART_ROUTES = (("institution_mart", "institution_mart"), ("course_mart", "course_mart"))


def mart_types(questions: Sequence[Question] = QUESTIONS) -> dict[str, str]:
    """Declared type of every mart column by its published name."""
    out = {EDITION: "int", COURSE: "bigint", INSTITUTION: "bigint"}
    for c, t in [*COURSE_REGISTRY, *INSTITUTION_REGISTRY]:
        out.update({c: t, f"{c}_x": t, f"{c}_y": t})
    out.update({c: "double" for c in (*SCORE_COLS, *AGE_STATS)})
    out.update({c: "bigint" for c in display_names(questions).values()})
    return out


def union_csv_marts(spark: SparkSession, directory: str, relation: str, run_date: str | None = None,
                    routes=MART_ROUTES, first: str = EDITION, types: Mapping[str, str] | None = None) -> DataFrame:
    """Union the CSV marts of one relation (U1 + S5) and run date:
    ``<directory>/date=<run date>/<mart folder>/...``, or ``<directory>/<mart
    folder>/...`` for marts kept without run dates (then ``run_date`` is None).

    Files are listed through Spark (metadata only) and routed by the prefix of
    their mart folder's name, with ``.csv`` files only (strays are ignored). Each folder
    is read on its own, since headers may differ between editions, and the
    folders are stacked by column name with gaps as NULL, typed by ``types``
    (default ``mart_types()``; other columns stay text); ``first`` moves to the
    front. Only the folder list (one entry per published mart) reaches the driver.
    """
    run = directory.rstrip("/") + (f"/date={run_date}" if run_date else "")
    root = spark._jvm.org.apache.hadoop.fs.Path(run)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    files = list_files(spark, run, glob="*.csv", recursive=True)
    mart = F.substring_index(F.substring("path", F.lit(len(root) + 2), F.length("path")), "/", 1)
    routed = files.withColumn("relation", route_expr(mart, routes, match="prefix"))
    folders = (routed.filter(F.col("relation") == relation)
               .select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")).distinct())
    paths = sorted(r.folder for r in folders.collect())
    if not paths:
        raise ValueError(f"no {relation} marts under {run}")
    reader = (spark.read.option("header", True).option("encoding", "UTF-8").option("enforceSchema", False).option("pathGlobFilter", "*.csv")
              .option("quote", '"').option("escape", '"').option("basePath", run))
    df = union_editions([reader.csv(p) for p in paths])
    types = mart_types() if types is None else types
    df = df.select(*[qcol(c).cast(types[c]).alias(c) if c in types else qcol(c) for c in df.columns])
    return move_first(df, first) if first in df.columns else df


__all__ = [
    "ExtractLayout", "Extracts", "read_extracts", "land_extracts", "read_landed_extracts",
    "expected_files", "read_relation", "repeated_registry_keys", "folded", "mart_types", "course_registry", "institution_registry",
    "answer_counts", "course_scores", "course_ages", "violations", "course_mart",
    "institution_mart", "course_mart_from", "institution_mart_from", "labelled",
    "build_marts", "all_editions_mart", "union_csv_marts",
]
