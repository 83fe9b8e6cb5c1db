"""End-to-end: extracts on disk -> build_marts -> compare with brute force."""

import math

import pandas as pd
import pytest

from brute_force import expected
from extract_fixture import EDITIONS, make_extracts
from edumart.plans import marts as M
from edumart.schemas import QUESTIONS, display_names


@pytest.fixture(scope="module")
def extracts_dir():
    import tempfile
    root = tempfile.mkdtemp(prefix="edumart-extracts-")
    make_extracts(root)
    return root


@pytest.fixture(scope="module")
def built(spark, extracts_dir):
    import tempfile
    lake = tempfile.mkdtemp(prefix="edumart-lake-")
    ex = M.read_extracts(spark, extracts_dir, EDITIONS)
    paths = M.build_marts(spark, ex, lake, "2024-02-16")
    return ex, lake, paths


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b)) or pd.isna(b)
    if b is None or pd.isna(b):
        return False
    if isinstance(a, float) or isinstance(b, float):
        return abs(float(a) - float(b)) <= 1e-9 * max(1.0, abs(float(b)))
    return a == b


def _compare(spark_df, exp: pd.DataFrame, key: str, cols):
    got = {r[key]: r for r in spark_df.collect()}
    exp = exp.set_index(key)
    assert sorted(got) == sorted(int(k) for k in exp.index)
    bad = []
    for k, row in exp.iterrows():
        g = got[int(k)]
        for c in cols:
            if not _close(g[c], row[c]):
                bad.append((k, c, g[c], row[c]))
    assert not bad, bad[:10]


def test_course_mart_matches_brute_force(spark, built, extracts_dir):
    _, lake, _ = built
    gold = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16")
    names = display_names()
    for ed in EDITIONS:
        exp_course, _ = expected(extracts_dir, ed)
        exp_course = exp_course.rename(columns=names)
        cols = [c for c in exp_course.columns if c != "CO_CURSO"]
        _compare(gold.filter(f"edition = {ed}"), exp_course, "CO_CURSO", cols)


def test_institution_mart_matches_brute_force(spark, built, extracts_dir):
    _, lake, _ = built
    gold = M.all_editions_mart(spark, lake, "institution_mart", "2024-02-16")
    names = display_names()
    for ed in EDITIONS:
        _, exp_inst = expected(extracts_dir, ed)
        exp_inst = exp_inst.rename(columns=names)
        cols = [c for c in exp_inst.columns if c != "CO_IES" and not c.endswith("_reg")]
        _compare(gold.filter(f"edition = {ed}"), exp_inst, "CO_IES", cols)


def test_mart_shapes(spark, built):
    _, lake, _ = built
    cm = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16")
    im = M.all_editions_mart(spark, lake, "institution_mart", "2024-02-16")
    # edition + key + 3 scores + 34 registry + 99 counts + 3 age stats
    assert len(cm.columns) == 1 + 140
    # edition + key + 3 scores + 99 counts + 3 age stats + 15 registry
    assert len(im.columns) == 1 + 121
    assert cm.columns[0] == "edition" and "NU_ANO_CENSO_x" in cm.columns
    assert "Nenhum [QE_I12]" in cm.columns and "Nenhum [QE_I13]" in im.columns
    assert cm.groupBy("edition", "CO_CURSO").count().filter("count > 1").count() == 0


def test_unregistered_course_kept_without_registry(spark, built):
    _, lake, _ = built
    cm = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16")
    rows = cm.filter("CO_CURSO = 99").select("edition", "CO_IES", "NO_IES").collect()
    assert len(rows) == len(EDITIONS) and all(r.CO_IES is None for r in rows)


def test_keep_first_registry_and_latin1(spark, built):
    ex, _, _ = built
    reg = M.course_registry(ex).filter("edition = 2019 and CO_CURSO in (100, 102)")
    got = {r.CO_CURSO: r.NO_MUNICIPIO for r in reg.collect()}
    assert got == {100: "São Paulo", 102: "São Paulo"}
    ireg = M.institution_registry(ex).filter("CO_IES = 1").select("edition", "NO_IES").collect()
    assert sorted(r.NO_IES for r in ireg) == ["Instituição 1", "Instituição 1"]


def test_violations_report_unknown_and_blank_codes(spark, built):
    _, lake, paths = built
    v = spark.read.parquet(paths["violations"]).collect()
    found = {(r.question, r.code) for r in v}
    assert ("colour_race", "Z") in found and ("housing", " ") in found


def test_unreadable_values_stop_the_build(spark, tmp_dir):
    src = f"{tmp_dir}/bad"
    make_extracts(src, n_students=60)
    path = f"{src}/microdados2021_arq3.csv"
    with open(path, encoding="latin-1") as f:
        lines = f.read().splitlines()
    lines[1] = ";".join([*lines[1].split(";")[:2], "1,5", "2.0", "3.0"])
    with open(path, "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")
    ex = M.read_extracts(spark, src, EDITIONS)
    with pytest.raises(ValueError, match="1 values"):
        M.build_marts(spark, ex, f"{tmp_dir}/bad-lake", "2024-02-16", csv_copy=False)
    from edumart.sources import read_layer
    bad = read_layer(spark, f"{tmp_dir}/bad-lake", "gold", "rejects", "2024-02-16").collect()
    assert [(r.relation, r.edition, r["column"], r.n) for r in bad] == [("scores", 2021, "NT_GER", 1)]


def test_raw_not_answered_codes_are_reported_and_counted(spark, extracts_dir):
    from pyspark.sql import functions as F
    ex = M.read_extracts(spark, extracts_dir, EDITIONS)
    item = ex.answers["marital_status"]
    raw = item.withColumn("QE_I01", F.when(F.col("QE_I01") == "A", "N").otherwise(F.col("QE_I01")))
    n = item.filter("QE_I01 = 'A' and CO_CURSO is not null and NU_ANO is not null").count()
    ex.answers = {**ex.answers, "marital_status": raw}
    counts = M.answer_counts(ex)
    v = M.violations(spark, counts).filter(F.col("code") == M.RAW_MISSING).agg(F.sum("n")).first()[0]
    assert v == n > 0
    filled = counts.filter("question = 1 and code = 'N'").agg(F.sum("n")).first()[0]
    folded = M.folded(counts).filter("question = 1 and code = 'N'").agg(F.sum("n")).first()[0]
    assert folded == filled + n


def test_repeated_registry_keys_are_reported(spark, built):
    _, lake, paths = built
    rows = spark.read.parquet(paths["repeated_keys"]).collect()
    assert rows and all(r.n > 1 for r in rows) and {r.registry for r in rows} <= {"course", "institution"}


def test_mart_files_keep_the_score_order(spark, built):
    _, lake, paths = built
    rows = spark.read.parquet(paths["course_mart"] + "/date=2024-02-16").select(
        "edition", "NT_GER", "CO_CURSO", "_metadata.file_name", "_metadata.row_index").collect()
    for ed in EDITIONS:
        mine = sorted((r.file_name, r.row_index, -r.NT_GER, r.CO_CURSO) for r in rows if r.edition == ed)
        assert len(mine) > 10 and [x[2:] for x in mine] == sorted(x[2:] for x in mine)


def test_csv_copy_and_union(spark, built):
    _, lake, paths = built
    u = M.union_csv_marts(spark, f"{lake}/gold/csv", "course_mart", "2024-02-16")
    gold = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16")
    assert u.columns[0] == "edition"
    assert u.count() == gold.count()
    assert "SEPARADO JUDICIALMENTE/DIVORCIADO" in u.columns
    assert set(gold.columns) - {"date"} <= set(u.columns)


def test_long_form_counts_single_exchange(spark, built):
    import re
    ex, _, _ = built
    plan = M.answer_counts(ex)._jdf.queryExecution().executedPlan().toString()
    # 14 items x 2 editions stacked, one shuffle for all of them
    assert len(re.findall(r"FileScan csv", plan)) == 28
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1



def test_cli_build(spark, extracts_dir, capsys):
    import json
    import tempfile
    from edumart.__main__ import main
    lake = tempfile.mkdtemp(prefix="edumart-cli-")
    main(["build", "--extracts", extracts_dir, "--editions", "2019", "--lake", lake,
          "--run-date", "2024-03-01", "--no-csv"])
    printed = capsys.readouterr().out
    out = json.loads(printed[printed.index("{"):])
    assert "course_mart" in out and "institution_mart" in out
    cm = M.all_editions_mart(spark, lake, "course_mart", "2024-03-01")
    assert sorted(r.edition for r in cm.select("edition").distinct().collect()) == [2019]
    assert cm.count() > 0


def test_hot_stage_in_codegen(spark, built):
    ex, _, _ = built
    df = M.answer_counts(ex)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the partial aggregate right above the scans runs inside whole-stage codegen
    assert any("*(" in line and "HashAggregate" in line and "partial_count" in line
               for line in plan.splitlines())


def test_invariant_codes_sum_to_counted_rows(spark, built):
    ex, lake, _ = built
    from edumart.sources import read_layer
    counts = read_layer(spark, lake, "silver", "answer_counts", "2024-02-16")
    got = {(r.edition, r.question): r.n for r in
           counts.groupBy("edition", "question").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    for i, q in enumerate(QUESTIONS):
        raw = ex.answers[q.name].filter("CO_CURSO is not null and NU_ANO is not null")
        for r in raw.groupBy("edition").count().collect():
            assert got[(r.edition, i)] == r["count"], (q.name, r.edition)


def test_invariant_courses_roll_up_to_institutions(spark, built):
    _, lake, _ = built
    from pyspark.sql import functions as F
    from edumart.sources import read_layer
    counts = read_layer(spark, lake, "silver", "answer_counts", "2024-02-16")
    reg = read_layer(spark, lake, "silver", "registry", "2024-02-16").select("edition", "CO_CURSO", "CO_IES")
    j = counts.join(reg, ["edition", "CO_CURSO"], "left")
    total = counts.agg(F.sum("n")).first()[0]
    registered = j.filter("CO_IES is not null").agg(F.sum("n")).first()[0]
    unregistered = j.filter("CO_IES is null").agg(F.sum("n")).first()[0]
    assert total == registered + unregistered and unregistered > 0
    im = M.all_editions_mart(spark, lake, "institution_mart", "2024-02-16")
    cells = [names for names in display_names().values()]
    inst_total = im.select(sum(F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in cells).alias("t")) \
        .agg(F.sum("t")).first()[0]
    # institution cells hold every registered in-domain count
    in_domain = j.filter("CO_IES is not null").join(
        spark.createDataFrame([(i, c) for i, q in enumerate(QUESTIONS) for c in q.codes],
                              "question tinyint, code string"),
        ["question", "code"]).agg(F.sum("n")).first()[0]
    assert inst_total == in_domain
    assert im.groupBy("edition", "CO_IES").count().filter("count > 1").count() == 0


def test_landed_extracts_give_the_same_marts(spark, extracts_dir):
    import tempfile
    lake = tempfile.mkdtemp(prefix="edumart-landed-")
    paths = M.land_extracts(spark, extracts_dir, EDITIONS, lake, "2024-02-16")
    assert len(paths) == 5 + len(QUESTIONS) and paths["absent"] == []
    direct = M.read_extracts(spark, extracts_dir, EDITIONS)
    landed = M.read_landed_extracts(spark, lake, "2024-02-16")
    a, b = M.course_mart(direct), M.course_mart(landed)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ia, ib = M.institution_mart(direct), M.institution_mart(landed)
    assert ia.exceptAll(ib).count() == 0 and ib.exceptAll(ia).count() == 0
    one = M.read_landed_extracts(spark, lake, "2024-02-16", editions=[2021]).scores
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021" in plan


def test_land_reports_absent_files(spark, tmp_dir):
    import os
    from extract_fixture import make_extracts
    src = f"{tmp_dir}/x"
    make_extracts(src, n_students=60)
    os.remove(f"{src}/microdados2021_arq8.csv")                  # one item, one edition
    lake = f"{tmp_dir}/lake"
    out = M.land_extracts(spark, src, EDITIONS, lake, "2024-02-16")
    assert out["absent"] == ["microdados2021_arq8.csv"]
    landed = spark.read.parquet(out["answers_colour_race"])
    assert sorted(r.edition for r in landed.select("edition").distinct().collect()) == [2019]
    other = spark.read.parquet(out["answers_marital_status"])
    assert sorted(r.edition for r in other.select("edition").distinct().collect()) == [2019, 2021]


def test_rebuild_same_day_replaces(spark, built):
    ex, lake, _ = built
    before = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16").count()
    M.build_marts(spark, ex, lake, "2024-02-16", csv_copy=False)
    cm = M.all_editions_mart(spark, lake, "course_mart", "2024-02-16")
    assert cm.count() == before
    assert cm.groupBy("edition", "CO_CURSO").count().filter("count > 1").count() == 0
