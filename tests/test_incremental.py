"""Incremental marts: equal to a full build after every delivery, and only what
changed is opened."""

import os
import shutil

import pytest

from edumart.plans import marts as M
from edumart.plans.incremental import refresh_marts
from edumart.sources import RunConflict, commit, read_snapshot, resolve, write_run
from edumart.schemas import QUESTIONS
from extract_fixture import EDITIONS, make_extracts

ITEMS = QUESTIONS[:2]
FILES = {q.name: f"arq{q.file_no}.csv" for q in ITEMS}


def rows(df, drop=("date",)):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in cols) for r in df.collect()), key=str)


@pytest.fixture()
def landing(tmp_dir):
    make_extracts(f"{tmp_dir}/in", n_students=120)
    return f"{tmp_dir}/in"


def equals_full_build(spark, landing, lake, tmp_dir, n):
    full = f"{tmp_dir}/full{n}"
    M.build_marts(spark, M.read_extracts(spark, landing, EDITIONS, questions=ITEMS), full, "2024-02-16", ITEMS, csv_copy=False)
    for mart in ("course_mart", "institution_mart"):
        assert rows(read_snapshot(spark, f"{lake}/gold/{mart}_parts")) == rows(M.all_editions_mart(spark, full, mart, "2024-02-16"))


def test_refresh_equals_full_build_and_opens_only_what_changed(spark, landing, tmp_dir):
    lake = f"{tmp_dir}/lake"
    first = refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    assert len(first.changed) == (4 + len(ITEMS)) * len(EDITIONS) and first.editions == sorted(EDITIONS)
    again = refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    assert (again.changed, again.gone, again.editions) == ([], [], [])
    before = resolve(spark, f"{lake}/gold/course_mart_parts")

    # an answer file of 2021 changes; another file only gets a new time; a third one is spoilt without a trace
    # (same length and time): an unchanged file must not be opened
    changed, touched, spoilt = (f"{landing}/microdados2021_{n}" for n in (FILES[ITEMS[0].name], FILES[ITEMS[1].name], "arq6.csv"))
    with open(changed, encoding="latin-1") as f:
        lines = f.read().splitlines()
    with open(changed, "w", encoding="latin-1") as f:
        f.write("\n".join(lines[:1] + lines[5:] + lines[5:9]) + "\n")
    os.utime(touched, (1_000_000_000, 1_000_000_000))
    whole, at = open(spoilt, "rb").read(), os.stat(spoilt)
    with open(spoilt, "wb") as f:
        f.write(b"x" * len(whole))
    os.utime(spoilt, ns=(at.st_atime_ns, at.st_mtime_ns))
    second = refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    assert (second.changed, second.editions) == ([os.path.basename(changed)], [2021])
    with open(spoilt, "wb") as f:
        f.write(whole)
    os.utime(spoilt, ns=(at.st_atime_ns, at.st_mtime_ns))
    after = resolve(spark, f"{lake}/gold/course_mart_parts")
    assert before.parts["2019"] == after.parts["2019"] and before.parts["2021"] != after.parts["2021"]

    # a refresh that died after its states and before its marts is caught up by the next one
    registry = f"{landing}/MICRODADOS_CADASTRO_IES_2019.CSV"
    with open(registry, encoding="latin-1") as f:
        text = f.read()
    with open(registry, "w", encoding="latin-1") as f:
        f.write(text.replace("Instituição 3", "Outro nome"))
    shutil.copytree(f"{lake}/gold", f"{tmp_dir}/old_gold")
    refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    os.rename(f"{lake}/gold", f"{tmp_dir}/new_gold")
    shutil.copytree(f"{tmp_dir}/old_gold", f"{lake}/gold")
    third = refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    assert (third.changed, third.editions) == ([], [2019])
    equals_full_build(spark, landing, lake, tmp_dir, 2)


def test_a_file_that_is_gone_takes_its_share_along(spark, landing, tmp_dir):
    lake = f"{tmp_dir}/lake"
    refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    os.rename(f"{landing}/microdados2019_arq6.csv", f"{tmp_dir}/away.csv")
    got = refresh_marts(spark, landing, EDITIONS, lake, questions=ITEMS)
    assert (got.changed, got.gone, got.editions) == ([], ["microdados2019_arq6.csv"], [2019])
    mart = read_snapshot(spark, f"{lake}/gold/course_mart_parts")
    assert {(r.edition, r.MEDIA_IDADE is None) for r in mart.filter("CO_CURSO = 120").collect()} == {(2019, True), (2021, False)}


def test_two_refreshes_at_once(spark, tmp_dir):
    base = resolve(spark, f"{tmp_dir}/states")
    commit(spark, f"{tmp_dir}/states", base, write_run(spark.range(1), f"{tmp_dir}/states", "f"))
    with pytest.raises(RunConflict):
        commit(spark, f"{tmp_dir}/states", base, write_run(spark.range(2), f"{tmp_dir}/states", "f"))
