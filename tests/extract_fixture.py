"""Deterministic survey extracts for tests: two editions of every file the
marts read, written as ``;``-separated Latin-1 text with a header, with the
edge cases of FIXTURES.md mixed in."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd

from edumart.schemas import AGES_FILE_NO, COURSE_REGISTRY, INSTITUTION_REGISTRY, QUESTIONS, SCORES_FILE_NO

EDITIONS = (2019, 2021)


def _write(df: pd.DataFrame, path: str) -> None:
    df.to_csv(path, sep=";", index=False, encoding="latin-1", na_rep="")


def make_extracts(root: str, n_students: int = 600, seed: int = 7) -> dict:
    rng = np.random.default_rng(seed)
    os.makedirs(root, exist_ok=True)
    truth = {}
    for ed in EDITIONS:
        courses = np.arange(100, 140) + (0 if ed == 2019 else 5)
        insts = np.arange(1, 8)
        course_inst = {int(c): int(insts[i % len(insts)]) for i, c in enumerate(courses)}
        # students: course 99 has scores but no registry row (E7); a few rows
        # have a missing course (dropped, P8)
        stud_course = rng.choice(np.append(courses, 99), size=n_students).astype("float")
        stud_course[rng.random(n_students) < 0.02] = np.nan
        nu_ano = np.full(n_students, float(ed))
        nu_ano[rng.random(n_students) < 0.05] = np.nan           # K5
        co = pd.array(stud_course, dtype="Int64")
        # scores: 1 decimal, ~10% missing, one course with no score at all (K2)
        def score():
            s = np.round(rng.uniform(0, 100, n_students), 1)
            s[rng.random(n_students) < 0.1] = np.nan
            s[stud_course == courses[3]] = np.nan
            return s
        _write(pd.DataFrame({"NU_ANO": nu_ano, "CO_CURSO": co, "NT_GER": score(), "NT_FG": score(),
                             "NT_CE": score()}), f"{root}/microdados{ed}_arq{SCORES_FILE_NO}.csv")
        age = rng.integers(18, 60, n_students).astype("float")
        age[rng.random(n_students) < 0.05] = np.nan
        _write(pd.DataFrame({"NU_ANO": nu_ano, "CO_CURSO": co, "NU_IDADE": pd.array(age, dtype="Int64")}),
               f"{root}/microdados{ed}_arq{AGES_FILE_NO}.csv")
        for q in QUESTIONS:
            domain = [c for c in q.codes if c != "N"]
            ans = rng.choice(np.array(domain + [None], dtype=object), size=n_students)
            # each question file has its own population: drop ~5% of rows (K4)
            keep = rng.random(n_students) > 0.05
            if q.name == "colour_race":
                ans[0] = "Z"                                      # unknown code (E14)
            if q.name == "housing":
                ans[1] = " "                                      # blank is not missing (K8)
            df = pd.DataFrame({"NU_ANO": nu_ano, "CO_CURSO": co, q.column: ans})[keep]
            _write(df, f"{root}/microdados{ed}_arq{q.file_no}.csv")
        # course registry with a repeated course (E20: first row wins) and a
        # course whose institution is absent from the institution registry
        rows = []
        for c in courses:
            rows.append({"CO_CURSO": int(c), "CO_IES": course_inst[int(c)], "NO_MUNICIPIO": "São Paulo"})
        rows.insert(5, {"CO_CURSO": int(courses[2]), "CO_IES": course_inst[int(courses[2])],
                        "NO_MUNICIPIO": "Late Duplicate"})
        rows.append({"CO_CURSO": int(courses[0]), "CO_IES": 1, "NO_MUNICIPIO": "Second Copy"})
        rows[-2]["CO_IES"] = 77
        reg = pd.DataFrame(rows)
        full = pd.DataFrame({name: ([ed] * len(reg) if name == "NU_ANO_CENSO" else
                                    (reg[name] if name in reg else
                                     ([f"{name.lower()}_{i}" for i in range(len(reg))] if t == "string"
                                      else list(range(len(reg))))))
                             for name, t in COURSE_REGISTRY})
        full.insert(3, "EXTRA_COLUMN", "x")                       # unread column
        _write(full, f"{root}/MICRODADOS_CADASTRO_CURSOS_{ed}.CSV")
        ireg = pd.DataFrame({name: ([ed] * len(insts) if name == "NU_ANO_CENSO" else
                                    (list(insts) if name == "CO_IES" else
                                     ([f"Instituição {i}" for i in insts] if t == "string"
                                      else list(range(len(insts))))))
                             for name, t in INSTITUTION_REGISTRY})
        ireg = pd.concat([ireg, ireg.iloc[[0]].assign(NO_IES="Duplicate IES")], ignore_index=True)
        # column order differs between editions (read by name)
        if ed == 2021:
            ireg = ireg[list(reversed(ireg.columns))]
        _write(ireg, f"{root}/MICRODADOS_CADASTRO_IES_{ed}.CSV")
        truth[ed] = {"courses": courses, "insts": insts}
    return truth
