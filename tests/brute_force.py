"""Plain pandas model of the mart semantics, written independently of the
Spark code, used as the brute-force oracle on the small extract fixture."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd

from edumart.schemas import (AGE_STATS, AGES_FILE_NO, COURSE_REGISTRY, INSTITUTION_REGISTRY,
                             QUESTIONS, SCORE_COLS, SCORES_FILE_NO)


def _read(root, name):
    return pd.read_csv(f"{root}/{name}", sep=";", encoding="latin-1", low_memory=False)


def _mean_round(values) -> float:
    vals = [v for v in values if not pd.isna(v)]
    if not vals:
        return np.nan
    s = sum(Decimal(str(round(float(v), 4))) for v in vals)
    return float(np.rint(float(s) / len(vals) * 100) / 100)


def registry(root, ed):
    creg = _read(root, f"MICRODADOS_CADASTRO_CURSOS_{ed}.CSV")[[c for c, _ in COURSE_REGISTRY]]
    ireg = _read(root, f"MICRODADOS_CADASTRO_IES_{ed}.CSV")[[c for c, _ in INSTITUTION_REGISTRY]]
    creg = creg.drop_duplicates(subset="CO_CURSO")
    ireg = ireg.drop_duplicates(subset="CO_IES")
    return creg.merge(ireg, on="CO_IES"), ireg


def course_scores(root, ed):
    s = _read(root, f"microdados{ed}_arq{SCORES_FILE_NO}.csv").dropna(subset=["CO_CURSO"])
    out = s.groupby("CO_CURSO").agg({c: _mean_round for c in SCORE_COLS})
    return out.fillna(0.0)


def course_ages(root, ed):
    a = _read(root, f"microdados{ed}_arq{AGES_FILE_NO}.csv").dropna(subset=["CO_CURSO"])
    out = a.groupby("CO_CURSO")["NU_IDADE"].agg(["mean", "median", "std"])
    out.columns = list(AGE_STATS)
    return out


def course_counts(root, ed, q):
    d = _read(root, f"microdados{ed}_arq{q.file_no}.csv").dropna(subset=["CO_CURSO"])
    d[q.column] = d[q.column].fillna("N")
    p = pd.pivot_table(d, values="NU_ANO", index="CO_CURSO", columns=q.column, aggfunc="count",
                       fill_value=0)
    p = p.reindex(columns=list(q.codes), fill_value=0)
    p.columns = [q.cell(c) for c in q.codes]
    return p


def expected(root, ed):
    reg, ireg = registry(root, ed)
    sc = course_scores(root, ed)
    ag = course_ages(root, ed)
    counts = [course_counts(root, ed, q) for q in QUESTIONS]
    course = sc.reset_index().merge(reg, on="CO_CURSO", how="left", suffixes=("_x", "_y"))
    for c in counts + [ag]:
        course = course.merge(c.reset_index(), on="CO_CURSO", how="left")
    m = reg[["CO_CURSO", "CO_IES"]]
    inst = sc.reset_index().merge(m, on="CO_CURSO").groupby("CO_IES").agg(
        {c: _mean_round for c in SCORE_COLS})
    for c in counts:
        inst = inst.merge(c.reset_index().merge(m, on="CO_CURSO").drop(columns="CO_CURSO")
                          .groupby("CO_IES").sum(), on="CO_IES", how="left")
    inst = inst.merge(ag.reset_index().merge(m, on="CO_CURSO").drop(columns="CO_CURSO")
                      .groupby("CO_IES").mean(), on="CO_IES", how="left")
    inst = inst.reset_index() if "CO_IES" not in inst.columns else inst
    inst = inst.merge(ireg, on="CO_IES", how="left", suffixes=("", "_reg"))
    return course, inst
