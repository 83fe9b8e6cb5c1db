"""Scale rehearsal of the survey pipeline with a hot course.

Generates extracts in the real file layout with Spark (one course holds
``--hot`` of all respondents), runs ``build_marts`` and reports wall time
and, from Spark's event log, per stage the largest task against the median
task (records read, duration). A straggler caused by the hot course would
show as a large max/median ratio.

    python tools/rehearsal.py --students 250000 --editions 2019 2021
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from edumart.plans.marts import (  # noqa: E402
    build_marts, land_extracts, read_extracts, read_landed_extracts)
from edumart.schemas import (  # noqa: E402
    AGES_FILE_NO, COURSE_REGISTRY, INSTITUTION_REGISTRY, QUESTIONS, SCORES_FILE_NO)
from edumart.session import build_session  # noqa: E402
from edumart.sources import write_delimited  # noqa: E402

HOT_COURSE = 1


def generate(spark, root: str, editions, students: int, courses: int, hot: float) -> None:
    for ed in editions:
        base = spark.range(students).select(
            F.col("id"),
            F.when(F.rand(ed) < hot, F.lit(HOT_COURSE))
             .otherwise(F.lit(2) + F.abs(F.xxhash64("id", F.lit(ed)) % courses))
             .alias("CO_CURSO"),
            F.when(F.rand(ed + 1) < 0.97, F.lit(ed)).alias("NU_ANO"))

        def h(salt, k):  # deterministic pseudo-random category 0..k-1
            return (F.abs(F.xxhash64("id", F.lit(salt))) % k).cast("int")
        scores = base.select("NU_ANO", "CO_CURSO", *[
            F.when(h(10 + i, 10) > 0, F.round(h(20 + i, 1000) / 10.0, 1)).alias(c)
            for i, c in enumerate(("NT_GER", "NT_FG", "NT_CE"))])
        write_delimited(scores, f"{root}/microdados{ed}_arq{SCORES_FILE_NO}.csv")
        write_delimited(base.select("NU_ANO", "CO_CURSO", (F.lit(17) + h(30, 50)).alias("NU_IDADE")),
                        f"{root}/microdados{ed}_arq{AGES_FILE_NO}.csv")
        for j, q in enumerate(QUESTIONS):
            codes = F.array(*[F.lit(c) for c in q.codes[:-1]])
            ans = F.when(h(40 + j, 20) > 0, F.element_at(codes, h(60 + j, len(q.codes) - 1) + 1))
            write_delimited(base.select("NU_ANO", "CO_CURSO", ans.alias(q.column)),
                            f"{root}/microdados{ed}_arq{q.file_no}.csv")
        reg = spark.range(1, courses + 2).select(
            *[(F.col("id") if n == "CO_CURSO" else
               (F.col("id") % 300 + 1) if n == "CO_IES" else
               F.lit(ed) if n == "NU_ANO_CENSO" else
               F.concat(F.lit(n.lower() + "_"), F.col("id").cast("string")) if t == "string" else
               (F.col("id") % 7)).cast(t).alias(n) for n, t in COURSE_REGISTRY])
        write_delimited(reg, f"{root}/MICRODADOS_CADASTRO_CURSOS_{ed}.CSV")
        ireg = spark.range(1, 301).select(
            *[(F.col("id") if n == "CO_IES" else F.lit(ed) if n == "NU_ANO_CENSO" else
               F.concat(F.lit("Instituição "), F.col("id").cast("string")) if t == "string" else
               (F.col("id") % 5)).cast(t).alias(n) for n, t in INSTITUTION_REGISTRY])
        write_delimited(ireg, f"{root}/MICRODADOS_CADASTRO_IES_{ed}.CSV")


def stage_report(evdir: str) -> list[dict]:
    files = [p for p in glob.glob(f"{evdir}/**/*", recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith(".")]
    tasks, names, spans = {}, {}, {}
    for line in open(files[0]):
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            recs = m.get("Input Metrics", {}).get("Records Read", 0) + \
                m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            dur = e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"]
            tasks.setdefault(e["Stage ID"], []).append((recs, dur))
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            names[si["Stage ID"]] = si["Stage Name"][:50]
            spans[si["Stage ID"]] = si["Completion Time"] - si["Submission Time"]
    out = []
    for sid, ts in sorted(tasks.items()):
        if len(ts) < 4:
            continue
        recs = [r for r, _ in ts]
        durs = [d for _, d in ts]
        out.append({"stage": sid, "tasks": len(ts), "wall_ms": spans.get(sid, 0),
                    "max_records": max(recs),
                    "median_records": statistics.median(recs), "max_ms": max(durs),
                    "median_ms": statistics.median(durs), "name": names.get(sid, "")})
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--students", type=int, default=250_000)
    ap.add_argument("--courses", type=int, default=20_000)
    ap.add_argument("--editions", type=int, nargs="+", default=[2017, 2018, 2019, 2021])
    ap.add_argument("--hot", type=float, default=1 / 3)
    ap.add_argument("--cpus", type=int, default=os.cpu_count() or 8)
    ap.add_argument("--landed", action="store_true",
                    help="also land the extracts into Parquet and build from the lake")
    args = ap.parse_args()
    work = tempfile.mkdtemp(prefix="edumart-rehearsal-")
    evdir = f"{work}/events"
    os.makedirs(evdir)
    spark = build_session(f"local[{args.cpus}]", args.cpus, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "16m"})
    t0 = time.time()
    generate(spark, f"{work}/extracts", args.editions, args.students, args.courses, args.hot)
    t1 = time.time()
    ex = read_extracts(spark, f"{work}/extracts", args.editions)
    paths = build_marts(spark, ex, f"{work}/lake", "2024-02-16")
    t2 = time.time()
    landed = {}
    if args.landed:
        land_extracts(spark, f"{work}/extracts", args.editions, f"{work}/lake2", "2024-02-16")
        t3 = time.time()
        build_marts(spark, read_landed_extracts(spark, f"{work}/lake2", "2024-02-16"),
                    f"{work}/lake2", "2024-02-16")
        landed = {"land_s": round(t3 - t2, 1), "build_from_lake_s": round(time.time() - t3, 1)}
    cm = spark.read.parquet(paths["course_mart"])
    hot_n = cm.filter(F.col("CO_CURSO") == HOT_COURSE).select("M", "F", "N").first()
    spark.stop()
    report = stage_report(evdir)
    worst = max(report, key=lambda r: r["max_ms"] / max(r["median_ms"], 1))
    print(json.dumps({
        "respondent_rows_per_file": args.students * len(args.editions),
        "files": 16 * len(args.editions), "generate_s": round(t1 - t0, 1),
        "build_marts_s": round(t2 - t1, 1), **landed,
        "hot_course_sex_counts": list(hot_n) if hot_n else None,
        "stages_checked": len(report),
        "max_task_records": max(r["max_records"] for r in report),
        "worst_stage_by_time_ratio": worst,
        "longest_stages": sorted(report, key=lambda r: -r["wall_ms"])[:6]}, indent=1))


if __name__ == "__main__":
    main()
