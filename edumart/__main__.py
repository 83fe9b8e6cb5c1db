"""Command line: build the marts for a set of editions.

    python -m edumart build --extracts <folder> --editions 2017 2018 2019 2021 \
        --lake <lake uri> --run-date 2024-02-16

    spark-submit --py-files edumart.zip edumart/__main__.py build ...   # cluster

Cluster settings (executors, memory, ``spark.checkpoint.dir``) come from
spark-submit; the session only adds the SQL settings of ``CLUSTER_CONF``
that were not set already.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from edumart.plans.incremental import refresh_marts
from edumart.plans.marts import (
    ExtractLayout, all_editions_mart, build_marts, land_extracts, read_extracts, read_landed_extracts)
from edumart.session import CLUSTER_CONF, DRIVER_CONF, checkpoint_root
from edumart.sources import LATIN1, publish_layer, write_layer
from edumart.streaming import land_arrivals


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="edumart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build course and institution marts")
    b.add_argument("--extracts", default=None, help="folder holding the extract files")
    b.add_argument("--editions", required=True, nargs="+", type=int)
    b.add_argument("--lake", required=True, help="lake root URI (silver/gold layers)")
    b.add_argument("--run-date", required=True)
    b.add_argument("--no-csv", action="store_true", help="skip the CSV copy of the marts")
    b.add_argument("--from-lake", action="store_true",
                   help="read extracts landed by `land` instead of the text files")
    ld = sub.add_parser("land", help="parse extract files once into the lake (Parquet)")
    ld.add_argument("--extracts", required=True)
    ld.add_argument("--editions", required=True, nargs="+", type=int)
    ld.add_argument("--lake", required=True)
    ld.add_argument("--run-date", required=True)
    ld.add_argument("--new-only", metavar="CHECKPOINT", default=None,
                    help="land only files that arrived since the last run (source log in this folder)")
    rf = sub.add_parser("refresh", help="bring the marts up to changed extract files, editions untouched stay")
    rf.add_argument("--extracts", required=True)
    rf.add_argument("--editions", required=True, nargs="+", type=int)
    rf.add_argument("--lake", required=True)
    for p in (b, ld, rf):
        p.add_argument("--decimal-comma", action="store_true")
        p.add_argument("--sep", default=";")
        p.add_argument("--encoding", default=LATIN1)
        p.add_argument("--answers-name", default=ExtractLayout.answers, help="file name with {edition} and {n}")
        p.add_argument("--course-registry-name", default=ExtractLayout.course_registry)
        p.add_argument("--institution-registry-name", default=ExtractLayout.institution_registry)
        p.add_argument("--registry-missing", choices=("error", "null"), default="error")
    b.add_argument("--max-rejects", type=int, default=0, help="unreadable values that do not stop the build")
    al = sub.add_parser("all-editions", help="write both marts with all editions of a run date in one table")
    pb = sub.add_parser("publish", help="copy a whole layer to another URI, keys kept")
    pb.add_argument("--layer", default="gold")
    pb.add_argument("--target", required=True)
    for p in (al, pb):
        p.add_argument("--lake", required=True)
        p.add_argument("--run-date", required=True)
    args = ap.parse_args(argv)
    if args.cmd == "build" and not args.from_lake and not args.extracts:
        ap.error("build needs --extracts or --from-lake")

    builder = SparkSession.builder.appName("edumart")
    for k, v in DRIVER_CONF.items():       # static: only applies to a new session
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in CLUSTER_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    checkpoint_root(spark)
    if args.cmd == "publish":
        print(json.dumps(publish_layer(spark, args.lake, args.layer, args.target, args.run_date), indent=2))
        return
    if args.cmd == "all-editions":
        print(json.dumps({n: write_layer(all_editions_mart(spark, args.lake, n, args.run_date), args.lake, "gold",
                                         f"all_editions/{n}", args.run_date)
                          for n in ("course_mart", "institution_mart")}, indent=2))
        return
    layout = ExtractLayout(args.answers_name, args.course_registry_name, args.institution_registry_name,
                           args.sep, args.encoding, args.decimal_comma, args.registry_missing)
    if args.cmd == "land" and args.new_only:
        land_arrivals(spark, args.extracts, args.lake, args.run_date, args.new_only, layout).awaitTermination()
        out = {"landed": f"{args.lake}/silver/extracts"}
    elif args.cmd == "refresh":
        out = asdict(refresh_marts(spark, args.extracts, args.editions, args.lake, layout))
    elif args.cmd == "land":
        out = land_extracts(spark, args.extracts, args.editions, args.lake, args.run_date, layout)
    else:
        ex = (read_landed_extracts(spark, args.lake, args.run_date, args.editions)
              if args.from_lake else read_extracts(spark, args.extracts, args.editions, layout))
        out = build_marts(spark, ex, args.lake, args.run_date, csv_copy=not args.no_csv, max_rejects=args.max_rejects)
    print(json.dumps(out, indent=2))


if __name__ == "__main__":
    main()
