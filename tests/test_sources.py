"""Sources and sinks: Latin-1 delimited text, NA tokens, file order, layers,
manifests, routing (E11, E16-E19)."""

import os

from pyspark.sql import functions as F

from edumart.operators import dedupe_first
from edumart.sources import (
    list_files, manifest_report, publish, read_delimited, read_layer, read_mart,
    route_by_filename, with_file_ordinal, write_layer, write_mart)


def _write_bytes(path, text, enc="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_e11_na_tokens(spark, tmp_dir):
    p = f"{tmp_dir}/na.csv"
    _write_bytes(p, "a;b\n;x\nNA;y\n ;z\nnull;None\n")
    rows = read_delimited(spark, p, [("a", "string"), ("b", "string")]).collect()
    assert [(r.a is None, r.b is None) for r in rows] == [
        (True, False), (True, False), (False, False), (True, True)]


def test_e16_latin1_roundtrip(spark, tmp_dir):
    p = f"{tmp_dir}/l1.csv"
    _write_bytes(p, "NO_MUNICIPIO;RESP\nSão;NÃO\n")
    df = read_delimited(spark, p, [("NO_MUNICIPIO", "string"), ("RESP", "string")])
    assert [tuple(r) for r in df.collect()] == [("São", "NÃO")]
    out = f"{tmp_dir}/mart"
    write_mart(df, out, fmt="csv")
    back = read_mart(spark, out, [("NO_MUNICIPIO", "string"), ("RESP", "string")])
    assert [tuple(r) for r in back.collect()] == [("São", "NÃO")]


def test_typed_columns_by_name_and_float_ints(spark, tmp_dir):
    p = f"{tmp_dir}/t.csv"
    _write_bytes(p, "X;CO_CURSO;NT_GER\nq;7.0;45.5\nq;12;abc\nq;1e30;1\nq;2.5;2\n")
    df = read_delimited(spark, p, [("NT_GER", "double"), ("CO_CURSO", "bigint")])
    assert [tuple(r) for r in df.collect()] == [(45.5, 7), (None, 12), (1.0, None), (2.0, None)]
    df2 = read_delimited(spark, p, [("NT_GER", "double")], decimal_comma=True)
    assert df2.count() == 4


def test_e17_file_order_over_splits(spark, tmp_dir):
    p = f"{tmp_dir}/big.csv"
    n = 200_000
    _write_bytes(p, "id;v\n" + "".join(f"{i};{i % 13}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_delimited(spark, p, [("id", "bigint"), ("v", "int")], ordinal=True)
        assert df.rdd.getNumPartitions() > 10
        ids = df.orderBy("_ordinal").select("id").toPandas()["id"].tolist()
        assert ids == list(range(n))
        first = {r.v: r.id for r in dedupe_first(df, "v").collect()}
        assert first == {k: k for k in range(13)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_e18_routing_ignores_strays(spark, tmp_dir):
    for name in ("course_mart_2019.csv", "institution_mart_2019.csv", "other.csv", "notes.txt"):
        _write_bytes(f"{tmp_dir}/r/{name}", "a\n1\n2\n")
    scan = spark.read.option("header", True).csv(f"{tmp_dir}/r")
    routed = route_by_filename(scan, [("institution_mart", "inst"), ("course_mart", "course")],
                               suffix=".csv")
    got = {r.relation: r["count"] for r in routed.groupBy("relation").count().collect()}
    assert got == {"inst": 2, "course": 2}


def test_e19_manifest_reports_absent(spark, tmp_dir):
    _write_bytes(f"{tmp_dir}/m/a.csv", "x\n")
    manifest = spark.createDataFrame([("a", "a.csv"), ("b", "b.csv")], "relation string, file_name string")
    got = [r.file_name for r in manifest_report(spark, manifest, f"{tmp_dir}/m").collect()]
    assert got == ["b.csv"]
    assert [r.file_name for r in list_files(spark, f"{tmp_dir}/m").collect()] == ["a.csv"]


def test_layers_partition_overwrite_and_publish(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    df = spark.range(10).withColumn("edition", (F.col("id") % 2 + 2020).cast("int"))
    write_layer(df, root, "silver", "t", "2024-01-01", ["edition"])
    write_layer(df.filter("id < 4"), root, "silver", "t", "2024-01-02", ["edition"])
    write_layer(df.filter("id < 2"), root, "silver", "t", "2024-01-02", ["edition"])  # rerun of a day
    assert read_layer(spark, root, "silver", "t", "2024-01-01").count() == 10
    assert read_layer(spark, root, "silver", "t", "2024-01-02").count() == 2
    pruned = read_layer(spark, root, "silver", "t", "2024-01-01").filter("edition = 2021")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionfilters" in plan.lower()
    target = publish(spark, f"{root}/silver/t", f"{tmp_dir}/published")
    assert spark.read.parquet(target).count() == 12


def test_missing_column_policy(spark, tmp_dir):
    import pytest
    p = f"{tmp_dir}/old.csv"
    _write_bytes(p, "CO_CURSO;NO_CURSO\n1;Direito\n")
    cols = [("CO_CURSO", "bigint"), ("NO_CURSO", "string"), ("NO_CINE_ROTULO", "string")]
    with pytest.raises(ValueError):
        read_delimited(spark, p, cols)
    df = read_delimited(spark, p, cols, missing="null")
    assert [tuple(r) for r in df.collect()] == [(1, "Direito", None)]
    assert dict(df.dtypes)["NO_CINE_ROTULO"] == "string"


def test_decimal_comma_scores(spark, tmp_dir):
    p = f"{tmp_dir}/dc.csv"
    _write_bytes(p, "CO_CURSO;NT_GER\n1;45,6\n2;NA\n")
    df = read_delimited(spark, p, [("CO_CURSO", "bigint"), ("NT_GER", "double")], decimal_comma=True)
    assert [tuple(r) for r in df.collect()] == [(1, 45.6), (2, None)]


def test_union_csv_marts_different_headers(spark, tmp_dir):
    from edumart.plans.marts import union_csv_marts
    root = f"{tmp_dir}/marts"
    _write_bytes(f"{root}/course_mart_2019/part-0.csv", "edition,CO_CURSO,A\n2019,1,5\n", "utf-8")
    _write_bytes(f"{root}/course_mart_2021/part-0.csv", "CO_CURSO,B,edition\n2,7,2021\n", "utf-8")
    _write_bytes(f"{root}/institution_mart_2021/part-0.csv", "edition,CO_IES\n2021,9\n", "utf-8")
    _write_bytes(f"{root}/course_mart_2021/notes.txt", "stray\n", "utf-8")
    u = union_csv_marts(spark, root, "course_mart")
    assert u.columns[0] == "edition" and set(u.columns) == {"edition", "CO_CURSO", "A", "B"}
    got = sorted((r.edition, r.CO_CURSO, r.A, r.B) for r in u.collect())
    assert got == [(2019, 1, "5", None), (2021, 2, None, "7")]


def test_union_csv_marts_takes_one_run_and_routes_on_the_folder(spark, tmp_dir):
    import pytest
    from edumart.plans.marts import union_csv_marts
    root = f"{tmp_dir}/institution_mart_lake"
    _write_bytes(f"{root}/date=2024-02-15/course_mart/part-0.csv", "edition,CO_CURSO\n2019,1\n", "utf-8")
    _write_bytes(f"{root}/date=2024-02-16/course_mart/part-0.csv", "edition,CO_CURSO,NT_GER\n2019,1,2.5\n", "utf-8")
    u = union_csv_marts(spark, root, "course_mart", "2024-02-16")
    assert u.dtypes == [("edition", "int"), ("CO_CURSO", "bigint"), ("NT_GER", "double")]
    assert [tuple(r) for r in u.collect()] == [(2019, 1, 2.5)]
    with pytest.raises(ValueError):
        union_csv_marts(spark, root, "institution_mart", "2024-02-16")
    with pytest.raises(ValueError):
        union_csv_marts(spark, root, "course_mart")


def test_rejects_name_the_columns_that_do_not_read(spark, tmp_dir):
    from edumart.functions.scalar import exact_mean
    from edumart.operators import count_rejects
    from edumart.sources import REJECTED
    p = f"{tmp_dir}/rej.csv"
    _write_bytes(p, "CO_CURSO;NT_GER\n1;1,5\n1O0;2.5\nNA;NA\n7.0;0.00004\n;1e15\n")
    df = read_delimited(spark, p, [("CO_CURSO", "bigint"), ("NT_GER", "double")], rejects=True)
    assert {r["column"]: r.n for r in count_rejects(df, REJECTED).collect()} == {"CO_CURSO": 1, "NT_GER": 1}
    small = spark.createDataFrame([(0.00004,), (0.00004,)], "x double").agg(exact_mean("x").alias("m")).first().m
    assert small == 0.00004
    assert df.agg(exact_mean("NT_GER").alias("m")).first().m == (2.5 + 0.00004 + 1e15) / 3


def test_folder_of_files_with_other_headers_fails(spark, tmp_dir):
    import pytest
    _write_bytes(f"{tmp_dir}/f/a.csv", "CO_CURSO;QE_I01\n1;A\n")
    _write_bytes(f"{tmp_dir}/f/b.csv", "QE_I01;CO_CURSO\nB;2\n")
    with pytest.raises(Exception):
        read_delimited(spark, f"{tmp_dir}/f", [("CO_CURSO", "bigint"), ("QE_I01", "string")]).collect()


def test_routing_rules(spark):
    from edumart.sources import route_expr
    df = spark.createDataFrame([("course_mart_2019",), ("old_course_mart",), ("course_mart",)], "n string")
    rules = [("course_mart", "c")]
    got = {m: [r.x for r in df.select(route_expr(F.col("n"), rules, match=m).alias("x")).collect()] for m in ("contains", "prefix", "exact")}
    assert got == {"contains": ["c", "c", "c"], "prefix": ["c", None, "c"], "exact": [None, None, "c"]}


def test_publish_layer_keeps_keys_schemas_and_csv(spark, tmp_dir):
    from edumart.sources import publish_layer, write_mart
    root, target = f"{tmp_dir}/pl", f"{tmp_dir}/pl-target"
    df = spark.createDataFrame([(1, 2019), (2, 2021)], "id int, edition int")
    for day in ("2024-02-15", "2024-02-16"):
        write_layer(df, root, "gold", "m", day, ["edition"])
    write_layer(df.filter("id < 0"), root, "gold", "v", "2024-02-16", ["edition"])
    write_mart(df, f"{root}/gold/csv/date=2024-02-16/m", fmt="csv", partition_by=["edition"])
    keys = publish_layer(spark, root, "gold", f"{target}/gold", "2024-02-16")
    assert sorted(keys) == ["csv/date=2024-02-16/m", "m/date=2024-02-16", "v/date=2024-02-16"]
    assert sorted(r.id for r in read_layer(spark, target, "gold", "m", "2024-02-16").collect()) == [1, 2]
    assert read_layer(spark, target, "gold", "v", "2024-02-16").columns == ["id", "edition", "date"]
    copy = spark.read.option("header", True).csv(f"{target}/gold/csv/date=2024-02-16/m")
    assert copy.columns == ["id", "edition"] and copy.count() == 2


def test_rerun_replaces_exactly_its_day(spark, tmp_dir):
    root = f"{tmp_dir}/rerun"
    df = spark.createDataFrame([(1, 2019), (2, 2021)], "id int, edition int")
    write_layer(df, root, "gold", "t", "2024-02-15", ["edition"])
    write_layer(df, root, "gold", "t", "2024-02-16", ["edition"])
    write_layer(df.filter("edition = 2021"), root, "gold", "t", "2024-02-16", ["edition"])
    assert [r.id for r in read_layer(spark, root, "gold", "t", "2024-02-16").collect()] == [2]
    assert read_layer(spark, root, "gold", "t", "2024-02-15").count() == 2
    write_layer(df.filter("id < 0"), root, "gold", "t", "2024-02-16", ["edition"])
    again = read_layer(spark, root, "gold", "t", "2024-02-16")
    assert again.count() == 0 and again.columns == ["id", "edition", "date"]
    wider = df.selectExpr("*", "id * 2 as more")
    write_layer(wider, root, "gold", "t", "2024-02-17")
    assert read_layer(spark, root, "gold", "t", "2024-02-17").columns == ["id", "edition", "more", "date"]


def test_records_of_the_wrong_width_are_counted_by_the_landing_write(spark, tmp_dir):
    from edumart.operators import count_rejects
    from edumart.sources import BROKEN, LONG, REJECTED, SHORT, land_counted
    p = f"{tmp_dir}/ragged.csv"
    with open(p, "w", encoding="latin-1") as f:
        f.write('CO_CURSO;TX;NT_GER\n1;x;2\n3;y\n4;z;5;99;98\n"5";"q;1";7\n6;"q;1""w";7;"k;k"\n7;"a;b"\nbad;t;1\n;;\n9;u;bad;x\n')
    cols = [("CO_CURSO", "bigint"), ("NT_GER", "double")]
    df = read_delimited(spark, p, cols, rejects=True)
    assert {r["column"]: r.n for r in count_rejects(df, REJECTED).collect()} == {SHORT: 2, LONG: 3, "CO_CURSO": 1, "NT_GER": 1}
    assert [(r.CO_CURSO, r.NT_GER) for r in df.collect()] == [
        (1, 2.0), (3, None), (4, 5.0), (5, 7.0), (6, 7.0), (7, None), (None, 1.0), (None, None), (9, None)]
    assert BROKEN not in {r["column"] for r in count_rejects(df, REJECTED).collect()}
    q = f"{tmp_dir}/empty.csv"
    with open(q, "w", encoding="latin-1") as f:
        f.write("NT_GER;CO_CURSO\n")
    jobs = []
    got = land_counted({"a": df, "b": read_delimited(spark, q, cols, rejects=True)},
                       lambda d: jobs.append(d.write.parquet(f"{tmp_dir}/landed")))
    assert len(jobs) == 1 and spark.read.parquet(f"{tmp_dir}/landed").count() == 9
    assert got == {"a": {"n_rows": 9, "n_short": 2, "n_long": 3, "n_broken": 0, "n_unreadable": 2},
                   "b": {"n_rows": 0, "n_short": 0, "n_long": 0, "n_broken": 0, "n_unreadable": 0}}
