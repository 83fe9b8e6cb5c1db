"""Incremental landing: each arrived file is landed once, reruns add only
new files."""

import os

from edumart.streaming import extract_stream, land, land_arrivals


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode("latin-1"))


def test_landing_is_incremental_and_exactly_once(spark, tmp_dir):
    landing, lake, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    _write(f"{landing}/microdados2019_arq7.csv", "NU_ANO;CO_CURSO;QE_I01\n2019;1;A\n2019;2;\n")
    _write(f"{landing}/microdados2021_arq7.csv", "NU_ANO;CO_CURSO;QE_I01\n2021;1;B\n")
    _write(f"{landing}/readme.txt", "not an extract\n")
    header = ["NU_ANO", "CO_CURSO", "QE_I01"]
    cols = [("NU_ANO", "int"), ("CO_CURSO", "bigint"), ("QE_I01", "string")]

    def run():
        q = land(extract_stream(spark, landing, header, cols), lake, "arq7", "2024-02-16", ckpt)
        q.awaitTermination()

    run()
    out = spark.read.parquet(f"{lake}/bronze/arq7")
    assert out.count() == 3
    assert sorted(r.edition for r in out.select("edition").distinct().collect()) == [2019, 2021]
    assert out.filter("QE_I01 is null").count() == 1
    run()  # nothing new: no duplicates
    assert spark.read.parquet(f"{lake}/bronze/arq7").count() == 3
    _write(f"{landing}/microdados2018_arq7.csv", "NU_ANO;CO_CURSO;QE_I01\n2018;5;C\n")
    run()
    out = spark.read.parquet(f"{lake}/bronze/arq7")
    assert out.count() == 4 and out.filter("edition = 2018").count() == 1


def test_swapped_headers_stop_and_strays_stay_out(spark, tmp_dir):
    import pytest
    landing, lake = f"{tmp_dir}/landing2", f"{tmp_dir}/lake2"
    _write(f"{landing}/microdados2019_arq7.csv", "NU_ANO;CO_CURSO;QE_I01\n2019;1;A\n")
    _write(f"{landing}/other.csv", "a;b\n1;2\n")
    header, cols = ["NU_ANO", "CO_CURSO", "QE_I01"], [("NU_ANO", "int"), ("CO_CURSO", "bigint"), ("QE_I01", "string")]

    def run():
        land(extract_stream(spark, landing, header, cols), lake, "arq7", "2024-02-16", f"{tmp_dir}/ckpt2").awaitTermination()

    run()
    assert spark.read.parquet(f"{lake}/bronze/arq7").count() == 1
    _write(f"{landing}/microdados2021_arq7.csv", "CO_CURSO;NU_ANO;QE_I01\n7;2021;B\n")
    with pytest.raises(Exception):
        run()


def test_arrivals_land_by_their_own_headers_and_feed_the_marts(spark, tmp_dir):
    from extract_fixture import EDITIONS, make_extracts
    from edumart.plans import marts as M
    src, lake, ckpt = f"{tmp_dir}/arrive", f"{tmp_dir}/arrive-lake", f"{tmp_dir}/arrive-ckpt"
    make_extracts(src, n_students=80)
    _write(f"{src}/other.csv", "a;b\n1;2\n")
    path = f"{src}/microdados2021_arq8.csv"                     # one file with its columns in another order
    with open(path, encoding="latin-1") as f:
        rows = [line.rstrip("\n").split(";") for line in f]
    _write(path, "".join(";".join(r[::-1]) + "\n" for r in rows))
    for _ in range(2):                                          # the second run finds nothing new
        land_arrivals(spark, src, lake, "2024-02-16", ckpt).awaitTermination()
    landed = M.read_landed_extracts(spark, lake, "2024-02-16")
    direct = M.read_extracts(spark, src, EDITIONS)
    a, b = M.course_mart(direct), M.course_mart(landed)
    assert b.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
