"""Operator unit tests on inline rows (edge cases E1-E15 of FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from edumart.functions import fill_category, round_half_even
from edumart.operators import (
    CodeSetError, answers_long, avg_of_stats, count_long, crosstab, crosstab_discovered, dedupe_first, desc_nulls_last_order,
    discover_codes, domain_violations, drop_like, duplicate_keys, join_suffixed, mean_of_means, mean_scores,
    move_first, null_safe_join, rollup, union_editions, value_stats, widen, with_position)


def test_e1_round_half_even(spark):
    df = spark.createDataFrame([(x,) for x in (2.675, 0.575, 1.005, 0.125, 0.375, 47.125)], "x double")
    got = [r.y for r in df.select(round_half_even("x", 2).alias("y")).collect()]
    assert got == [2.68, 0.57, 1.0, 0.12, 0.38, 47.12]


def test_e2_single_value_stats(spark):
    df = spark.createDataFrame([(1, 5), (2, 3), (2, 4), (2, 10), (2, 11), (3, None)], "k int, v int")
    got = {r.k: r for r in value_stats(df, ["k"], "v").collect()}
    assert (got[1].mean, got[1].median, got[1].std) == (5.0, 5.0, None)
    assert got[2].mean == 7.0 and got[2].median == 7.0
    assert abs(got[2].std - (sum((x - 7.0) ** 2 for x in (3, 4, 10, 11)) / 3) ** 0.5) < 1e-12
    assert (got[3].mean, got[3].median, got[3].std) == (None, None, None)


def test_median_odd_and_repeated(spark):
    rows = [(1, v) for v in (1, 1, 1, 2, 9)] + [(2, v) for v in (4, 4, 6, 6)]
    df = spark.createDataFrame([(k, float(v)) for k, v in rows], "k int, v double")
    got = {r.k: r.median for r in value_stats(df, ["k"], "v").collect()}
    assert got == {1: 1.0, 2: 5.0}


def test_e3_crosstab_fill_and_null_key(spark):
    df = spark.createDataFrame([(1, "B"), (1, "A"), (2, None), (None, "A")], "c int, q string")
    cells = [("A", "a"), ("B", "b"), ("N", "n")]
    got = {r.c: (r.a, r.b, r.n) for r in crosstab(df, ["c"], fill_category("q"), cells).collect()}
    assert got == {1: (1, 1, 0), 2: (0, 0, 1)}


def test_e4_counts_non_missing_counted_column(spark):
    df = spark.createDataFrame([(1, "A", 2021), (1, "A", None)], "c int, q string, y int")
    long = answers_long(df, ["c"], "q", "q1", counted="y")
    wide = widen(count_long(long, ["c"]), ["c"], [("q1", "A", "a"), ("q1", "B", "b")])
    assert [(r.c, r.a, r.b) for r in wide.collect()] == [(1, 1, 0)]


def test_widen_absent_question_is_null(spark):
    d1 = spark.createDataFrame([(1, "A"), (2, "B")], "c int, q string")
    d2 = spark.createDataFrame([(1, "X")], "c int, q string")
    long = union_editions([answers_long(d1, ["c"], "q", "q1"), answers_long(d2, ["c"], "q", "q2")])
    cells = [("q1", "A", "q1a"), ("q1", "B", "q1b"), ("q2", "X", "q2x"), ("q2", "Y", "q2y")]
    got = {r.c: tuple(r)[1:] for r in widen(count_long(long, ["c"]), ["c"], cells).collect()}
    assert got == {1: (1, 0, 1, 0), 2: (0, 1, None, None)}


def test_e5_e6_two_level_mean_and_zero_fill(spark):
    s = spark.createDataFrame([(10, 60.0), (10, 80.0), (11, 10.0), (20, 70.0), (21, None)],
                              "course int, x double")
    reg = spark.createDataFrame([(10, 1), (11, 1), (20, 2), (21, 2)], "course int, inst int")
    course = mean_scores(s, ["course"], ["x"], zero_fill=True)
    assert {r.course: r.x for r in course.collect()} == {10: 70.0, 11: 10.0, 20: 70.0, 21: 0.0}
    inst = mean_of_means(course, reg, "course", "inst", ["x"])
    assert {r.inst: r.x for r in inst.collect()} == {1: 40.0, 2: 35.0}


def test_rollup_drops_unmapped(spark):
    counts = spark.createDataFrame([(1, "q", "A", 3), (2, "q", "A", 4), (99, "q", "A", 5)],
                                   "course int, question string, code string, n long")
    reg = spark.createDataFrame([(1, 7), (2, 7)], "course int, inst int")
    got = rollup(counts, reg, "course", "inst").collect()
    assert [(r.inst, r.n) for r in got] == [(7, 7)]


def test_avg_of_stats_skips_null(spark):
    st = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "course int, s double")
    reg = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "course int, inst int")
    assert avg_of_stats(st, reg, "course", "inst", ["s"]).collect()[0].s == 3.0


def test_e8_keep_first_by_ordinal(spark):
    df = spark.createDataFrame([(2, 1, 0), (1, 2, 1), (2, 3, 2)], "k int, v int, _ordinal long")
    got = sorted((r.k, r.v) for r in dedupe_first(df, "k").collect())
    assert got == [(1, 2), (2, 1)]
    assert dedupe_first(df, "k").columns == ["k", "v"]


def test_e9_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    assert null_safe_join(left, right, "k").count() == 2
    odd = right.withColumnRenamed("r", "_r_code").withColumn("l", F.lit(1)).withColumn("k_right", F.lit(2))
    assert null_safe_join(left, odd, "k").columns == ["k", "l_x", "_r_code", "l_y", "k_right"]
    assert left.join(right, "k").count() == 1


def test_e10_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(1, 2)], "a int, c int")
    u = union_editions([a, b])
    assert u.columns == ["a", "b", "c"]
    assert sorted(u.collect(), key=lambda r: (r.b is None, r.c is None)) == [(1, 2, None), (1, None, 2)]
    with pytest.raises(ValueError):
        union_editions([])


def test_e12_sort_with_position(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, t double")
    got = sorted((r.pos, r.k) for r in with_position(df, desc_nulls_last_order("t", ["k"])).collect())
    assert got == [(1, 3), (2, 1), (3, 2)]


def test_position_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") % 997).alias("t"), "id")
    out = with_position(df, [F.col("t").desc(), F.col("id").asc()]).toPandas()
    exp = df.toPandas().sort_values(["t", "id"], ascending=[False, True]).reset_index(drop=True)
    out = out.sort_values("pos").reset_index(drop=True)
    assert list(out["pos"]) == list(range(1, 5001))
    assert list(out["id"]) == list(exp["id"])


def test_e14_domain_violations(spark):
    df = spark.createDataFrame([("A",), ("Z",), ("Z",), ("B",)], "code string")
    got = [(r.code, r.n) for r in domain_violations(df, "code", ["A", "B"]).collect()]
    assert got == [("Z", 2)]


def test_e15_unseen_code_is_zero_column(spark):
    df = spark.createDataFrame([(1, "A")], "c int, q string")
    r = crosstab(df, ["c"], "q", [("A", "a"), ("E", "e")]).collect()[0]
    assert (r.a, r.e) == (1, 0)


def test_join_suffixed_and_drop_move(spark):
    a = spark.createDataFrame([(1, "x", 5)], "k int, name string, v int")
    b = spark.createDataFrame([(1, "y")], "k int, name string")
    j = join_suffixed(a, b, "k", how="inner")
    assert j.columns == ["k", "name_x", "v", "name_y"]
    assert drop_like(j, "_y").columns == ["k", "name_x", "v"]
    assert move_first(j, "v").columns == ["v", "k", "name_x", "name_y"]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.n) for r in duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_hot_key_aggregates_without_skew_failure(spark):
    # a third of all rows on one course: partial aggregation keeps it cheap
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("c"),
        (F.col("id") % 50).cast("int").alias("age"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("q"))
    st = {r.c: r for r in value_stats(hot, ["c"], "age").filter("c = -1").collect()}
    ages = [i % 50 for i in range(0, 30000, 3)]
    assert st[-1].mean == pytest.approx(sum(ages) / len(ages))
    ct = crosstab(hot, ["c"], "q", [("A", "a"), ("B", "b")]).filter("c = -1").collect()[0]
    assert ct.a + ct.b == 10000


def test_approx_median_opt_in(spark):
    df = spark.range(0, 1001).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    exact = {r.k: r.median for r in value_stats(df, ["k"], "v").collect()}
    approx = {r.k: r.median for r in value_stats(df, ["k"], "v", exact_median=False).collect()}
    assert exact == {0: 500.0, 1: 500.0}
    assert all(abs(approx[k] - exact[k]) <= 2 for k in exact)


def test_mean_keeps_small_digits_and_large_values(spark):
    from edumart.operators import mean_scores
    df = spark.createDataFrame([(1, 0.00004), (1, 0.00004), (2, 1e15), (2, 3e15)], "k int, v double")
    got = {r.k: r.v for r in mean_scores(df, ["k"], ["v"], places=None).collect()}
    assert got == {1: 0.00004, 2: 2e15}


def test_continuous_stats_equal_plain_ones_without_gathering_the_hot_key(spark):
    import random
    import statistics

    from edumart.operators.selection import ranges, value_stats_continuous
    rng = random.Random(3)
    rows = [(0, rng.random() * 1000) for _ in range(3000)] + [(1, 5.0)] * 400 + [(2, 7.25), (3, None), (None, 1.0), (4, 1.0), (4, None), (4, 2.0)]
    rows += [(k, rng.choice([1.5, 2.5, rng.random()])) for k in range(10, 200) for _ in range(rng.randint(1, 40))]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    dealt = ranges(df, ["k"], "v", 12)
    sizes = [r["n"] for r in dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 10 and max(sizes) < 3 * sum(sizes) / len(sizes)                # no range holds the hot key
    assert dealt.filter("k = 0").select("_range").distinct().count() >= 5
    assert dealt.filter("k = 1").collect()[0]["_f"] == 400                              # a hot value is one counted row
    got = {r.k: r for r in value_stats_continuous(df, ["k"], "v", partitions=12).collect()}
    want = {}
    for k, v in rows:
        if k is not None:
            want.setdefault(k, []).extend([] if v is None else [v])
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k].median == (statistics.median(v) if v else None)
        assert got[k].mean == (pytest.approx(statistics.fmean(v)) if v else None)
        assert got[k].std == (pytest.approx(statistics.stdev(v)) if len(v) > 1 else None)
    assert value_stats_continuous(df.limit(0), ["k"], "v").count() == 0


def test_crosstab_discovered_takes_the_codes_that_occur(spark):
    rows = [(1, "B"), (1, "A"), (1, "A"), (2, None), (2, "é'x"), (None, "Z")]
    df = spark.createDataFrame(rows, "c int, q string")
    out = crosstab_discovered(df, ["c"], "q", prefix="q_")
    assert out.columns == ["c", "q_A", "q_B", "q_N", "q_é'x"]          # the code without a key makes no column
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {1: (2, 1, 0, 0), 2: (0, 0, 1, 1)}
    named = crosstab_discovered(df, ["c"], "q", ["first", "second", "missing", "other"], fill="N")
    assert named.columns == ["c", "first", "second", "missing", "other"] and named.count() == 2
    # from counts already made
    counts = count_long(answers_long(df, ["c"], "q", "Q"), ["c"])
    assert discover_codes(counts, "code") == ["A", "B", "N", "é'x"]
    unfilled = crosstab_discovered(df, ["c"], "q", fill=None)
    assert unfilled.columns == ["c", "A", "B", "é'x"] and {r[0]: tuple(r)[1:] for r in unfilled.collect()}[2] == (0, 0, 1)


def test_crosstab_discovered_refuses(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C")], "c int, q string")
    with pytest.raises(CodeSetError, match="3 codes .* for 2 labels"):
        crosstab_discovered(df, ["c"], "q", ["a", "b"])
    with pytest.raises(CodeSetError, match="repeat"):
        crosstab_discovered(df, ["c"], "q", ["a", "b", "a"])
    with pytest.raises(CodeSetError, match="more than 2 codes"):
        crosstab_discovered(df, ["c"], "q", limit=2)
    assert len(crosstab_discovered(df, ["c"], "q", limit=3).columns) == 4
    empty = crosstab_discovered(df.limit(0), ["c"], "q")
    assert empty.columns == ["c"] and empty.count() == 0
