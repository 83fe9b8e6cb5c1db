"""Named queries on the driver tables.

The driver tables stand in for the survey extracts (roles fixed in the
survey blueprint): respondent rows = ``orders`` (+ ``lineitem``), course =
customer (``o_custkey``), institution = nation, question codes =
``o_orderstatus`` (status ``P`` plays "not answered") and
``o_orderpriority``, score = ``o_totalprice``, age = ``l_quantity``,
edition = year of ``o_orderdate``.

The driver tables hold no NULLs and no registry gaps, so two gaps are
*injected* to exercise the missing-data rules: courses whose key is a
multiple of 11 have no score (K2, zero fill) and courses whose key is a
multiple of 7 are absent from the course registry (K3). These are data
rules applied to every row, not row caps: every query reads its tables
whole.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the library operators; column names match the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edumart.functions.scalar import exact_mean, fill_category, round_half_even
from edumart.operators import (
    answers_long, avg_of_stats, chain_left, count_long, count_rejects, crosstab, crosstab_discovered, dedupe_first,
    desc_nulls_last_order, domain_violations, drop_like, drop_null_keys,
    duplicate_keys, enrich, join_suffixed, mean_of_means, mean_scores, move_first,
    null_safe_join, profile, project, rollup, union_editions, value_stats, value_stats_continuous,
    widen, with_position)
from edumart.plans.incremental import (
    FILE, Delivery, answer_state, land, level_state, merged_counts, merged_levels, merged_scores, score_state)
from edumart.session import scratch_path, sized
from edumart.sources import (
    COUNTS, LATIN1, REJECTED, land_counted, Snapshot, commit, read_snapshot, resolve, run_atomic, write_run, write_runs, manifest_report, publish_layer, read_delimited, read_layer, read_mart, route_by_filename,
    write_delimited, write_layer, write_mart)

# Schemas of the driver tables used here. Declaring them skips
# the footer-inference job Spark runs for every schemaless parquet read.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# ---------------------------------------------------------------- roles

def status_answer() -> Column:
    """Status with ``P`` read as a missing answer."""
    return F.nullif(F.col("o_orderstatus"), F.lit("P"))


def injected_score() -> Column:
    """Score with the K2 gap: courses with key % 11 == 0 have no score."""
    return F.when(F.col("o_custkey") % 11 != 0, F.col("o_totalprice"))


def registered(customer: DataFrame) -> DataFrame:
    """Course registry with the K3 gap: key % 7 == 0 is unregistered."""
    return customer.filter(F.col("c_custkey") % 7 != 0)


def edition() -> Column:
    return F.year("o_orderdate").cast("int")


def ages(spark, sf, course: str = "o_custkey") -> DataFrame:
    """One row per respondent-age observation: (course, l_quantity)."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"]) \
        .select(o["o_custkey"].alias(course), li["l_quantity"])


AGE_NAMES = ("mean_age", "median_age", "std_age")


def round4(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if c in cols else F.col(c) for c in df.columns])


def _orders_sel(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


ORDERS_SEL_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                    ("o_orderstatus", "string"), ("o_totalprice", "double")]

# ---------------------------------------------------------------- sources / sinks


def q_scan_delimited(spark, sf):
    path = scratch_path(spark, "scan_delimited")
    write_delimited(_orders_sel(spark, sf), path)
    return read_delimited(spark, path, ORDERS_SEL_TYPES)


def q_scan_mart(spark, sf):
    path = scratch_path(spark, "scan_mart")
    write_mart(_orders_sel(spark, sf), path, fmt="csv")
    return read_mart(spark, path, ORDERS_SEL_TYPES)


def q_sink_roundtrip(spark, sf):
    """Mart sink: a first run writes part of the rows, the rerun overwrites
    it (a rerun replaces the mart, never appends); read back the result."""
    path = scratch_path(spark, "sink_roundtrip")
    sel = _orders_sel(spark, sf)
    write_mart(sel.filter(F.col("o_orderstatus") == "F"), path)
    write_mart(sel, path, mode="overwrite")
    return read_mart(spark, path, ORDERS_SEL_TYPES, fmt="parquet")


def q_layer_publish(spark, sf):
    """A layer of two datasets (one of them partitioned) copied whole; the copy
    reads as a layer under the same keys."""
    root, day = scratch_path(spark, "lake"), "2024-02-16"
    write_layer(table(spark, sf, "orders").withColumn("edition", edition()), root, "gold", "orders", day, ["edition"])
    write_layer(table(spark, sf, "customer"), root, "gold", "customer", day)
    target = scratch_path(spark, "published")
    publish_layer(spark, root, "gold", f"{target}/gold", day)
    orders, customer = (read_layer(spark, target, "gold", n, day) for n in ("orders", "customer"))
    return orders.select(F.lit("orders").alias("relation"), "edition", F.col("o_orderkey").alias("id"),
                         F.col("o_totalprice").alias("amount")).unionByName(
        customer.select(F.lit("customer").alias("relation"), F.lit(None).cast("int").alias("edition"),
                        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount")))


def q_layer_rerun(spark, sf):
    """A day's run with all editions, then again with one: the rerun replaces the day."""
    root, day = scratch_path(spark, "rerun"), "2024-02-16"
    o = table(spark, sf, "orders").select("o_orderkey", edition().alias("edition"))
    write_layer(o, root, "silver", "orders", day, ["edition"])
    write_layer(o.filter(F.col("edition") == 1997), root, "silver", "orders", day, ["edition"])
    return read_layer(spark, root, "silver", "orders", day).select("o_orderkey", "edition")


def q_scan_rejects(spark, sf):
    """Orders as text with prices in decimal-comma form (keys divisible by 13)
    and course keys with a letter in them (keys divisible by 17): the values per
    column that do not read."""
    path = scratch_path(spark, "rejects")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_custkey").cast("string")
    write_delimited(table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 17 == 0, F.concat(key, F.lit("O"))).otherwise(key).alias("o_custkey"),
        "o_orderstatus", F.when(F.col("o_orderkey") % 13 == 0, F.translate(price, ".", ",")).otherwise(price).alias("o_totalprice")), path)
    bad = count_rejects(read_delimited(spark, path, ORDERS_SEL_TYPES, rejects=True), REJECTED)
    return bad.withColumnRenamed("column", "column_name")


def q_scan_accounting(spark, sf):
    """Orders delivered as one text per edition in which some records lack their
    last fields (keys divisible by 19), some have fields too many (23) and some
    course keys hold a letter (17); what the landing write counted per file."""
    path, names = scratch_path(spark, "ragged"), [c for c, _ in ORDERS_SEL_TYPES]
    key, o = F.col("o_orderkey"), table(spark, sf, "orders")
    course = F.concat(F.col("o_custkey").cast("string"), F.when(key % 17 == 0, F.lit("O")).otherwise(F.lit("")))
    start, rest = F.concat_ws(";", "o_orderkey", course), F.concat_ws(";", "o_orderstatus", F.col("o_totalprice").cast("string"))
    line = (F.when(key % 23 == 0, F.concat_ws(";", start, rest, F.lit('"a;b"'), F.lit("c")))
            .when(key % 19 == 0, start).otherwise(F.concat_ws(";", start, rest)))
    # lines as they are: one column named like the header, written with a separator that occurs nowhere
    (o.select(line.alias(";".join(names)), edition().alias("edition")).write.partitionBy("edition").option("header", True)
     .option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0002").option("encoding", LATIN1).csv(path))
    editions = sorted(r[0] for r in o.select(edition()).distinct().collect())
    files = {f"edition={e}": read_delimited(spark, f"{path}/edition={e}", ORDERS_SEL_TYPES, rejects=True) for e in editions}
    counts = land_counted(files, lambda df: write_mart(df, scratch_path(spark, "ragged_landed")))
    return spark.createDataFrame([(f, *(n[c] for c in COUNTS)) for f, n in counts.items()],
                                 "file_name string, " + ", ".join(f"{c} long" for c in COUNTS))


def q_union_marts(spark, sf):
    """CSV marts of two run dates and two relations; the union of one relation on
    the later date, typed."""
    from edumart.plans.marts import union_csv_marts
    root = scratch_path(spark, "csv_marts")
    o = table(spark, sf, "orders").select(*[c for c, _ in ORDERS_SEL_TYPES], edition().alias("edition"))
    for day, rows in (("2024-02-15", o.filter(F.col("o_orderstatus") == "F")), ("2024-02-16", o)):
        write_mart(rows, f"{root}/date={day}/orders_mart", fmt="csv", partition_by=["edition"])
    write_mart(table(spark, sf, "customer"), f"{root}/date=2024-02-16/customer_mart", fmt="csv")
    return union_csv_marts(spark, root, "orders", "2024-02-16", routes=(("orders_mart", "orders"), ("customer_mart", "customer")),
                           types={**dict(ORDERS_SEL_TYPES), "edition": "int"})


def q_na_tokens(spark, sf):
    path = scratch_path(spark, "na_tokens")
    o = table(spark, sf, "orders")
    raw = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("NA"))
                   .otherwise(F.col("o_orderstatus")).alias("status"))
    write_delimited(raw, path)
    return read_delimited(spark, path, [("o_orderkey", "bigint"), ("status", "string")])


def q_manifest_missing(spark, sf):
    """Every manifest entry: present or absent, and its rows."""
    manifest = spark.createDataFrame(
        [("orders", "orders.parquet"), ("lineitem", "lineitem.parquet"),
         ("absent", "absent.parquet")], "relation string, file_name string")
    absent = manifest_report(spark, manifest, sf, glob="*.parquet").select("file_name", F.lit(False).alias("here"))
    scan = spark.read.schema("_probe int").option("pathGlobFilter", "*.parquet").parquet(sf)
    rows = scan.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("n"))
    out = manifest.join(absent, "file_name", "left").join(rows, "file_name", "left")
    present = F.coalesce("here", F.lit(True))
    return out.select("relation", "file_name", present.alias("present"),
                      F.when(present, F.coalesce("n", F.lit(0))).alias("n"))


def q_route_by_filename(spark, sf):
    # routing needs file names and row counts only: a declared one-column
    # schema skips schema inference across unrelated tables
    scan = spark.read.schema("_probe int").option("pathGlobFilter", "*.parquet").parquet(sf)
    routed = route_by_filename(scan, [("customer", "customer"), ("orders", "orders")],
                               suffix=".parquet")
    return routed.groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def q_layer_partition_prune(spark, sf):
    path = scratch_path(spark, "by_edition")
    o = table(spark, sf, "orders").select("o_orderkey", edition().alias("edition"))
    write_mart(o, path, partition_by=("edition",))
    return spark.read.parquet(path).filter(F.col("edition") == 1997).select("o_orderkey", "edition")


def q_landing_stream(spark, sf):
    """Stream-land the orders file into the bronze layer (AvailableNow), then
    read what landed."""
    from edumart.streaming import land, parquet_stream
    stream = parquet_stream(spark, sf, TABLE_SCHEMAS["orders"], glob="orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", edition().alias("edition"))
    lake = scratch_path(spark, "stream_lake")
    land(stream, lake, "orders", "2024-02-16", checkpoint=scratch_path(spark, "stream_ckpt")) \
        .awaitTermination()
    return spark.read.parquet(f"{lake}/bronze/orders").select(*[c for c, _ in ORDERS_SEL_TYPES])


# ---------------------------------------------------------------- projection / scalar

def q_project_registry(spark, sf):
    return project(table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


def q_fill_missing_category(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", fill_category(status_answer()).alias("status"))


def q_fill_zero_scores(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", injected_score().alias("score"))
    return mean_scores(o, ["o_custkey"], ["score"], zero_fill=True)


def q_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     round_half_even(F.col("l_extendedprice") * 1.5, 2).alias("v"))


def _nation_names(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", "n_name")


def q_join_suffixed(spark, sf):
    n = _nation_names(spark, sf)
    return join_suffixed(n, n, "n_nationkey", how="inner")


def q_drop_by_pattern(spark, sf):
    return drop_like(q_join_suffixed(spark, sf), "_y")


def q_move_column_first(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", edition().alias("edition"))
    return move_first(o, "edition")


def q_group_drops_null_key(spark, sf):
    o = table(spark, sf, "orders").select(status_answer().alias("status"))
    return drop_null_keys(o, "status").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- joins

def _nation_dim(spark, sf, key="c_nationkey", gaps=False):
    n = table(spark, sf, "nation")
    if gaps:
        n = n.filter(F.col("n_nationkey") % 7 != 0)
    return n.select(F.col("n_nationkey").alias(key), "n_name")


def q_registry_inner(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return enrich(c, _nation_dim(spark, sf), "c_nationkey", how="inner")


def q_course_left_enrich(spark, sf):
    s = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    reg = registered(table(spark, sf, "customer")).select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return enrich(s, reg, "o_custkey", how="left")


def q_institution_left_enrich(spark, sf):
    g = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return enrich(g, _nation_dim(spark, sf, gaps=True), "c_nationkey", how="left")


def q_null_safe_join(spark, sf):
    o = table(spark, sf, "orders").select(status_answer().alias("k"), "o_custkey")
    a = o.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    b = o.groupBy("k").agg(F.countDistinct("o_custkey").alias("m"))
    return null_safe_join(a, b, "k")


# ---------------------------------------------------------------- aggregations

def _course_scores(spark, sf, injected=False, zero_fill=False):
    score = injected_score() if injected else F.col("o_totalprice")
    o = table(spark, sf, "orders").select("o_custkey", score.alias("score"))
    return mean_scores(o, ["o_custkey"], ["score"], zero_fill=zero_fill)


def q_course_score_mean(spark, sf):
    return _course_scores(spark, sf)


def q_course_age_stats(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    return value_stats(li, ["l_orderkey"], "l_quantity", AGE_NAMES, round_places=4)


def q_value_stats_continuous(spark, sf):
    """Prices per supplier, where a third of all rows belong to supplier 0."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).alias("supplier"), "l_extendedprice")
    return value_stats_continuous(li, ["supplier"], "l_extendedprice", ("mean_price", "median_price", "std_price"), round_places=3)


STATUS_CELLS = [("F", "st_F"), ("O", "st_O"), ("N", "st_N")]
# Display labels of the analogue status question, code order.
STATUS_LABELS = {"F": "status_final", "O": "status_open", "N": "status_not_answered"}


def q_crosstab_count(spark, sf):
    o = table(spark, sf, "orders")
    return crosstab(o, ["o_custkey"], fill_category(status_answer()), STATUS_CELLS,
                    counted="o_orderkey")


def q_crosstab_labelled(spark, sf):
    o = table(spark, sf, "orders")
    return crosstab(o, ["o_custkey"], fill_category(status_answer()),
                    list(STATUS_LABELS.items()), counted="o_orderkey")


def q_crosstab_missing_code(spark, sf):
    o = table(spark, sf, "orders")
    return crosstab(o, ["o_custkey"], "o_orderstatus", [("F", "st_f"), ("O", "st_o"), ("P", "st_p"), ("X", "st_x")])


#: by position in the order of the codes found
PRIORITY_LABELS = ["urgent", "high", "medium", "not_specified", "low"]


def q_crosstab_discovered(spark, sf):
    return crosstab_discovered(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", PRIORITY_LABELS, counted="o_orderkey")


def _course_to_nation(spark, sf, gaps=True):
    c = table(spark, sf, "customer")
    c = registered(c) if gaps else c
    return c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")


def _status_counts(spark, sf, keys=("o_custkey",)):
    o = table(spark, sf, "orders")
    if "edition" in keys:
        o = o.withColumn("edition", edition())
    return count_long(answers_long(o, list(keys), status_answer(), "status"), list(keys))


def q_institution_count_rollup(spark, sf):
    up = rollup(_status_counts(spark, sf), _course_to_nation(spark, sf), "o_custkey", "c_nationkey")
    cells = [("status", "F", "st_f"), ("status", "O", "st_o"), ("status", "N", "st_n")]
    return widen(up, ["c_nationkey"], cells)


def q_institution_score_mean(spark, sf):
    return mean_of_means(_course_scores(spark, sf), _course_to_nation(spark, sf),
                         "o_custkey", "c_nationkey", ["score"])


def q_institution_age_stats(spark, sf):
    k = value_stats(ages(spark, sf), ["o_custkey"], "l_quantity", AGE_NAMES)
    inst = avg_of_stats(k, _course_to_nation(spark, sf, gaps=False), "o_custkey",
                        "c_nationkey", AGE_NAMES)
    return round4(inst, AGE_NAMES)


def q_dedupe_keep_first(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return dedupe_first(e, "user_id", order="event_id", keep_order_col=True)


# ---------------------------------------------------------------- order / set / checks

def q_sorted_scores(spark, sf):
    t = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max(injected_score()).alias("t"))
    return with_position(t, desc_nulls_last_order("t", ["o_custkey"]), "pos")


def q_union_editions(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"))
    return union_editions([c, s])


PRIORITY_DOMAIN = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def q_domain_violations(spark, sf):
    return domain_violations(table(spark, sf, "orders"), "o_orderpriority", PRIORITY_DOMAIN)


def q_duplicate_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "events"), "user_id")


# ---------------------------------------------------------------- marts

STATUSES = {"F": "st_f", "O": "st_o", "N": "st_n"}
PRIORITIES = {"1-URGENT": "pr_1", "2-HIGH": "pr_2", "3-MEDIUM": "pr_3", "4-NOT SPECIFIED": "pr_4", "5-LOW": "pr_5"}
MART_CELLS = [("status", c, n) for c, n in STATUSES.items()] + [("priority", c, n) for c, n in PRIORITIES.items()]
CELL_NAMES = [n for _, _, n in MART_CELLS]


def _mart_cells():
    """(code column, code, name) cells of the analogue marts: every code of the
    status item (P read as not answered) and of the priority item."""
    status = fill_category(status_answer())
    return [(status, c, n) for c, n in STATUSES.items()] + [(F.col("o_orderpriority"), c, n) for c, n in PRIORITIES.items()]


def _mart_profile(spark, sf, keys):
    o = table(spark, sf, "orders").withColumns({"course": F.col("o_custkey"), "edition": edition()})
    return profile(o, keys, means=[("score", injected_score())], cells=_mart_cells(), zero_fill=True)


def _mart_ages(spark, sf, keys):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    rows = o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(
        edition().alias("edition"), o["o_custkey"].alias("course"), li["l_quantity"])
    return value_stats(rows.select(*keys, "l_quantity"), keys, "l_quantity", AGE_NAMES)


def _mart_registry(spark, sf):
    return join_suffixed(registered(table(spark, sf, "customer")).select(
        F.col("c_custkey").alias("course"), "c_mktsegment", "c_nationkey"), _nation_dim(spark, sf), "c_nationkey", how="inner")


def _courses_mart(spark, sf, keys):
    mart = chain_left(enrich(_mart_profile(spark, sf, keys), _mart_registry(spark, sf), "course", how="left"),
                      [round4(_mart_ages(spark, sf, keys), AGE_NAMES)], keys)
    return mart.select(*keys, "score", "c_nationkey", "n_name", "c_mktsegment", *CELL_NAMES, *AGE_NAMES)


def _institutions_mart(spark, sf, keys):
    """Raw rows are aggregated per course first; scores, counts and ages then
    roll up through the registry on course rows."""
    reg = registered(table(spark, sf, "customer")).select(F.col("c_custkey").alias("course"), "c_nationkey")
    to = [*keys, "c_nationkey"]
    prof = _mart_profile(spark, sf, [*keys, "course"]).join(reg, "course").groupBy(*to).agg(
        round_half_even(exact_mean("score")).alias("score"), *[F.sum(n).alias(n) for n in CELL_NAMES])
    age = _mart_ages(spark, sf, [*keys, "course"]).join(reg, "course").groupBy(*to).agg(
        *[F.avg(n).alias(n) for n in AGE_NAMES])
    mart = enrich(chain_left(prof, [round4(age, AGE_NAMES)], to), _nation_dim(spark, sf), "c_nationkey", how="left")
    return mart.select(*keys, "c_nationkey", "n_name", "score", *CELL_NAMES, *AGE_NAMES)


def q_course_mart(spark, sf):
    return _courses_mart(spark, sf, ["course"])


def q_course_mart_long(spark, sf):
    """The same mart through the per-item long form (the plan used for
    extracts split into one file per item)."""
    scored = table(spark, sf, "orders").select(F.col("o_custkey").alias("course"),
                                               injected_score().alias("score"))
    scores = mean_scores(scored, ["course"], ["score"], zero_fill=True)
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "course")
    answers = union_editions([
        answers_long(o, ["course"], status_answer(), "status"),
        answers_long(o, ["course"], "o_orderpriority", "priority"),
    ])
    counts = widen(count_long(answers, ["course"]), ["course"], MART_CELLS)
    age = value_stats(ages(spark, sf, "course"), ["course"], "l_quantity", AGE_NAMES,
                      round_places=4)
    reg = join_suffixed(
        registered(table(spark, sf, "customer")).select(
            F.col("c_custkey").alias("course"), "c_mktsegment", "c_nationkey"),
        _nation_dim(spark, sf), "c_nationkey", how="inner")
    mart = chain_left(enrich(scores, reg, "course", how="left"), [counts, age], "course")
    return mart.select("course", "score", "c_nationkey", "n_name", "c_mktsegment",
                       *CELL_NAMES, *AGE_NAMES)


def q_institution_mart(spark, sf):
    return _institutions_mart(spark, sf, [])


def q_all_editions_mart(spark, sf):
    return _courses_mart(spark, sf, ["edition", "course"])


def q_all_editions_institution_mart(spark, sf):
    return _institutions_mart(spark, sf, ["edition"])


def _delivered(spark, sf, where: Column):
    """Respondent rows of the analogue marts as two relations, by edition."""
    o = table(spark, sf, "orders").withColumns({"course": F.col("o_custkey"), "edition": edition()}).filter(where)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    facts = o.select("edition", "course", injected_score().alias("score"), status_answer().alias("status"),
                     F.col("o_orderpriority").alias("priority"))
    return facts, o.join(li, o["o_orderkey"] == li["l_orderkey"]).select("edition", "course", "l_quantity")


def _analogue_states(facts: DataFrame, ages_: DataFrame) -> DataFrame:
    keys = ["edition", "course", FILE]
    facts, ages_ = (d.withColumn(FILE, F.concat(F.lit(n), F.col("edition").cast("string")))
                    for n, d in (("facts-", facts), ("ages-", ages_)))
    answers = union_editions([answers_long(facts, keys, F.col(c), c) for c in ("status", "priority")])
    return union_editions([score_state(facts, keys, ["score"]), answer_state(count_long(answers, keys), keys),
                           level_state(ages_, keys, "l_quantity")])


def _analogue_mart(states: DataFrame) -> DataFrame:
    keys = ["edition", "course"]
    return chain_left(merged_scores(states, keys, ["score"]), [
        widen(merged_counts(states, keys, "string"), keys, MART_CELLS),
        merged_levels(states, keys, AGE_NAMES, round_places=4)], keys)


def q_mart_incremental(spark, sf):
    """A first delivery holds an outdated file pair for edition 1997 (one third of
    its rows, other scores); the second one brings only the right pair. The
    states of 1997 are computed from the new files alone and replace the old
    ones; only the mart part of 1997 is built again."""
    lake = scratch_path(spark, "incremental")
    states, marts = f"{lake}/states", f"{lake}/mart"
    late = edition() == 1997
    n_rows = sum(table(spark, sf, t).count() for t in ("orders", "lineitem"))

    def bring(folder: str, where: Column, shift: int) -> None:
        for rows, name in zip(_delivered(spark, sf, where), ("facts", "ages")):
            if shift and name == "facts":
                rows = rows.withColumn("score", F.when(F.col("edition") == 1997, F.col("score") + shift).otherwise(F.col("score")))
            write_mart(rows, f"{lake}/{folder}/{name}", partition_by=["edition"])

    def deliver(folder: str) -> Snapshot:
        facts, ages_ = (spark.read.parquet(f"{lake}/{folder}/{n}") for n in ("facts", "ages"))
        editions = sorted(r.edition for r in facts.select("edition").distinct().collect())
        files = {f"{n}-{e}": {"delivery": folder} for n in ("facts", "ages") for e in editions}
        landed = land(spark, _analogue_states(facts, ages_), states, resolve(spark, states), Delivery(changed=files))
        base = resolve(spark, marts)
        mart = _analogue_mart(read_snapshot(spark, states, landed, list(files)))
        return commit(spark, marts, base, write_runs(mart, marts, F.col("edition").cast("string"), [str(e) for e in editions]))

    with sized(spark, n_rows):
        bring("first", ~late | (F.col("o_orderkey") % 3 == 0), 100)
        bring("second", late, 0)
        deliver("first")
        mart = read_snapshot(spark, marts, deliver("second"))
        mart = enrich(mart, _mart_registry(spark, sf), "course", how="left")
        mart = mart.select("edition", "course", "score", "c_nationkey", "n_name", "c_mktsegment", *CELL_NAMES, *AGE_NAMES)
        return spark.read.schema(mart.schema).parquet(write_mart(mart, f"{lake}/enriched"))


def q_snapshot_read(spark, sf):
    """What three readers see of one day's table: one that resolved it before a
    rerun, one that came while the rerun was written and not yet committed, and
    one after the commit. A run that was never committed is seen by none."""
    lake = f"{scratch_path(spark, 'snapshots')}/orders"
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = run_atomic(o.filter(F.col("o_orderkey") % 2 == 0), lake, "2024-02-16")
    before = read_snapshot(spark, lake, first)
    write_run(o.limit(0), lake, "2024-02-16")                          # killed before its commit
    base = resolve(spark, lake)
    rerun = write_run(o, lake, "2024-02-16")
    during = read_snapshot(spark, lake)
    commit(spark, lake, base, rerun)
    after = read_snapshot(spark, lake)
    return union_editions([d.withColumn("reader", F.lit(n)) for n, d in (("before", before), ("during", during), ("after", after))])


QUERIES = {
    "mart_incremental": q_mart_incremental,
    "snapshot_read": q_snapshot_read,
    "scan_accounting": q_scan_accounting,
    "scan_delimited": q_scan_delimited,
    "scan_mart": q_scan_mart,
    "sink_roundtrip": q_sink_roundtrip,
    "layer_publish": q_layer_publish,
    "layer_rerun": q_layer_rerun,
    "scan_rejects": q_scan_rejects,
    "union_marts": q_union_marts,
    "na_tokens": q_na_tokens,
    "manifest_missing": q_manifest_missing,
    "route_by_filename": q_route_by_filename,
    "layer_partition_prune": q_layer_partition_prune,
    "landing_stream": q_landing_stream,
    "project_registry": q_project_registry,
    "fill_missing_category": q_fill_missing_category,
    "fill_zero_scores": q_fill_zero_scores,
    "round_half_even": q_round_half_even,
    "join_suffixed": q_join_suffixed,
    "drop_by_pattern": q_drop_by_pattern,
    "move_column_first": q_move_column_first,
    "group_drops_null_key": q_group_drops_null_key,
    "registry_inner": q_registry_inner,
    "course_left_enrich": q_course_left_enrich,
    "institution_left_enrich": q_institution_left_enrich,
    "null_safe_join": q_null_safe_join,
    "course_score_mean": q_course_score_mean,
    "course_age_stats": q_course_age_stats,
    "value_stats_continuous": q_value_stats_continuous,
    "crosstab_count": q_crosstab_count,
    "crosstab_labelled": q_crosstab_labelled,
    "crosstab_missing_code": q_crosstab_missing_code,
    "crosstab_discovered": q_crosstab_discovered,
    "institution_count_rollup": q_institution_count_rollup,
    "institution_score_mean": q_institution_score_mean,
    "institution_age_stats": q_institution_age_stats,
    "dedupe_keep_first": q_dedupe_keep_first,
    "sorted_scores": q_sorted_scores,
    "union_editions": q_union_editions,
    "domain_violations": q_domain_violations,
    "duplicate_keys": q_duplicate_keys,
    "course_mart": q_course_mart,
    "course_mart_long": q_course_mart_long,
    "institution_mart": q_institution_mart,
    "all_editions_mart": q_all_editions_mart,
    "all_editions_institution_mart": q_all_editions_institution_mart,
}
