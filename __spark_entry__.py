
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edumart.plans.analogues import QUERIES  # noqa: E402

try:
    from edumart.llm.queries import ORACLE_SQL as LLM_SQL  # noqa: E402
    from edumart.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as e:  # the subpackage is optional; its own faults are not hidden
    if e.name not in {"edumart.llm", "edumart.llm.queries", "corpus_pipeline"}:
        raise
    LLM_QUERIES, LLM_SQL = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the course mart on the sf0.001 driver tables."""
    return QUERIES["course_mart"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **LLM_QUERIES}


_ORDERS_SEL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"

_SCORE_ZERO = ("coalesce(round_even(sum(CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice::DECIMAL(18,2) END)::DOUBLE"
               " / nullif(count(CASE WHEN o_custkey % 11 <> 0 THEN 1 END), 0) * 100, 0) / 100, 0.0)")

_SQL = {
    "scan_delimited": _ORDERS_SEL,
    "scan_mart": _ORDERS_SEL,
    "sink_roundtrip": _ORDERS_SEL,
    "layer_publish": "SELECT 'orders' AS relation, year(o_orderdate)::INTEGER AS edition, o_orderkey AS id, o_totalprice AS amount FROM orders UNION ALL SELECT 'customer', NULL::INTEGER, c_custkey, c_acctbal FROM customer",
    "layer_rerun": "SELECT o_orderkey, year(o_orderdate)::INTEGER AS edition FROM orders WHERE year(o_orderdate) = 1997",
    "scan_rejects": "SELECT column_name, count(*) AS n FROM (SELECT 'o_custkey' AS column_name FROM orders WHERE o_orderkey % 17 = 0 UNION ALL SELECT 'o_totalprice' FROM orders WHERE o_orderkey % 13 = 0) GROUP BY 1",
    "union_marts": "SELECT year(o_orderdate)::INTEGER AS edition, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "landing_stream": _ORDERS_SEL,
    "na_tokens": "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders",
    "manifest_missing": "SELECT 'orders' AS relation, 'orders.parquet' AS file_name, true AS present, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', 'lineitem.parquet', true, count(*) FROM lineitem UNION ALL SELECT 'absent', 'absent.parquet', false, NULL::BIGINT",
    "route_by_filename": "SELECT 'customer' AS relation, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders",
    "layer_partition_prune": "SELECT o_orderkey, year(o_orderdate)::INTEGER AS edition FROM orders WHERE year(o_orderdate) = 1997",
    "project_registry": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "fill_missing_category": "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'N') AS status FROM orders",
    "fill_zero_scores": f"SELECT o_custkey, {_SCORE_ZERO} AS score FROM orders GROUP BY o_custkey",
    "round_half_even": "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_extendedprice * 1.5 * 100, 0) / 100 AS v FROM lineitem",
    "join_suffixed": "SELECT a.n_nationkey, a.n_name AS n_name_x, b.n_name AS n_name_y FROM nation a JOIN nation b ON a.n_nationkey = b.n_nationkey",
    "drop_by_pattern": "SELECT n_nationkey, n_name AS n_name_x FROM nation",
    "move_column_first": "SELECT year(o_orderdate)::INTEGER AS edition, o_orderkey, o_custkey FROM orders",
    "group_drops_null_key": "SELECT nullif(o_orderstatus, 'P') AS status, count(*) AS n FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL GROUP BY 1",
    "registry_inner": "SELECT c_custkey, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "course_left_enrich": "SELECT s.o_custkey, s.n, c.c_nationkey FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) s LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) c ON s.o_custkey = c.c_custkey",
    "institution_left_enrich": "SELECT g.c_nationkey, g.n, n.n_name FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) g LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 7 <> 0) n ON g.c_nationkey = n.n_nationkey",
    "null_safe_join": "SELECT a.k, a.n, b.m FROM (SELECT nullif(o_orderstatus, 'P') AS k, count(*) AS n FROM orders GROUP BY 1) a JOIN (SELECT nullif(o_orderstatus, 'P') AS k, count(DISTINCT o_custkey) AS m FROM orders GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k",
    "course_score_mean": "SELECT o_custkey, round_even(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) * 100, 0) / 100 AS score FROM orders GROUP BY o_custkey",
    "course_age_stats": "SELECT l_orderkey, round(avg(l_quantity), 4) AS mean_age, round(median(l_quantity), 4) AS median_age, round(stddev_samp(l_quantity), 4) AS std_age FROM lineitem GROUP BY l_orderkey",
    "crosstab_count": "SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS st_F, count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS st_O, count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS st_N FROM orders GROUP BY o_custkey",
    "crosstab_labelled": "SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS status_final, count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS status_open, count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS status_not_answered FROM orders GROUP BY o_custkey",
    "crosstab_missing_code": "SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS st_f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS st_o, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS st_p, count(CASE WHEN o_orderstatus = 'X' THEN 1 END) AS st_x FROM orders GROUP BY o_custkey",
    "crosstab_discovered": "SELECT o_custkey, " + ", ".join(
        f"count(CASE WHEN o_orderpriority = '{c}' THEN o_orderkey END) AS {n}" for c, n in [
            ("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"), ("4-NOT SPECIFIED", "not_specified"), ("5-LOW", "low")]
        ) + " FROM orders GROUP BY o_custkey",
    "institution_count_rollup": "SELECT c_nationkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS st_f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS st_o, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS st_n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0 GROUP BY c_nationkey",
    "institution_score_mean": "WITH k AS (SELECT o_custkey, round_even(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) * 100, 0) / 100 AS score FROM orders GROUP BY o_custkey) SELECT c_nationkey, round_even(sum(score::DECIMAL(18,2))::DOUBLE / count(score) * 100, 0) / 100 AS score FROM k JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 7 <> 0 GROUP BY c_nationkey",
    "institution_age_stats": "WITH k AS (SELECT o_custkey, avg(l_quantity) AS a, median(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey) SELECT c_nationkey, round(avg(a), 4) AS mean_age, round(avg(m), 4) AS median_age, round(avg(s), 4) AS std_age FROM k JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey",
    "dedupe_keep_first": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) e WHERE r = 1",
    "sorted_scores": "SELECT o_custkey, t, row_number() OVER (ORDER BY t DESC NULLS LAST, o_custkey)::BIGINT AS pos FROM (SELECT o_custkey, max(CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice END) AS t FROM orders GROUP BY o_custkey) q",
    "union_editions": "SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS seg, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL::VARCHAR, s_nationkey FROM supplier",
    "domain_violations": "SELECT o_orderpriority AS code, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 1",
    "duplicate_keys": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1",
}


_CELLS = [("o_orderstatus", "F", "st_f"), ("o_orderstatus", "O", "st_o"), ("o_orderstatus", "P", "st_n"),
          ("o_orderpriority", "1-URGENT", "pr_1"), ("o_orderpriority", "2-HIGH", "pr_2"),
          ("o_orderpriority", "3-MEDIUM", "pr_3"), ("o_orderpriority", "4-NOT SPECIFIED", "pr_4"),
          ("o_orderpriority", "5-LOW", "pr_5")]
_NAMES = ", ".join(n for _, _, n in _CELLS)


def _course_ctes(keys: str) -> str:
    cells = ", ".join(f"count(CASE WHEN {c} = '{v}' THEN 1 END) AS {n}" for c, v, n in _CELLS)
    return (f"WITH o AS (SELECT *, o_custkey AS course, year(o_orderdate)::INTEGER AS edition FROM orders), "
            f"pr AS (SELECT {keys}, {_SCORE_ZERO} AS score, {cells} FROM o GROUP BY {keys}), "
            f"ag AS (SELECT {keys}, avg(l_quantity) AS a, median(l_quantity) AS m, stddev_samp(l_quantity) AS s "
            f"FROM o JOIN lineitem ON o_orderkey = l_orderkey GROUP BY {keys}), "
            f"rg AS (SELECT c_custkey AS course, c_mktsegment, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0) ")


def _course_sql(keys: str) -> str:
    return (_course_ctes(keys) + f"SELECT {keys}, score, c_nationkey, n_name, c_mktsegment, {_NAMES}, round(a, 4) AS mean_age, "
            f"round(m, 4) AS median_age, round(s, 4) AS std_age FROM pr LEFT JOIN ag USING ({keys}) LEFT JOIN rg USING (course)")


def _institution_sql(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    sums = ", ".join(f"sum({n})::BIGINT AS {n}" for _, _, n in _CELLS)
    return (_course_ctes(f"{k}course") + f", pi AS (SELECT {k}c_nationkey, round_even(sum(score::DECIMAL(18,2))::DOUBLE / count(score) * 100, 0) / 100 AS score, "
            f"{sums} FROM pr JOIN rg USING (course) GROUP BY {k}c_nationkey), "
            f"ai AS (SELECT {k}c_nationkey, round(avg(a), 4) AS mean_age, round(avg(m), 4) AS median_age, round(avg(s), 4) AS std_age "
            f"FROM ag JOIN rg USING (course) GROUP BY {k}c_nationkey) "
            f"SELECT {k}c_nationkey, n_name, score, {_NAMES}, mean_age, median_age, std_age FROM pi LEFT JOIN ai USING ({k}c_nationkey) LEFT JOIN nation ON c_nationkey = n_nationkey")


_SQL["course_mart"] = _course_sql("course")
_SQL["all_editions_mart"] = _course_sql("edition, course")
_SQL["institution_mart"] = _institution_sql("")
_SQL["all_editions_institution_mart"] = _institution_sql("edition")
_SQL["course_mart_long"] = _SQL["course_mart"]
_SQL["mart_incremental"] = _SQL["all_editions_mart"]
_SQL["scan_accounting"] = ("SELECT 'edition=' || year(o_orderdate)::VARCHAR AS file_name, count(*) AS n_rows, "
                           "count_if(o_orderkey % 19 = 0 AND o_orderkey % 23 <> 0)::BIGINT AS n_short, count_if(o_orderkey % 23 = 0)::BIGINT AS n_long, "
                           "0::BIGINT AS n_broken, count_if(o_orderkey % 17 = 0)::BIGINT AS n_unreadable FROM orders GROUP BY 1")
_SQL["value_stats_continuous"] = ("SELECT supplier, round(sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(*), 3) AS mean_price, "
                                  "round(median(l_extendedprice), 3) AS median_price, round(stddev_samp(l_extendedprice), 3) AS std_price "
                                  "FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END::BIGINT AS supplier, l_extendedprice FROM lineitem) GROUP BY 1")
_SQL["snapshot_read"] = ("SELECT o_orderkey, o_totalprice, 'after' AS reader FROM orders UNION ALL "
                         "SELECT o_orderkey, o_totalprice, unnest(['before', 'during']) FROM orders WHERE o_orderkey % 2 = 0")


def oracle_sql() -> dict[str, str]:
    """Equivalent DuckDB SQL per query (views: region nation customer
    supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations)."""
    return {**_SQL, **LLM_SQL}
