"""Physical-plan checks: pruning, pushdown, exchange count, broadcast."""

from pyspark.sql import functions as F

from edumart.operators import answers_long, count_long, enrich, union_editions
from edumart.plans import analogues as A

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_projection_reaches_scan(spark):
    plan = _formatted(A.q_project_registry(spark, SF))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string>" in plan


def test_long_form_counts_one_exchange(spark):
    o = A.table(spark, SF, "orders").withColumnRenamed("o_custkey", "course")
    long = union_editions([answers_long(o, ["course"], A.status_answer(), "status"),
                           answers_long(o, ["course"], "o_orderpriority", "priority")])
    plan = _formatted(count_long(long, ["course"]))
    import re
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan
    # only the needed columns are read
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_partition_filter_prunes(spark):
    plan = _formatted(A.q_layer_partition_prune(spark, SF))
    assert "PartitionFilters: [isnotnull(edition" in plan and "(edition#" in plan


def test_institution_mart_aggregates_before_its_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = A.q_institution_mart(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    raw = [x for x in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in x]
    assert not raw, raw


def test_value_stats_stays_in_hash_aggregates(spark):
    plan = _formatted(A.q_course_age_stats(spark, SF))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
