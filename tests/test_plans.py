"""Physical plans: what is pushed down, what is shuffled, and what never happens."""

import re

import pytest
from pyspark.sql import functions as F

from scoreloom.model import ALL_RULES
from scoreloom.operators.rules import apply_rules
from scoreloom.operators.scoring import with_profile
from scoreloom.plans import tables
from scoreloom.plans.catalog import QUERIES
from scoreloom.sources import star

JIT_LIMIT = 8000  # bytes of code above which the JVM leaves a generated method uncompiled


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As if every table were too large to broadcast on its own; explicit, bounded broadcasts stay."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_are_a_projection(spark, sf_dir):
    before = with_profile(tables.events(spark, sf_dir), tables.profiles(spark, sf_dir))
    after = apply_rules(before, ALL_RULES)
    assert plan(after).count("Exchange") == plan(before).count("Exchange")
    assert plan(after).count("Join") == plan(before).count("Join")


def test_record_families_scan_only(spark, sf_dir, no_broadcast):
    """A record family reads its columns of the scored table and shuffles nothing; only the carried table is sent out."""
    text = plan(QUERIES["b13_risk"](spark, sf_dir))
    assert "hashpartitioning" not in text and "SinglePartition" not in text
    assert text.count("BroadcastExchange") == 1
    schema = re.findall(r"ReadSchema: struct<(\S+)", text)[0]
    assert "payload" not in schema and "latitude" not in schema and "rule_scores" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["c06_point_query"](spark, sf_dir))
    assert "EqualTo(subject_id,7)" in text and "GreaterThanOrEqual(ts" in text
    assert "IsNotNull(user_id)" in plan(tables.events(spark, sf_dir).filter("subject_id = 1")) or "EqualTo(user_id" in plan(
        tables.events(spark, sf_dir).filter("subject_id = 1"))


@pytest.mark.parametrize("name", ["f01_f05_behaviour", "f15_f16_trend", "f17_f22_geography", "f23_f33_risk",
                                  "b13_trend", "b13_risk", "b13_geography", "g01_event_sums"])
def test_generated_methods_can_be_compiled(spark, sf_dir, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = QUERIES[name](spark, sf_dir).select("*")._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", execution.explainString(mode))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < JIT_LIMIT


def test_hot_subject_is_split_in_a_chain_of_joins(spark, sf_dir):
    """80 % of events on one subject, no broadcasts: the joins with customers and with profiles both split its partition."""
    from scoreloom.session import prepare

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        raw = star.table(prepare(spark), sf_dir, "events").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(60)))).withColumn(
            "user_id", F.when(F.col("event_id") % 5 < 4, F.lit(7)).otherwise(F.col("user_id"))).repartition(12, "copy", "event_id").drop("copy")
        df = with_profile(star.map_events(spark, sf_dir, raw), star.profiles(spark, sf_dir)).select(
            "event_id", "subject_type", "opening_score", "city")
        assert len(df.collect()) == 60_000
        assert df._jdf.queryExecution().executedPlan().toString().count("skew=true") >= 2
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_scored_table_is_shuffled_without_details(spark, sf_dir):
    """What the scored table is made from has no column that follows from others of its row."""
    from scoreloom.session import prepare

    base = star.source_events(prepare(spark), sf_dir)
    assert base.columns == list(star.BASE) and not set(star.DETAILS) - {"k"} & set(base.columns)
    pe = tables.processed(spark, sf_dir)
    assert set(star.events(spark, sf_dir).columns) <= set(pe.columns) and "raw_type" not in pe.columns
    assert "payload" not in re.findall(r"ReadSchema: struct<(\S+)", plan(pe))[0]
