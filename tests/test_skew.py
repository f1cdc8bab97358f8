"""A key that fills a third of the rows is split between tasks, and results stay whole."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratamart.operators.quality import flag_orphans
from stratamart.operators.temporal import as_of_join, point_in_time_join

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds at which small test data counts as skewed, and no broadcast joins."""
    before = {key: spark.conf.get(key, None) for key in SMALL_SKEW}
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def facts(spark):
    """60,000 facts; key 7 holds a third of them."""
    return spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("k"),
        F.expr("date_add(date'2024-01-01', cast(id % 300 as int))").alias("at"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_in_point_in_time_join(spark, facts, small_skew):
    versions = spark.range(5000).select(
        F.col("id").cast("int").alias("k"),
        F.explode(
            F.expr(
                "array(named_struct('start', timestamp'2024-01-01', 'end', timestamp'2024-06-01', 'sk', id * 2), "
                "named_struct('start', timestamp'2024-06-01', 'end', cast(null as timestamp), 'sk', id * 2 + 1))"
            )
        ).alias("v"),
    ).select("k", "v.*")
    joined = point_in_time_join(facts, versions, "k", "at", ["sk"], "start", "end")
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan
    wrong = joined.filter(F.col("sk") != F.col("k") * 2 + (F.col("at") >= F.lit(date(2024, 6, 1))).cast("int"))
    assert joined.count() == 60_000 and wrong.count() == 0 and joined.filter("sk is null").count() == 0


def test_hot_orphan_in_reference_check(spark, facts, small_skew):
    reference = spark.range(5000).filter("id % 2 = 0").select(F.col("id").cast("int").alias("id"))
    flagged = flag_orphans(facts, "k", reference, "id", "orphan", max_broadcast_rows=0)
    assert "skew=true" in final_plan(flagged)
    assert flagged.filter("orphan <> (k % 2 = 1)").count() == 0 and flagged.count() == 60_000


def test_hot_currency_in_as_of_join(spark, facts, small_skew):
    series = spark.range(300).select(
        F.lit(7).alias("c"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("on"), F.col("id").alias("rate")
    )
    joined = as_of_join(facts, series, {"k": "c"}, "at", "on", ["rate"], max_broadcast_rows=0)
    final_plan(joined)
    assert joined.filter("k = 7 and rate <> n % 300").count() == 0
    assert joined.filter("k <> 7 and rate is not null").count() == 0 and joined.count() == 60_000
