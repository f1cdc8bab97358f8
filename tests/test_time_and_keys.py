import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stratamart.operators.keys import dense_surrogate_key
from stratamart.operators.temporal import as_of_join, current_version_join, point_in_time_join, spans_overlap

DAY = date(2024, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_as_of_agrees_with_a_scan(spark, rows, bound):
    draw = random.Random(3)
    points = {(c, day(draw.randrange(5, 60))): draw.randrange(1000) for c in "AAB" for _ in range(12)}
    points[("C", day(0))] = None
    facts = [(n, draw.choice(["A", "A", "A", "B", "C", "D", None]), day(draw.randrange(0, 90))) for n in range(300)]

    def answer(key, at):
        earlier = [d for (k, d) in points if k == key and d <= at]
        return points[(key, max(earlier))] if earlier else None

    series = spark.createDataFrame([(k, d, v) for (k, d), v in points.items()], "cur string, on date, rate int")
    df = spark.createDataFrame(facts, "n int, currency string, at date")
    out = as_of_join(df, series, {"currency": "cur"}, "at", "on", ["rate"], bound)
    assert out.columns == ["n", "currency", "at", "rate"]
    assert rows(out, "n", "rate") == sorted(((n, answer(k, at)) for n, k, at in facts), key=repr)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_as_of_on_or_before_and_empty_series(spark, rows, bound):
    df = spark.createDataFrame([(1, "A", day(3)), (2, "A", day(2)), (3, "A", None)], "n int, c string, at date")
    series = spark.createDataFrame([("A", day(3), 7)], "c2 string, on date, rate int")
    assert rows(as_of_join(df, series, {"c": "c2"}, "at", "on", ["rate"], bound), "n", "rate") == [(1, 7), (2, None), (3, None)]
    empty = as_of_join(df, series.filter("false"), {"c": "c2"}, "at", "on", ["rate"], bound)
    assert rows(empty, "n", "rate") == [(1, None), (2, None), (3, None)]


VERSIONS = "k int, sk int, start timestamp, end timestamp"


def pit(df, versions):
    return point_in_time_join(df, versions, "k", "at", ["sk"], "start", "end")


def test_point_in_time(spark, rows):
    versions = spark.sql(
        "select * from values (1, 10, timestamp'2024-01-02 08:00:00', timestamp'2024-01-05 09:00:00'), "
        "(1, 11, timestamp'2024-01-05 09:00:00', timestamp'2024-01-05 17:00:00'), "
        "(1, 12, timestamp'2024-01-05 17:00:00', null) as t(k, sk, start, end)"
    )
    df = spark.createDataFrame([(n, 1, day(n)) for n in range(7)] + [(9, 2, day(3))], "n int, k int, at date")
    assert rows(pit(df, versions), "n", "sk") == [(0, None), (1, 10), (2, 10), (3, 10), (4, 12), (5, 12), (6, 12), (9, None)]


def test_point_in_time_takes_the_latest_start_of_overlapping_spans(spark, rows):
    versions = spark.createDataFrame(
        [(1, 10, day(0), None), (1, 11, day(3), day(5)), (1, 12, day(3), day(3))], "k int, sk int, start date, end date"
    )
    assert spans_overlap(versions.selectExpr("k", "start as _from", "end as _to"), ["k"])
    df = spark.createDataFrame([(n, 1, day(n)) for n in range(7)], "n int, k int, at date")
    assert rows(pit(df, versions), "n", "sk") == [(0, 10), (1, 10), (2, 10), (3, 11), (4, 11), (5, 10), (6, 10)]


def test_overlaps_elsewhere_do_not_touch_repeated_facts(spark, rows):
    versions = spark.createDataFrame(
        [(1, 10, day(0), None), (1, 11, day(2), day(4)), (2, 20, day(0), day(3)), (2, 21, day(3), None)],
        "k int, sk int, start date, end date",
    )
    df = spark.createDataFrame([(1, 2, day(1)), (1, 2, day(1)), (1, 2, day(3)), (5, 1, day(3)), (5, 1, day(3)), (6, 1, None)], "n int, k int, at date")
    assert rows(pit(df, versions), "n", "sk") == [(1, 20), (1, 20), (1, 21), (5, 11), (5, 11), (6, None)]


def test_overlapping_spans_agree_with_a_scan(spark, rows):
    draw = random.Random(8)
    spans = []
    for n in range(60):
        begin = draw.randrange(20)
        spans.append((n % 4, n, day(begin), draw.choice([None, day(begin + draw.randrange(8))])))
    facts = [(n, n % 5, day(draw.randrange(30))) for n in range(200)]

    def answer(k, at):
        held = [(-(a - DAY).days, sk) for key, sk, a, b in spans if key == k and a <= at and (b is None or at < b)]
        return min(held)[1] if held else None

    versions = spark.createDataFrame(spans, "k int, sk int, start date, end date")
    df = spark.createDataFrame(facts, "n int, k int, at date")
    assert rows(pit(df, versions), "n", "sk") == sorted(((n, answer(k, at)) for n, k, at in facts), key=repr)


def test_spans_that_touch_do_not_overlap(spark):
    spans = spark.createDataFrame([(1, day(0), day(3)), (1, day(3), None), (2, day(1), None)], "k int, _from date, _to date")
    assert not spans_overlap(spans, ["k"])


def test_current_version(spark, rows):
    versions = spark.createDataFrame([(1, 10, False), (1, 11, True)], "k int, sk int, _SCD_IsCurrent boolean")
    df = spark.createDataFrame([(1, 1), (2, 5)], "n int, k int")
    assert rows(current_version_join(df, versions, "k", ["sk"]), "n", "sk") == [(1, 11), (2, None)]


def test_keys_are_dense_and_ordered_over_many_partitions(spark, without_coalescing):
    # One customer holds a third of all versions.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("c"), "id").repartition(5)
    out = dense_surrogate_key(df, ["c", "id"], "sk")
    found = [(r.sk, r.c, r.id) for r in out.collect()]
    assert sorted(found) == [(n + 1, c, i) for n, (c, i) in enumerate(sorted((c, i) for _, c, i in found))]
    assert dict(out.dtypes)["sk"] == "int" and out.columns[0] == "sk"


def test_keys_of_no_rows(spark):
    assert dense_surrogate_key(spark.range(0), ["id"], "sk").count() == 0


@pytest.mark.parametrize("days", [None, 1, 7, 400])
@pytest.mark.parametrize("mark", [None, True])
def test_point_in_time_agrees_with_a_scan(spark, rows, days, mark):
    """Spans of a hot key with many versions, gaps, open ends and overlaps, by key alone and by key and period."""
    draw = random.Random(5)
    versions = [(1 if n % 3 else n % 4, n, day(a), None if n % 11 == 0 else day(a + draw.randrange(0, 25))) for n in range(60) for a in [draw.randrange(-400, 400)]]
    facts = [(n, draw.choice([1, 1, 1, 0, 2, 9, None]), day(draw.randrange(-500, 900))) for n in range(400)] + [(999, 1, None)]

    def answer(key, at):
        held = [(start, -sk) for k, sk, start, end in versions if at is not None and k == key and start <= at and (end is None or at < end)]
        return -max(held)[1] if held else None

    df = spark.createDataFrame(facts, "n int, k int, at date")
    history = spark.createDataFrame(versions, "k int, sk int, start date, end date")
    out = point_in_time_join(df, history, "k", "at", ["sk"], "start", "end", may_overlap=mark, period_days=days)
    assert out.columns == ["n", "k", "at", "sk"]
    assert rows(out, "n", "sk") == sorted(((n, answer(k, at)) for n, k, at in facts), key=repr)
    empty = point_in_time_join(df, history.filter("false"), "k", "at", ["sk"], "start", "end", may_overlap=mark, period_days=days)
    assert {r["sk"] for r in empty.collect()} == {None} and empty.count() == len(facts)


def jobs_of(spark, build):
    """Jobs that run while ``build`` plans."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        out = build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(tracker.getJobIdsForGroup("planning"))


def test_a_marked_history_joins_without_a_job(spark):
    df = spark.createDataFrame([(1, 1, day(3))], "n int, k int, at date")
    history = spark.createDataFrame([(1, 10, day(0), None)], "k int, sk int, start date, end date")
    _, before = jobs_of(spark, lambda: 0)
    out, after = jobs_of(spark, lambda: point_in_time_join(df, history, "k", "at", ["sk"], "start", "end", may_overlap=False))
    assert after == before and out.first()["sk"] == 10


def test_as_of_beyond_the_broadcast_reads_facts_once(spark, tmp_path, without_coalescing):
    spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'B', 'A') as c", "date_add(date'2024-01-01', cast(id % 900 as int)) as at").write.parquet(str(tmp_path / "f"))
    spark.range(1000).selectExpr("'A' as c2", "date_add(date'2024-01-01', cast(id as int)) as on", "id as rate").write.parquet(str(tmp_path / "s"))
    facts, series = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "s"))
    out = as_of_join(facts, series, {"c": "c2"}, "at", "on", ["rate"], 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/f") == 1
    assert out.filter("c = 'A' and rate != id % 900").count() == 0 and out.filter("c = 'B' and rate is not null").count() == 0
    # A key comes together with others only by its period: the rows of 'A' meet in many places.
    from stratamart.operators.temporal import _until_next, in_periods
    rows = series.selectExpr("c2 as _key0", "on as _from", "rate")
    ended = _until_next(rows, ["_key0"], 64)
    assert ended.filter("_to is null").count() == 1 and ended.filter("_to = date_add(_from, 1)").count() == 999
    assert in_periods(ended, 64, F.lit(400)).select("_period").distinct().count() >= 15


def test_numbers_come_from_files_in_order(spark):
    """Many files per task and many tasks: numbers follow the order."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        out = dense_surrogate_key(spark.range(1000).selectExpr("999 - id as v", "cast(id % 3 as string) as w").repartition(9), ["v"], "sk", "bigint")
        assert [(r["sk"], r["v"]) for r in out.orderBy("v").collect()] == [(n + 1, n) for n in range(1000)]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    plan = out.select("sk")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert dense_surrogate_key(spark.range(0), ["id"], "sk").count() == 0
