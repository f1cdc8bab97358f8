"""Joins against rows that hold for a span of days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.names import IS_CURRENT, VALID_FROM, VALID_TO
from stratamart.operators.sizing import MAX_BROADCAST_ROWS


_EPOCH = date(1970, 1, 1)


def _covers(day: Column) -> Column:
    return (day >= F.col("_from")) & (F.col("_to").isNull() | (day < F.col("_to")))


def spans_overlap(spans: DataFrame, keys: Sequence[str]) -> bool:
    """Whether two spans ``[_from, _to)`` of one key share a day."""
    earlier = Window.partitionBy(*keys).orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.coalesce("_to", F.lit("9999-12-31").cast("date"))
    clash = spans.select(F.max(open_end).over(earlier).alias("_reach"), "_from").filter("_reach > _from")
    return not clash.isEmpty()


def disjoint_spans(spans: DataFrame, take: Sequence[str]) -> DataFrame:
    """Spans of which no two of one ``_key`` share a day; a day goes to the latest start, then the smallest ``take``.

    Spans that meet no other stay as they are. The others are cut at each other's ends,
    and each piece looks for its span among these few alone.
    """
    order = Window.partitionBy("_key").orderBy("_from", "_to")
    open_end = F.coalesce("_to", F.lit("9999-12-31").cast("date"))
    marked = spans.withColumns(
        {
            "_reach": F.max(open_end).over(order.rowsBetween(Window.unboundedPreceding, -1)),
            "_next": F.lead("_from").over(order),
        }
    )
    meets = F.coalesce(F.col("_reach") > F.col("_from"), F.lit(False)) | F.coalesce(F.col("_next") < open_end, F.lit(False))
    marked = marked.withColumn("_meets", meets).select("_key", "_from", "_to", *take, "_meets")
    clashing = marked.filter("_meets").drop("_meets")
    cuts = clashing.select("_key", F.explode(F.array("_from", "_to")).alias("_cut")).filter("_cut is not null").distinct()
    pieces = cuts.withColumn("_until", F.lead("_cut").over(Window.partitionBy("_key").orderBy("_cut")))
    held = pieces.join(clashing, "_key").filter(_covers(F.col("_cut")))
    best = F.min(F.struct((-F.unix_date("_from")).alias("_age"), *take)).alias("_best")
    won = held.groupBy("_key", "_cut", "_until").agg(best)
    won = won.select("_key", F.col("_cut").alias("_from"), F.col("_until").alias("_to"), *[F.col("_best")[c].alias(c) for c in take])
    return marked.filter(~F.col("_meets")).drop("_meets").unionByName(won)


def _period(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def in_periods(spans: DataFrame, days: int, last: Column) -> DataFrame:
    """Spans ``[_from, _to)`` repeated as ``_period`` for each period of ``days`` days that they touch, up to ``last``."""
    end = F.coalesce(_period(F.date_sub("_to", 1), days), last)
    periods = F.sequence(F.least(_period(F.col("_from"), days), last), F.least(end, last))
    return spans.filter("_from is not null").withColumn("_period", F.explode(periods))


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    may_overlap: bool | None = None,
    period_days: int | None = None,
) -> DataFrame:
    """Left join each fact to the version of its key that held on ``day``; every fact stays, once.

    Spans compare as dates and are half open; a span within one day never holds and is
    left out, so a key has at most one version per day to compare with. Spark broadcasts
    versions whose size is below its threshold; otherwise both sides are shuffled by key,
    where adaptive execution splits the facts of a hot key. Late changes can leave
    overlapping spans, which are made disjoint first: the latest start wins. Facts are
    never compared with each other, so repeated ones stay.

    ``may_overlap`` is the mark that history tables keep (``TableStore.may_overlap``).
    With it no job runs before the join; without it the versions are checked once. Give
    ``period_days`` where keys have many versions: both sides then meet by key and period
    of so many days, so a fact is compared with the versions of its period alone and the
    rows of one key spread over its periods.
    """
    spans = versions.select(
        F.col(key).alias("_key"),
        F.to_date(valid_from).alias("_from"),
        F.to_date(valid_to).alias("_to"),
        *take,
    ).filter("_to is null or _from < _to")
    if spans_overlap(spans, ["_key"]) if may_overlap is None else may_overlap:
        spans = disjoint_spans(spans, take)
    among = (F.col(key) == F.col("_key")) & _covers(F.col(day))
    if period_days is None:
        return facts.join(spans, among, "left").drop("_key", "_from", "_to")
    # After the last start and end only open spans hold, and they are in the last period too.
    last = versions.agg(F.max(F.greatest(F.to_date(valid_from), F.to_date(valid_to)))).first()[0]
    last = F.lit((last or _EPOCH).toordinal() - _EPOCH.toordinal()).cast("int")
    last = F.floor(last / period_days).cast("int")
    spread = in_periods(spans, period_days, last)
    asked = F.least(_period(F.col(day), period_days), last)
    return facts.join(spread, among & (asked == F.col("_period")), "left").drop("_key", "_from", "_to", "_period")


def current_version_join(facts: DataFrame, versions: DataFrame, key: str, take: Sequence[str]) -> DataFrame:
    """Left join each fact to the current version of its key."""
    return facts.join(versions.filter(IS_CURRENT).select(key, *take), key, "left")


def as_of_join(
    facts: DataFrame,
    series: DataFrame,
    on: Mapping[str, str],
    day: str,
    series_day: str,
    take: Sequence[str],
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    period_days: int = 64,
) -> DataFrame:
    """Left join each fact to the last row of its series on or before ``day``.

    ``on`` maps fact columns to series columns; days are dates, and ``series`` has one
    row per key and day. Both ways below join by equality, so a fact is compared with
    few rows however long its series is. If the days from each first row to the last row
    of all series fit the bound, every such day gets its row and is broadcast; later
    facts use the last day. Otherwise both sides meet by key and period of
    ``period_days`` days: each row of the series holds until the next one, whichever
    period that lies in, and is laid out in all periods between. Facts are read once, and
    neither they nor a series come together by key alone.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    rows = series.select(
        *[F.col(name).alias(k) for k, name in zip(keys, on.values())],
        F.col(series_day).cast("date").alias("_from"),
        *take,
    )
    last, starts, series_count = (
        rows.groupBy(*keys)
        .agg(F.min(F.unix_date("_from")).alias("first"), F.max("_from").alias("last"))
        .agg(F.max("last"), F.sum("first"), F.count("*"))
        .first()
    )
    same_key = [F.col(fact) == F.col(k) for fact, k in zip(on, keys)]
    if last is None or series_count * ((last - _EPOCH).days + 1) - starts <= max_broadcast_rows:
        answers = _every_day(rows, keys, last)
        end = F.lit(last).cast("date")
        asked = F.when(F.col(day) > end, end).otherwise(F.col(day))
        return facts.join(F.broadcast(answers), [*same_key, asked == F.col("_day")], "left").drop(*keys, "_day")
    spread = in_periods(_until_next(rows, keys, period_days), period_days, _period(F.lit(last).cast("date"), period_days))
    met = reduce(and_, same_key) & _covers(F.col(day))
    asked = F.least(_period(F.col(day), period_days), _period(F.lit(last).cast("date"), period_days))
    return facts.join(spread, met & (asked == F.col("_period")), "left").drop(*keys, "_from", "_to", "_period")


def _every_day(rows: DataFrame, keys: Sequence[str], last) -> DataFrame:
    """Series rows repeated for each day they hold, up to the last day of all series."""
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    until = F.date_sub(F.coalesce(following, F.date_add(F.lit(last).cast("date"), 1)), 1)
    spans = rows.withColumn("_until", until).filter("_until >= _from")
    return spans.withColumn("_day", F.explode(F.sequence("_from", "_until"))).drop("_from", "_until")


def _until_next(rows: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Series rows with ``_to``, the day of the next row of their key.

    The next row is looked for within a period; the last row of a period takes the first
    one of its key's next period with rows. Only these first rows, one per key and
    period, are ordered by key.
    """
    placed = rows.filter("_from is not null").withColumn("_period", _period(F.col("_from"), days))
    within = Window.partitionBy(*keys, "_period").orderBy("_from")
    borders = placed.groupBy(*keys, "_period").agg(F.min("_from").alias("_first"))
    borders = borders.select(*keys, "_period", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_period")).alias("_border"))
    ended = placed.withColumn("_to", F.lead("_from").over(within)).join(borders, [*keys, "_period"])
    return ended.withColumn("_to", F.coalesce("_to", "_border")).drop("_border", "_period")
