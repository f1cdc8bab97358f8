"""Deterministic dirt, repeats and change batches derived from existing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.names import BASE_CURRENCY
from stratamart.operators.keys import dense_surrogate_key

_SLICES = 10_000


def chosen(key: Column, ratio: float, salt: str) -> Column:
    """True for about ``ratio`` of the keys, by an MD5 of their text; the same keys every time for one salt."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % _SLICES < int(ratio * _SLICES)


def corrupt(df: DataFrame, dirt: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Replace a column where a condition holds; ``dirt`` maps column to (condition, value)."""
    return df.withColumns(
        {name: F.when(where, value).otherwise(F.col(name)) for name, (where, value) in dirt.items()}
    )


def repeat_rows(df: DataFrame, where: Column) -> DataFrame:
    """All rows, and those that match once more."""
    return df.unionByName(df.filter(where))


def next_key(df: DataFrame, key: str) -> int:
    """One above the largest key, read as a number; 1 for no rows."""
    return (df.agg(F.max(F.col(key).try_cast("bigint"))).first()[0] or 0) + 1


def key_pool(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys in numeric order."""
    return df.select(key).distinct().orderBy(F.col(key).cast("bigint"))


def change_batch(
    existing: DataFrame,
    key: str,
    update_where: Column,
    updates: Mapping[str, Column],
    newcomers: DataFrame,
    newcomer_order: Sequence[str],
) -> DataFrame:
    """Chosen rows with updated columns, and newcomers with the keys that follow the largest."""
    start = next_key(existing, key)
    changed = existing.filter(update_where).withColumns(dict(updates))
    numbered = dense_surrogate_key(newcomers.drop(key), newcomer_order, "_n", "bigint")
    arriving = numbered.withColumn(key, (F.col("_n") + (start - 1)).cast(existing.schema[key].dataType)).drop("_n")
    return changed.unionByName(arriving.select(existing.columns))


def full_snapshot(existing: DataFrame, arriving: DataFrame) -> DataFrame:
    return existing.unionByName(arriving)


def rate_documents(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """One JSON document per day with the rates that exist; absent currencies have no key.

    ``rates`` has one row per currency and day, so a document holds one entry per currency.
    """
    entry = F.struct("TargetCurrency", F.col("ExchangeRate").cast("double"))
    daily = rates.filter("ExchangeRate is not null").groupBy("RateDate").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("rates")
    )
    document = F.struct(
        F.lit(1.0).alias("amount"),
        F.lit(base).alias("base"),
        F.date_format("RateDate", "yyyy-MM-dd").alias("date"),
        "rates",
    )
    return daily.select("RateDate", F.to_json(document).alias("document"))
