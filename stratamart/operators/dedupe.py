"""Duplicate removal with a repeatable winner."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.names import INGESTED_AT, SOURCE_FILE
from stratamart.operators.sizing import MAX_BROADCAST_ROWS
from stratamart.session import checkpointed


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Iterable[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Spark keeps one row per key within each map task before it shuffles, so a key
    that holds a large share of the rows stays small.
    """
    ranked = Window.partitionBy(*keys).orderBy(*(list(order) or keys))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def latest_first(df: DataFrame, apart_from: Iterable[str] = ()) -> list[Column]:
    """Total order of rows: newest landing, then last file, then all columns but those in ``apart_from``."""
    newest = [F.col(c).desc() for c in (INGESTED_AT, SOURCE_FILE) if c in df.columns]
    passed = {INGESTED_AT, SOURCE_FILE, *apart_from}
    rest = [F.col(f"`{f.name}`").asc() for f in df.schema.fields if f.name not in passed and not _holds_map(f.dataType)]
    return newest + rest


def drop_repeats(df: DataFrame, keys: Sequence[str] = (), order: Iterable[Column] | None = None) -> DataFrame:
    """One row per key, or distinct rows when there is no key."""
    if not keys:
        return df.dropDuplicates()
    return first_per_key(df, keys, latest_first(df, keys) if order is None else order)


def settle_repeats(
    df: DataFrame, keys: Sequence[str], max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Like :func:`drop_repeats` with keys, for stored rows of which few repeat.

    Counting rows per key shuffles the keys alone. Only rows of repeated keys are then
    ranked; all others pass without a shuffle or a sort. Many repeated keys fall back
    to ranking every row.
    """
    names = [f"_repeated{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(key).alias(name) for key, name in zip(keys, names)]).agg(F.count("*").alias("_rows"))
    repeated = checkpointed(counts.filter("_rows > 1").select(*names))
    repeated_count = repeated.count()
    if repeated_count == 0:
        return df
    if repeated_count > max_broadcast_rows:
        return drop_repeats(df, keys)
    among = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names)])
    single = df.join(F.broadcast(repeated), among, "left_anti")
    return single.unionByName(drop_repeats(df.join(F.broadcast(repeated), among, "left_semi"), keys))
