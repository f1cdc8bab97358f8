"""Cleaning, validation and quarantine driven by a dataset spec."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.cleaning import clean_value, scrub_phone, title_case, upper_case
from stratamart.names import REJECTED
from stratamart.operators.dedupe import drop_repeats
from stratamart.operators.projection import add_missing
from stratamart.operators.sizing import MAX_BROADCAST_ROWS, broadcast_within
from stratamart.session import checkpointed
from stratamart.spec import DatasetSpec, RefCheck

# Returns the table a check refers to, or None when there is no such table.
Lookup = Callable[[RefCheck], DataFrame | None]


def cast_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Declared columns scrubbed and cast, then text rules; other columns are untouched."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    casts = {
        name: clean_value(F.col(name), kinds[name], target, spec.date_formats.get(name))
        for name, target in spec.columns.items()
        if name in kinds
    }
    df = add_missing(df.withColumns(casts), spec.columns)
    for rule, names in ((upper_case, spec.upper_case), (title_case, spec.title_case), (scrub_phone, spec.phones)):
        present = {name: rule(F.col(name)) for name in names if name in df.columns}
        if present:
            df = df.withColumns(present)
    return df


def any_null(columns: Iterable[str]) -> Column:
    """True when one of the columns is NULL."""
    return reduce(or_, [F.col(f"`{name}`").isNull() for name in columns], F.lit(False))


def flag_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Reject rows with a NULL in any of the columns that exist."""
    return df.withColumn(REJECTED, any_null(c for c in columns if c in df.columns))


def _word(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), 6)


def _bit(key: Column) -> Column:
    return F.pmod(key.cast("bigint"), F.lit(64)).cast("int")


def packed_keys(known: DataFrame) -> DataFrame:
    """Whole numbers ``_known`` as ``_bits``, one bit each, by ``_word`` of 64 neighbours; NULL is left out."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("_known")))
    return known.filter("_known is not null").groupBy(_word(F.col("_known")).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def flag_orphans(
    df: DataFrame,
    column: str,
    reference: DataFrame,
    ref_column: str,
    flag: str,
    keys_from: Callable[[], DataFrame] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``flag``: the value of ``column`` is not NULL and has no partner in the reference.

    A small reference is broadcast as distinct keys, a larger one of whole numbers as
    bits of words of 64 neighbouring keys: either way ``df`` is computed once and its
    rows are not shuffled. Where words are too many as well, or keys are not whole
    numbers, only the distinct values of ``column`` are compared with the reference, and
    the rows then meet just the values that have no partner: a value that fills a third
    of the rows is one value. ``keys_from`` may give a cheaper frame that holds at least
    the same values.
    """
    known = checkpointed(reference.select(F.col(ref_column).alias("_known")).distinct())
    if known.count() <= max_broadcast_rows:
        joined = df.join(F.broadcast(known), df[column] == F.col("_known"), "left")
        return joined.withColumn(flag, F.col(column).isNotNull() & F.col("_known").isNull()).drop("_known")
    kinds = (df.schema[column].dataType, known.schema["_known"].dataType)
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        words = checkpointed(packed_keys(known))
        if words.count() <= max_broadcast_rows:
            joined = df.join(F.broadcast(words), _word(df[column]) == F.col("_word"), "left")
            found = F.coalesce(F.getbit("_bits", _bit(df[column])), F.lit(0)) == 1
            return joined.withColumn(flag, df[column].isNotNull() & ~found).drop("_word", "_bits")
    values = (df if keys_from is None else keys_from()).select(F.col(column).alias("_orphan"))
    orphans = checkpointed(
        values.filter("_orphan is not null")
        .distinct()
        .join(known, F.col("_orphan") == F.col("_known"), "left_anti")
    )
    marked = df.join(broadcast_within(orphans, max_broadcast_rows), df[column] == F.col("_orphan"), "left")
    return marked.withColumn(flag, F.col("_orphan").isNotNull()).drop("_orphan")


def flag_rejects(
    df: DataFrame,
    spec: DatasetSpec,
    lookup: Lookup | None = None,
    keys_from: Callable[[], DataFrame] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``_IsRejected``: a required column is NULL, a rule holds or is unknown, or a reference is missing."""
    reasons = [any_null(c for c in spec.required_columns if c in df.columns)]
    reasons += [F.expr(rule) for rule in spec.reject_when]
    flags = []
    for check in spec.references if lookup else ():
        reference = lookup(check)
        if reference is None or check.ref_column not in reference.columns or check.column not in df.columns:
            continue
        flag = f"_orphan_{check.column}"
        df = flag_orphans(
            df, check.column, reference, check.ref_column, flag, keys_from, max_broadcast_rows
        )
        reasons.append(F.col(flag))
        flags.append(flag)
    return df.withColumn(REJECTED, F.coalesce(reduce(or_, reasons), F.lit(True))).drop(*flags)


def clean_and_flag(
    raw: DataFrame,
    spec: DatasetSpec,
    lookup: Lookup | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Dedupe on the raw text, cast, and flag rejects; no row is lost after the dedupe."""
    cleaned = cast_columns(drop_repeats(raw, spec.dedupe_keys), spec)
    return flag_rejects(cleaned, spec, lookup, lambda: cast_columns(raw, spec), max_broadcast_rows)


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(REJECTED))


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(REJECTED)
