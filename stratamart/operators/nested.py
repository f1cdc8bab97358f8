"""Nested and JSON data to flat columns and rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators.projection import rename_present
from stratamart.spec import WideToLong


def flatten(df: DataFrame) -> DataFrame:
    """Rows per array element and ``parent_child`` columns per struct field, to any depth.

    Arrays are exploded one after another and keep a row when empty, so two sibling
    arrays give one row per pair of their elements. Columns of a level that is being
    opened move behind the columns that stay. A name that is taken, as ``a_b`` beside a
    field ``b`` of ``a``, gets the next free number behind it: ``a_b_2``.
    """
    fields = df.schema.fields
    arrays = [f.name for f in fields if isinstance(f.dataType, T.ArrayType)]
    structs = [f for f in fields if isinstance(f.dataType, T.StructType)]
    if not arrays and not structs:
        return df
    for name in arrays:
        df = df.withColumn(name, F.explode_outer(f"`{name}`"))
    if structs:
        opened = {f.name for f in structs}
        kept = [F.col(f"`{name}`") for name in df.columns if name not in opened]
        taken = {name.lower() for name in df.columns if name not in opened}
        children = [
            F.col(f"`{f.name}`").getField(child.name).alias(_free_name(f"{f.name}_{child.name}", taken))
            for f in structs
            for child in f.dataType.fields
        ]
        df = df.select(*kept, *children)
    return flatten(df)


def _free_name(name: str, taken: set[str]) -> str:
    """``name``, numbered if it is taken already, and taken from now on."""
    free, number = name, 1
    while free.lower() in taken:
        number += 1
        free = f"{name}_{number}"
    taken.add(free.lower())
    return free


def payload_schema(df: DataFrame, payload: str) -> str | None:
    """Struct type of all JSON objects in a column; None when there is none."""
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(payload))).first()[0]
    if found == "VARIANT":  # objects beside other values, which have no columns
        objects = df.filter(F.schema_of_variant(F.try_parse_json(payload)).startswith("OBJECT"))
        found = objects.select(F.schema_of_variant_agg(F.try_parse_json(payload))).first()[0]
    if not found.startswith("OBJECT<"):
        return None
    # Quoted names stay as they are.
    parts = found.split("`")
    for k in range(0, len(parts), 2):
        for kind, instead in ((r"\bOBJECT<", "STRUCT<"), (r": (VARIANT|VOID)\b", ": STRING"), (r"<(VARIANT|VOID)>", "<STRING>"), (r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE")):
            parts[k] = re.sub(kind, instead, parts[k])
    return "`".join(parts)


def parse_payload(
    df: DataFrame,
    renames: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    payload: str = "raw_payload",
    keep: Iterable[str] = (),
) -> DataFrame | None:
    """JSON text column to flat columns, or None when no row has a payload.

    Without ``schema`` one aggregate over all payloads finds it, so no key or value is
    lost where documents differ: numbers of several types become doubles, values of
    several kinds stay as text. Text that is no JSON gives a row of NULLs. A schema saves
    that pass. Columns in ``keep`` that exist stay beside the parsed ones.
    """
    if schema is None:
        schema = payload_schema(df, payload)
        if schema is None:
            return None
    kept = [c for c in keep if c in df.columns]
    parsed = df.select(*kept, F.from_json(payload, schema).alias("data")).select(*kept, "data.*")
    return rename_present(flatten(parsed), renames or {})


def wide_to_long(df: DataFrame, shape: WideToLong, extra_keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per prefixed column, named by what follows the prefix; NULL values stay."""
    names = [c for c in df.columns if c.startswith(shape.prefix)]
    ids = [*extra_keep, *shape.keep]
    values = df.select(
        *ids, *[F.col(f"`{c}`").try_cast("double").alias(c.removeprefix(shape.prefix)) for c in names]
    )
    long = values.unpivot(
        ids, [c.removeprefix(shape.prefix) for c in names], shape.name_column, shape.value_column
    )
    return rename_present(long, shape.keep)
