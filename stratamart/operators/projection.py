"""Column-level reshaping that needs no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.names import INGESTED_AT, PROCESSED_AT, RUN_ID, SOURCE_FILE


def all_as_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def add_landing_audit(df: DataFrame, run_id: str) -> DataFrame:
    """Which run landed a row, and when."""
    return df.withColumns({RUN_ID: F.lit(run_id).cast("string"), INGESTED_AT: F.current_timestamp()})


def add_processing_audit(df: DataFrame, run_id: str) -> DataFrame:
    """Which run cleaned a row, and when."""
    return df.withColumns({RUN_ID: F.lit(run_id).cast("string"), PROCESSED_AT: F.current_timestamp()})


def drop_technical(df: DataFrame) -> DataFrame:
    """Data columns plus the two technical columns that cleaning needs."""
    return df.select([c for c in df.columns if not c.startswith("_") or c in (SOURCE_FILE, INGESTED_AT)])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns of ``names`` that exist; others are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Declared columns that are absent, as typed NULLs."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
