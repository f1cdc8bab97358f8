"""Sinks other than tables of the store: JDBC, session catalog, CSV and JSON text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.projection import all_as_strings

# Rows per JDBC insert batch and target schema of published tables.
JDBC_BATCH_ROWS = 10_000
JDBC_SCHEMA = "dbo"

PREVIEW_ROWS = 50


@dataclass(frozen=True)
class JdbcTarget:
    """Connection of a database; ``extra`` holds driver-specific options."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    schema: str | None = JDBC_SCHEMA
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        named = f"{self.schema}.{table}" if self.schema else table
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        return {"url": self.url, "dbtable": named, **{k: v for k, v in given.items() if v}, **self.extra}


def write_jdbc(
    df: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite", connections: int | None = None
) -> None:
    """Write through JDBC; ``connections`` bounds how many tasks hold one at a time."""
    options = {**target.options(table), "batchsize": str(JDBC_BATCH_ROWS)}
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_jdbc_strings(df: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite") -> None:
    """Every column as text, NULL as empty text, like a raw file."""
    write_jdbc(all_as_strings(df).fillna(""), target, table, mode)


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
) -> DataFrame:
    """Read through JDBC, as parallel ranges of ``split_column`` when it is given."""
    options = target.options(table)
    if split_column and bounds:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return spark.read.format("jdbc").options(**options).load()


def save_to_catalog(df: DataFrame, database: str, table: str, location: str | None = None) -> None:
    """Overwrite a managed table of the session catalog, creating its database."""
    where = f" LOCATION '{location}'" if location else ""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    df.write.mode("overwrite").saveAsTable(f"`{database}`.`{table}`")


def preview(spark: SparkSession, database: str, table: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`").limit(rows)


def write_csv(df: DataFrame, folder: str, single_file: bool = False, partition_by: Iterable[str] = ()) -> None:
    """Header and text values, NULL as empty; parts stay parallel unless one file is asked for."""
    keys = list(partition_by)
    text = df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c not in keys else c for c in df.columns])
    if single_file:
        text = text.coalesce(1)
    writer = text.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*keys) if keys else writer).csv(folder)


def write_json_documents(df: DataFrame, folder: str, document: Column | None = None, one_file_per: str | None = None) -> None:
    """One JSON document per row as text lines; a document column may be given.

    ``one_file_per`` names a unique column, so that every file holds one document.
    """
    body = F.to_json(F.struct(*df.columns)) if document is None else document
    if one_file_per is None:
        df.select(body.alias("value")).write.mode("overwrite").text(folder)
    else:
        rows = df.select(body.alias("value"), F.col(one_file_per).alias("document"))
        rows.write.mode("overwrite").partitionBy("document").text(folder)
