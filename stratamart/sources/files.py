"""Raw files: listing, choosing and scanning."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.names import FILE_REGISTRY, AUDIT, INGESTED_AT, SOURCE_FILE
from stratamart.operators.projection import all_as_strings
from stratamart.operators.sizing import broadcast_within
from stratamart.sources.tables import TableStore

FILE_LISTING = "path string, name string, size bigint, modificationTime timestamp, uri string"

REGISTRY_COLUMNS = ("dataset", "file_path", "file_name", "file_size", "pipeline_run_id", "ingested_at")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below ``folder`` as rows; hidden names are left out, a missing folder is empty.

    Only the listing is read: the unused ``content`` column keeps the files closed. ``uri``
    is what scans give as the file of a row.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException:
        return spark.createDataFrame([], FILE_LISTING)
    name = F.substring_index("path", "/", -1)
    more = {"name": name, "size": F.col("_metadata.file_size"), "uri": F.col("_metadata.file_path")}
    return found.where(~name.startswith("_")).withColumns(more).select("path", "name", "size", "modificationTime", "uri")


def not_registered(listing: DataFrame, registry: DataFrame, dataset: str) -> DataFrame:
    """Listed files that the registry does not hold for this dataset."""
    done = registry.filter(F.col("dataset") == dataset).select(F.col("file_path").alias("path"))
    return listing.join(done, "path", "left_anti")


def newest(listing: DataFrame) -> DataFrame:
    """The file modified last; the largest path wins a tie."""
    return listing.agg(
        F.max_by(F.struct(*listing.columns), F.struct("modificationTime", "path")).alias("f")
    ).filter("f is not null").select("f.*")


def new_files(store: TableStore, dataset: str, folder: str) -> DataFrame:
    listing = list_files(store.spark, folder)
    if not store.exists(AUDIT, FILE_REGISTRY):
        return listing
    return not_registered(listing, store.read(AUDIT, FILE_REGISTRY), dataset)


def register_files(store: TableStore, dataset: str, files: DataFrame, run_id: str) -> None:
    """Append files to the registry so that later runs pass over them."""
    rows = files.select(
        F.lit(dataset).alias("dataset"),
        F.col("path").alias("file_path"),
        F.col("name").alias("file_name"),
        F.col("size").cast("bigint").alias("file_size"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.current_timestamp().alias("ingested_at"),
    )
    store.write(rows, AUDIT, FILE_REGISTRY)


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _since(oldest: int | None) -> dict[str, str]:
    """Reader options that pass over files older than ``oldest``; the option knows whole seconds."""
    if oldest is None:
        return {}
    at = datetime.fromtimestamp(oldest // 1_000_000 - 2, timezone.utc)
    return {"modifiedAfter": at.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}


def rows_of(scan: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of a scan whose file is among ``files`` of a listing."""
    chosen = files.select(F.col("uri").alias("_uri"))
    return scan.join(broadcast_within(chosen), F.col(SOURCE_FILE) == F.col("_uri"), "left_semi")


def read_csv(
    spark: SparkSession, paths: Sequence[str] | str, recursive: bool = False, oldest: int | None = None
) -> DataFrame:
    """CSV files of one header as strings, with the file each row came from.

    Names come from the first file. A file with another header fails the job instead of
    being read into the wrong columns; see :func:`read_mixed_csv`. Files modified before
    ``oldest``, in microseconds since 1970 UTC, are left out, give or take two seconds.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", recursive).options(**_since(oldest))
    named = T.StructType([T.StructField(c, T.StringType()) for c in reader.csv(paths).columns])
    return _with_source(reader.option("enforceSchema", False).schema(named).csv(paths))


def csv_headers(spark: SparkSession, folder: str, files: DataFrame, oldest: int | None = None) -> DataFrame:
    """The first line of each of ``files`` below ``folder``, as (uri, header)."""
    reader = spark.read.option("recursiveFileLookup", True).options(**_since(oldest))
    lines = _with_source(reader.text(folder)).select(
        SOURCE_FILE, "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")
    )
    first = F.min_by("value", "n").alias("header")
    return rows_of(lines.filter("block = 0"), files).groupBy(F.col(SOURCE_FILE).alias("uri")).agg(first)


def read_mixed_csv(
    spark: SparkSession, folder: str, files: DataFrame, headers: DataFrame, oldest: int | None = None
) -> DataFrame:
    """CSV files with differing headers in one scan, matched by name.

    ``headers`` holds the first line of each file, see :func:`csv_headers`. Every row
    meets the header of its file and is laid out by it; columns that a file lacks are
    NULL. Rows that repeat their header word for word are headers. Only the names of all
    columns reach the driver.
    """
    line = F.col("header")
    names = F.transform(F.split(line, ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    named = headers.select(F.col("uri").alias("_uri"), names.alias("_names"))
    widest, columns = named.agg(F.max(F.size("_names")), F.array_sort(F.collect_set("_names"))).first()
    places = T.StructType([T.StructField(f"_c{k}", T.StringType()) for k in range(widest or 0)])
    reader = spark.read.option("recursiveFileLookup", True).options(**_since(oldest))
    scan = rows_of(_with_source(reader.schema(places).csv(folder)), files)
    values = F.array(*[F.col(f.name) for f in places.fields])
    met = scan.join(broadcast_within(named), F.col(SOURCE_FILE) == F.col("_uri")).withColumn("_values", values)
    is_header = F.slice("_values", 1, F.size("_names")) == F.col("_names")
    every = list(dict.fromkeys(name for header in columns for name in header))
    return met.filter(~F.coalesce(is_header, F.lit(False))).select(
        *[F.get("_values", F.array_position("_names", name).cast("int") - 1).alias(name) for name in every], SOURCE_FILE
    )


def read_csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV file below a folder, as strings."""
    return all_as_strings(read_csv(spark, folder, recursive=True).drop(SOURCE_FILE))


def read_json_documents(
    spark: SparkSession,
    paths: Sequence[str] | str,
    schema: T.StructType | str | None = None,
    recursive: bool = False,
    oldest: int | None = None,
) -> DataFrame:
    """JSON documents that may span lines, with the file each came from.

    Values are text as in CSV files, so a rate that is whole in one file and not in the
    next has one type. Give ``schema`` to save the pass over all files that inference takes.
    """
    reader = spark.read.option("multiLine", True).option("primitivesAsString", True)
    reader = reader.option("recursiveFileLookup", recursive).options(**_since(oldest))
    if schema is not None:
        reader = reader.schema(schema)
    return _with_source(reader.json(paths))


def above_mark(df: DataFrame, mark: Column | None, column: str = INGESTED_AT) -> DataFrame:
    """Rows strictly above a high-water mark; all rows when there is none."""
    return df if mark is None else df.filter(F.col(column) > mark)
