"""Execution log, high-water marks and the reports over them."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.names import AUDIT, EXECUTION_LOG, PROCESSED_AT, REJECTED, RUN_ID, WATERMARKS
from stratamart.sources.tables import TableStore

# Log statuses, longest stored error text, columns of the log.
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
MAX_ERROR_CHARS = 2000
LOG_COLUMNS = {
    "pipeline_run_id": "string",
    "layer": "string",
    "dataset": "string",
    "status": "string",
    "records_in": "bigint",
    "records_out": "bigint",
    "records_rejected": "bigint",
    "error_message": "string",
}


def _one_row(spark: SparkSession, values: Mapping[str, Column]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select([value.alias(name) for name, value in values.items()])


class RunLog:
    """Events of a layer of one run, appended to the execution log in one write.

    Use it as a context: what was gathered is written at the end, also when the layer
    fails. Events have the time at which they were added.
    """

    def __init__(self, store: TableStore, run_id: str, layer: str):
        self.store, self.run_id, self.layer = store, run_id, layer
        self._events: list[tuple] = []

    def add(
        self,
        dataset: str,
        status: str,
        records_in: int | None = None,
        records_out: int | None = None,
        records_rejected: int | None = None,
        error: str | None = None,
    ) -> None:
        text = error[:MAX_ERROR_CHARS] if error else None
        micros = time.time_ns() // 1000
        self._events.append((self.run_id, self.layer, dataset, status, records_in, records_out, records_rejected, text, micros))

    def flush(self) -> None:
        if not self._events:
            return
        columns = ", ".join(f"{name} {kind}" for name, kind in LOG_COLUMNS.items())
        events = self.store.spark.createDataFrame(self._events, f"{columns}, micros bigint").coalesce(1)
        self.store.write(events.select(*LOG_COLUMNS, F.timestamp_micros("micros").alias("event_timestamp")), AUDIT, EXECUTION_LOG)
        self._events = []

    def __enter__(self) -> RunLog:
        return self

    def __exit__(self, *_) -> None:
        self.flush()


def log_event(store: TableStore, run_id: str, layer: str, dataset: str, status: str, *counts: int | None, error: str | None = None) -> None:
    """Append a single event."""
    with RunLog(store, run_id, layer) as log:
        log.add(dataset, status, *counts, error=error)


def get_mark(store: TableStore, dataset: str) -> int | None:
    """The dataset's high-water mark in microseconds since 1970 UTC, or None.

    A number, because a local clock time is ambiguous when clocks are set back.
    """
    if not store.exists(AUDIT, WATERMARKS):
        return None
    row = store.read(AUDIT, WATERMARKS).filter(F.col("dataset") == dataset).select(F.unix_micros("watermark")).first()
    return row[0] if row else None


def set_mark(store: TableStore, dataset: str, micros: int) -> None:
    row = {"dataset": F.lit(dataset), "watermark": F.timestamp_micros(F.lit(micros).cast("bigint"))}
    store.replace_by_key(_one_row(store.spark, row), AUDIT, WATERMARKS, "dataset")


def run_summary(log: DataFrame) -> DataFrame:
    """Per run, layer and dataset: last status, seconds from first to last event, row counts."""
    return (
        log.groupBy("pipeline_run_id", "layer", "dataset")
        .agg(
            F.max_by("status", F.struct("event_timestamp", F.col("status") != STARTED, "status")).alias("final_status"),
            F.min("event_timestamp").alias("first"),
            F.max("event_timestamp").alias("last"),
            F.sum("records_in").alias("records_in"),
            F.sum("records_out").alias("records_out"),
            F.sum("records_rejected").alias("records_rejected"),
            F.count("*").alias("events"),
        )
        .withColumn("duration_seconds", F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp")))
        .withColumn("duration_seconds", F.round(F.col("duration_seconds") / 1e6, 1))
        .drop("first", "last")
    )


def quality_profile(flagged: DataFrame, dataset: str) -> DataFrame:
    """Rows, rejected rows and their share; one row."""
    return flagged.agg(
        F.count("*").alias("row_count"), F.count_if(REJECTED).alias("rejected_count")
    ).select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        "rejected_count",
        F.round(F.try_divide(F.col("rejected_count"), F.col("row_count")), 4).alias("reject_ratio"),
    )


def latest_run(rows: DataFrame) -> DataFrame:
    """Rows written by the run that wrote last, as full refreshes reject the same rows every run."""
    run = rows.agg(F.max_by(RUN_ID, F.struct(PROCESSED_AT, RUN_ID))).first()[0]
    return rows.filter(F.col(RUN_ID) == F.lit(run))


def table_profile(store: TableStore, tables: Iterable[tuple[str, str]]) -> DataFrame:
    """Row count of each table that exists."""
    counts = [
        store.read(layer, name).agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, name in tables
        if store.exists(layer, name)
    ]
    if not counts:
        return store.spark.createDataFrame([], "layer string, table_name string, row_count bigint")
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def closed_before_start(history: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """Number of versions that late changes closed before they began."""
    return history.agg(F.count_if(F.col(valid_to) < F.col(valid_from)).alias("late_closures"))
