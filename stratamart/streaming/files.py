"""File streams: exactly the new files are landed, and history is kept batch by batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from stratamart.names import SILVER
from stratamart.operators.projection import add_landing_audit
from stratamart.sources.paths import read_small_text
from stratamart.sources.tables import TableStore
from stratamart.spec import History


def land_stream(source: DataFrame, target: str, progress: str, run_id: str) -> None:
    """Land the files that arrived since the last run, then stop.

    The stream's progress replaces the file registry, and the file sink records each
    batch once, so a batch that is tried again leaves no repeats.
    """
    (
        add_landing_audit(source, run_id)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def refine_history_stream(
    store: TableStore, source: DataFrame, name: str, history: History, run_id: str, progress: str
) -> None:
    """Fold each batch of the stream into a type 2 table, then stop.

    The number of a batch is recorded with the rows it makes, in one switch of the table.
    A batch that is tried again after a failure is known by its number and passed over,
    even if its rows were changed since. A stream that starts anew, with another
    ``progress``, has a new identity and folds all its batches.
    """

    def fold(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store.upsert_history(batch, SILVER, name, history, run_id, batch_number=(stream_id(store, progress), number))

    (
        source.writeStream.foreachBatch(fold)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stream_id(store: TableStore, progress: str) -> str:
    """The identity that a stream keeps in its progress folder."""
    text = read_small_text(store.spark, f"{progress}/metadata")
    if text is None:
        raise FileNotFoundError(f"no stream has its progress in {progress}")
    return json.loads(text)["id"]
