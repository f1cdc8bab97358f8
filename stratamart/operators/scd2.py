"""Slowly changing dimensions, type 2, as DataFrame rewrites."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.hashing import record_hash
from stratamart.names import IS_CURRENT, RECORD_HASH, VALID_FROM, VALID_TO
from stratamart.operators.dedupe import first_per_key, latest_first
from stratamart.operators.sizing import MAX_BROADCAST_ROWS
from stratamart.session import stored
from stratamart.spec import History


@dataclass(frozen=True)
class Change:
    """A batch compared with the current versions."""

    versions: DataFrame  # new and changed rows, hashed
    changed: int
    unchanged: int
    new: int  # of the changed: keys without a version before
    late: int  # of the changed: rows that take effect before the version they close
    groups: frozenset = frozenset()  # values that ``group`` has among the changed


def latest_per_key(batch: DataFrame, history: History) -> DataFrame:
    """The newest row of each key with its hash; older rows of the batch are not kept."""
    newest = [F.col(history.effective).desc(), *latest_first(batch, (history.key, history.effective))]
    return first_per_key(batch, [history.key], newest).withColumn(RECORD_HASH, record_hash(history.tracked))


def open_versions(rows: DataFrame, history: History) -> DataFrame:
    """Rows as current versions that start at their effective time."""
    return rows.withColumns(
        {
            VALID_FROM: F.col(history.effective),
            VALID_TO: F.lit(None).cast("timestamp"),
            IS_CURRENT: F.lit(True),
        }
    )


def find_changes(
    current: DataFrame,
    latest: DataFrame,
    total: int,
    history: History,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    group: Column | None = None,
) -> Change:
    """Keys of a reduced batch that are new or whose tracked columns differ.

    Pass stored rows as ``latest``, one per key, and their number. If they are few, the
    key, hash and start columns of the current versions are scanned against them as a
    broadcast, so the dimension is not shuffled. Keys compare null-safe: NULL is a key
    like any other. ``group`` must have few values.
    """
    keys = latest.select(F.col(history.key).alias("_key"))
    known = current.select(
        F.col(history.key).alias("_known"), F.col(RECORD_HASH).alias("_known_hash"), F.col(VALID_FROM).alias("_known_from")
    ).join(F.broadcast(keys) if total <= max_broadcast_rows else keys, F.col("_known").eqNullSafe(F.col("_key")), "left_semi")
    compared = latest.join(known, F.col(history.key).eqNullSafe(F.col("_known")), "left")
    differing = stored(
        compared.filter(~F.col(RECORD_HASH).eqNullSafe(F.col("_known_hash"))).select(
            *latest.columns,
            F.col("_known_hash").isNull().alias("_new"),
            F.coalesce(F.col(history.effective) < F.col("_known_from"), F.lit(False)).alias("_late"),
        ),
        "changes",
    )
    groups = F.collect_set(F.lit(0) if group is None else group)
    changed, new, late, found = differing.agg(F.count("*"), F.count_if("_new"), F.count_if("_late"), groups).first()
    return Change(differing.drop("_new", "_late"), changed, total - changed, new, late, frozenset(found))


def close_changed(
    current: DataFrame, change: Change, history: History, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Current versions, those with a successor closed at its effective time."""
    successors = change.versions.select(
        F.col(history.key).alias("_key"), F.col(history.effective).alias("_closed_at"), F.lit(True).alias("_closes")
    )
    if change.changed <= max_broadcast_rows:
        successors = F.broadcast(successors)
    closing = F.coalesce("_closes", F.lit(False))
    return (
        current.join(successors, F.col(history.key).eqNullSafe(F.col("_key")), "left")
        .withColumns(
            {
                VALID_TO: F.when(closing, F.col("_closed_at").cast("timestamp")).otherwise(F.col(VALID_TO)),
                IS_CURRENT: F.col(IS_CURRENT) & ~closing,
            }
        )
        .drop("_key", "_closed_at", "_closes")
    )


def fold_batch(
    existing: DataFrame | None, batch: DataFrame, history: History, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """All versions after ``batch``; with nothing before, every latest row opens a version."""
    if existing is None:
        return open_versions(latest_per_key(batch, history), history)
    current = existing.filter(IS_CURRENT)
    latest = stored(latest_per_key(batch, history), "batch")
    change = find_changes(current, latest, latest.count(), history, max_broadcast_rows)
    return (
        existing.filter(~F.col(IS_CURRENT))
        .unionByName(close_changed(current, change, history, max_broadcast_rows))
        .unionByName(open_versions(change.versions, history), allowMissingColumns=True)
    )
