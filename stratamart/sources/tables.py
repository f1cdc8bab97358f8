"""Path-addressed tables: ``<base>/<layer>/<name>``, no metastore.

A table folder holds parquet snapshots ``_snapshot=<n>`` and one small ``_live.json`` that
names the live snapshot and the table's columns. Appends add files to the live
snapshot; overwrites write the next one and then switch, so a job may read the table
it replaces and a failed write leaves the old one live. One writer at a time is assumed.
Columns come from ``_live.json``; reading does not open file footers. Where partitions
were replaced, ``_live.json`` also names the snapshot of each of these.

History tables keep every version, split by ``_SCD_IsCurrent`` and by buckets of the
key's hash. ``_live.json`` names for each bucket the snapshot with its current rows, so
a batch rewrites only the buckets in which something changes; closed rows are written
once and belong to the table from their snapshot on. It also holds the last batch number
of each stream that feeds the table, and whether a late change ever came: all of this
switches together.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.names import IS_CURRENT
from stratamart.operators.scd2 import close_changed, find_changes, latest_per_key, open_versions
from stratamart.operators.projection import add_processing_audit
from stratamart.session import stored
from stratamart.sources.paths import read_small_text, replace_small_text
from stratamart.spec import History


_SNAPSHOT, _BUCKET = "_snapshot", "_bucket"

#: Keys of a history table that one bucket is meant for, and most buckets.
KEYS_PER_BUCKET, MAX_BUCKETS = 500_000, 4096


class SchemaConflict(ValueError):
    """A column exists with another type; tables only gain columns."""


def new_columns(existing: T.StructType, incoming: T.StructType) -> list[T.StructField]:
    """Columns of ``incoming`` that ``existing`` lacks."""
    known = set(existing.names)
    return [f for f in incoming.fields if f.name not in known]


def widened(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """``existing`` plus the new columns and new nested fields of ``incoming``."""
    arriving = {f.name: f.dataType for f in incoming.fields}
    fields = []
    for f in existing.fields:
        kind = f.dataType
        other = arriving.get(f.name, kind)
        if isinstance(kind, T.StructType) and isinstance(other, T.StructType):
            kind = widened(kind, other)
        elif kind.simpleString() != other.simpleString():
            raise SchemaConflict(f"column {f.name}: {kind.simpleString()} in the table, {other.simpleString()} arriving")
        fields.append(T.StructField(f.name, kind, True))
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new_columns(existing, incoming)])


@dataclass(frozen=True)
class _Live:
    version: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    #: Of a table whose partitions were replaced: the snapshot of the others, and of each of these by its value.
    base: int | None = None
    parts: dict[str, int] = field(default_factory=dict)
    #: Of a history table: the snapshot of each bucket's current rows, and their number.
    buckets: tuple[int, ...] = ()
    keys: int = 0
    #: Whether a change ever took effect before the version that it closed.
    late: bool = False
    #: The last batch of each stream.
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def history(self) -> bool:
        return bool(self.buckets)

    @property
    def snapshot(self) -> int:
        """The snapshot of all rows whose partition was not replaced."""
        return self.version if self.base is None else self.base

    def snapshot_of(self) -> Column:
        """The snapshot that a row's partition lives in."""
        if not self.parts:
            return F.lit(self.snapshot)
        known = F.create_map(*[F.lit(x) for pair in self.parts.items() for x in pair])
        return F.coalesce(F.try_element_at(known, _part_value(self.partition_by[0])), F.lit(self.snapshot))

    def to_json(self) -> str:
        return json.dumps({f.name: getattr(self, f.name) for f in fields(self)} | {"schema": self.schema.jsonValue()})

    @staticmethod
    def from_json(text: str) -> _Live:
        raw = json.loads(text)
        lists = {name: tuple(raw.get(name, ())) for name in ("partition_by", "buckets")}
        return _Live(**raw | lists | {"schema": T.StructType.fromJson(raw["schema"])})


class TableStore:
    """Reads and writes the tables below one base path."""

    def __init__(self, spark: SparkSession, base: str, file_format: str = "parquet"):
        self.spark = spark
        self.base = base.rstrip("/")
        self.file_format = file_format

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def _live(self, layer: str, name: str) -> _Live | None:
        text = read_small_text(self.spark, f"{self.path(layer, name)}/_live.json")
        return None if text is None else _Live.from_json(text)

    def _switch(self, layer: str, name: str, live: _Live) -> None:
        replace_small_text(self.spark, f"{self.path(layer, name)}/_live.json", live.to_json())

    def exists(self, layer: str, name: str) -> bool:
        """Whether the table was ever written; an empty table exists. Starts no job."""
        return self._live(layer, name) is not None

    def schema(self, layer: str, name: str) -> T.StructType:
        return self._require(layer, name).schema

    def _require(self, layer: str, name: str) -> _Live:
        live = self._live(layer, name)
        if live is None:
            raise FileNotFoundError(f"no table {layer}.{name} below {self.base}")
        return live

    def read(self, layer: str, name: str) -> DataFrame:
        live = self._require(layer, name)
        path = self.path(layer, name)
        reader = self.spark.read.format(self.file_format)
        if not live.history:
            if not live.parts:
                return reader.schema(live.schema).load(f"{path}/{_SNAPSHOT}={live.snapshot}").select(*live.schema.names)
            rows = reader.schema(T.StructType([*live.schema.fields, T.StructField(_SNAPSHOT, T.IntegerType())])).load(path)
            return rows.filter(F.col(_SNAPSHOT) == live.snapshot_of()).select(*live.schema.names)
        return self._history_rows(layer, name, live).drop(_BUCKET)

    def _history_rows(self, layer: str, name: str, live: _Live) -> DataFrame:
        """All versions with their bucket; whole folders are passed over by their partition values."""
        places = [T.StructField(_SNAPSHOT, T.IntegerType()), T.StructField(_BUCKET, T.IntegerType())]
        reader = self.spark.read.format(self.file_format).schema(T.StructType([*live.schema.fields, *places]))
        of_bucket = F.get(F.lit(list(live.buckets)), F.col(_BUCKET))
        kept = (F.col(_SNAPSHOT) <= live.version) & (~F.col(IS_CURRENT) | (F.col(_SNAPSHOT) == of_bucket))
        return reader.load(self.path(layer, name)).filter(kept).select(*live.schema.names, _BUCKET)

    def may_overlap(self, layer: str, name: str) -> bool:
        """Whether two versions of one key of a history table may hold at once.

        Each version ends where its successor begins, so only a change that took effect
        before the version it closed can reach into older ones. Starts no job.
        """
        return self._require(layer, name).late

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        mode: str = "append",
        partition_by: Sequence[str] = (),
        merge_schema: bool = True,
    ) -> list[str]:
        """Append to or overwrite a table; returns the columns it gained.

        With ``merge_schema`` unknown columns are added to the table, otherwise they are
        an error. Columns the frame lacks are NULL. Existing columns keep their type.
        """
        live = self._live(layer, name)
        appending = mode == "append" and live is not None
        if appending and live.history:
            raise ValueError(f"{layer}.{name} keeps history; use upsert_history")
        gained: list[str] = []
        schema = _nullable(df.schema)
        if appending:
            gained = [f.name for f in new_columns(live.schema, schema)]
            if gained and not merge_schema:
                raise SchemaConflict(f"{layer}.{name} has no columns {gained}")
            schema = widened(live.schema, schema)
        if appending:
            target = replace(live, schema=schema)
        else:
            target = _Live(live.version + 1 if live else 1, schema, tuple(partition_by))
        self._save(df, layer, name, target, "append" if appending else "overwrite")
        if target != live:
            self._switch(layer, name, target)
        return gained

    def _save(self, df: DataFrame, layer: str, name: str, target: _Live, mode: str) -> None:
        """Write rows to the snapshots of ``target``, partitioned as the table is."""
        path, keys = f"{self.path(layer, name)}/{_SNAPSHOT}={target.snapshot}", target.partition_by
        if target.parts:
            df, path, keys = df.withColumn(_SNAPSHOT, target.snapshot_of()), self.path(layer, name), (_SNAPSHOT, *keys)
        writer = df.write.format(self.file_format).mode(mode)
        (writer.partitionBy(*keys) if keys else writer).save(path)

    def replace_partitions(self, df: DataFrame, layer: str, name: str) -> list[str]:
        """Put ``df`` in place of all rows of the partitions that it has rows of; returns their values.

        For tables partitioned by one column. The new rows become visible by one switch,
        which names the snapshot of each replaced partition; files of other partitions
        are neither read nor written, and later appends go where their partition lives.
        """
        live = self._require(layer, name)
        if len(live.partition_by) != 1 or live.history:
            raise ValueError(f"{layer}.{name} is not partitioned by one column")
        key, version = live.partition_by[0], live.version + 1
        target = replace(live, version=version, schema=widened(live.schema, _nullable(df.schema)), base=live.snapshot)
        path = f"{self.path(layer, name)}/{_SNAPSHOT}={version}"
        df.write.format(self.file_format).mode("overwrite").partitionBy(key).save(path)
        written = self.spark.read.format(self.file_format).schema(target.schema).load(path)
        values = sorted(row[0] for row in written.select(_part_value(key)).distinct().collect())
        self._switch(layer, name, replace(target, parts={**live.parts, **dict.fromkeys(values, version)}))
        return values

    def evolve_and_write(self, df: DataFrame, layer: str, name: str, mode: str = "append") -> list[str]:
        """Create the table, or add the frame's new columns to it and write.

        Unlike a plain overwrite, columns the table already has stay in it.
        """
        live = self._live(layer, name)
        if live is None or mode == "append":
            return self.write(df, layer, name, "overwrite" if live is None else "append")
        gained = [f.name for f in new_columns(live.schema, df.schema)]
        schema = widened(live.schema, df.schema)
        target = replace(live, version=live.version + 1, schema=schema, base=None, parts={})
        self._save(df, layer, name, target, "overwrite")
        self._switch(layer, name, target)
        return gained

    def replace_by_key(self, df: DataFrame, layer: str, name: str, key: str) -> None:
        """Rows of the table whose key is not in ``df``, plus ``df``."""
        if self.exists(layer, name):
            kept = self.read(layer, name).join(df.select(key).distinct(), key, "left_anti")
            df = kept.unionByName(df, allowMissingColumns=True)
        self.write(df, layer, name, "overwrite")

    def upsert_history(
        self,
        batch: DataFrame,
        layer: str,
        name: str,
        history: History,
        run_id: str,
        buckets: int | None = None,
        batch_number: tuple[str, int] | None = None,
    ) -> tuple[int, int]:
        """Fold a batch into a type 2 table; returns (new or changed keys, unchanged keys).

        Only current versions can change, and only those in the buckets of changed keys
        are rewritten: with the newly closed rows beside them, in one write that becomes
        visible by the switch. The same batch again finds nothing to change. With
        ``batch_number``, the name of a stream and the number of its batch, a batch that
        is not above the last one of that stream is passed over, whatever came since.

        The first batch fixes the number of ``buckets``, by default from its keys. When
        a batch touches all of them, and so rewrites all current rows, the number follows
        the keys that the table has by then.
        """
        live = self._live(layer, name)
        batches = {} if live is None else live.batches
        if batch_number is not None:
            stream, number = batch_number
            if batches.get(stream, -1) >= number:
                return 0, 0
            batches = {**batches, stream: number}
        latest = stored(latest_per_key(batch, history), "batch")

        def opened(rows: DataFrame) -> DataFrame:
            return add_processing_audit(open_versions(rows, history), run_id)

        if live is None:
            total = latest.count()
            rows, wanted = opened(latest), buckets or _buckets_for(total)
            target = _Live(1, _nullable(rows.schema), buckets=(1,) * wanted, keys=total, batches=batches)
            self._write_history(rows, layer, name, target, history)
            return total, 0

        count = len(live.buckets)
        bucket = _bucket_of(history.key, count)
        total, asked = latest.agg(F.count("*"), F.collect_set(bucket)).first()
        current = self._history_rows(layer, name, live).filter(F.col(IS_CURRENT) & F.col(_BUCKET).isin(asked))
        change = find_changes(current.drop(_BUCKET), latest, total, history, group=bucket)
        if change.changed == 0:
            if batches != live.batches:
                self._switch(layer, name, replace(live, batches=batches))
            return 0, change.unchanged
        touched = change.groups
        version, keys = live.version + 1, live.keys + change.new
        places = tuple(version if b in touched else at for b, at in enumerate(live.buckets))
        if buckets is None and len(touched) == count:
            places = (version,) * max(count, _buckets_for(keys))
        fresh = opened(change.versions)
        rewritten = close_changed(current.filter(F.col(_BUCKET).isin(sorted(touched))).drop(_BUCKET), change, history)
        rows = rewritten.unionByName(fresh, allowMissingColumns=True)
        target = replace(
            live, version=version, schema=widened(live.schema, fresh.schema), buckets=places, keys=keys,
            late=live.late or change.late > 0, batches=batches,
        )
        self._write_history(rows, layer, name, target, history)
        return change.changed, change.unchanged

    def _write_history(self, rows: DataFrame, layer: str, name: str, live: _Live, history: History) -> None:
        """Closed and current rows of the next snapshot by bucket, then the switch.

        Small buckets share a task and large ones are split among several.
        """
        placed = rows.select(*live.schema.names, _bucket_of(history.key, len(live.buckets))).hint("rebalance", F.col(_BUCKET))
        (
            placed.write.format(self.file_format)
            .mode("overwrite")
            .partitionBy(IS_CURRENT, _BUCKET)
            .save(f"{self.path(layer, name)}/{_SNAPSHOT}={live.version}")
        )
        self._switch(layer, name, live)


def _buckets_for(keys: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-keys // KEYS_PER_BUCKET)))


def _bucket_of(key: str, count: int) -> Column:
    """The bucket of a key; a number that was fixed with the table."""
    return F.pmod(F.xxhash64(key), F.lit(count)).cast("int").alias(_BUCKET)


def _part_value(key: str) -> Column:
    """A partition's value as text; NULL has its own."""
    return F.coalesce(F.col(key).cast("string"), F.lit("\0"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
