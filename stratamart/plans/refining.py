"""Bronze tables to Silver tables: reshape, clean, quarantine, keep history."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratamart.names import (
    BRONZE,
    INGEST_DATE,
    INGESTED_AT,
    REJECTED,
    REJECTS_SUFFIX,
    SILVER,
    SOURCE_FILE,
)
from stratamart.operators.nested import flatten, parse_payload, wide_to_long
from stratamart.operators.projection import add_processing_audit, drop_technical, rename_present
from stratamart.operators.quality import accepted, clean_and_flag, rejected
from stratamart.plans.audit import FAILED, STARTED, SUCCESS, RunLog, get_mark, set_mark
from stratamart.plans.landing import raise_failures
from stratamart.session import stored
from stratamart.sources.files import above_mark
from stratamart.sources.tables import TableStore
from stratamart.spec import REGISTRY, DatasetSpec, RefCheck


@dataclass(frozen=True)
class Refined:
    records_in: int = 0
    records_out: int = 0
    records_rejected: int = 0


def reshape(bronze: DataFrame, spec: DatasetSpec) -> DataFrame | None:
    """Landed rows in the columns that cleaning expects; None when there is no payload."""
    if spec.raw_format != "json":
        return drop_technical(bronze)
    if "raw_payload" in bronze.columns:
        return parse_payload(bronze, spec.renames, spec.raw_schema, keep=(SOURCE_FILE, INGESTED_AT))
    flat = flatten(bronze)
    if spec.wide_to_long:
        return wide_to_long(flat, spec.wide_to_long, (SOURCE_FILE, INGESTED_AT))
    return rename_present(flat, spec.renames)


def lookup_in(store: TableStore):
    """References are Silver tables; a check whose table does not exist yet is skipped."""

    def lookup(check: RefCheck) -> DataFrame | None:
        return store.read(check.layer, check.table) if store.exists(check.layer, check.table) else None

    return lookup


def _not_yet_refined(store: TableStore, spec: DatasetSpec) -> DataFrame:
    landed = store.read(BRONZE, spec.name)
    micros = None if spec.full_refresh else get_mark(store, spec.name)
    if micros is None:
        return landed
    # The date filter prunes whole folders before the exact filter reads any file. Dates
    # depend on the time zone of the landing session, hence a day of slack.
    mark = F.timestamp_micros(F.lit(micros))
    return above_mark(landed.filter(F.col(INGEST_DATE) >= F.date_sub(mark.cast("date"), 1)), mark)


def refine_dataset(store: TableStore, spec: DatasetSpec, run_id: str) -> Refined:
    """Clean what was landed since the last run and move the high-water mark."""
    if not store.exists(BRONZE, spec.name):
        return Refined()
    # The scan is fixed here: rows landed while this run works belong to the next one.
    bronze = _not_yet_refined(store, spec)
    if bronze.isEmpty():
        return Refined()
    taken, kept = Observation(), Observation()
    landed = bronze.observe(taken, F.count(F.lit(1)).alias("rows"), F.unix_micros(F.max(INGESTED_AT)).alias("newest"))
    raw = reshape(landed, spec)
    if raw is None:
        return Refined()

    # Flagged rows feed two writes; stored once, they outlive any executor. Counts are
    # taken on the way.
    flagged = clean_and_flag(raw, spec, lookup_in(store))
    counts = [F.count_if(REJECTED).alias("bad"), F.count_if(~F.col(REJECTED)).alias("good")]
    flagged = stored(flagged.observe(kept, *counts), "flagged")
    bad, good = kept.get["bad"], kept.get["good"]
    if bad:
        store.evolve_and_write(add_processing_audit(rejected(flagged), run_id), SILVER, spec.name + REJECTS_SUFFIX)
    if spec.history:
        good, _ = store.upsert_history(accepted(flagged), SILVER, spec.name, spec.history, run_id)
    else:
        mode = "overwrite" if spec.full_refresh else "append"
        store.evolve_and_write(add_processing_audit(accepted(flagged), run_id), SILVER, spec.name, mode)
    if not spec.full_refresh:
        set_mark(store, spec.name, taken.get["newest"])
    return Refined(taken.get["rows"], good, bad)


def refine_all(
    store: TableStore, run_id: str, registry: Mapping[str, DatasetSpec] = REGISTRY
) -> dict[str, Refined]:
    """Refine every dataset in registry order; failures are raised together at the end."""
    results: dict[str, Refined] = {}
    failures: dict[str, Exception] = {}
    with RunLog(store, run_id, SILVER) as log:
        for name, spec in registry.items():
            log.add(name, STARTED)
            try:
                done = results[name] = refine_dataset(store, spec, run_id)
                log.add(name, SUCCESS, done.records_in, done.records_out, done.records_rejected)
            except Exception as error:
                log.add(name, FAILED, error=str(error))
                failures[name] = error
    raise_failures(SILVER, failures)
    return results
