"""Gold tables to a database or to the session catalog."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratamart.names import GOLD, GOLD_TABLES, SALES_MONTH
from stratamart.plans.audit import FAILED, STARTED, SUCCESS, RunLog
from stratamart.plans.landing import raise_failures
from stratamart.sources.exports import JdbcTarget, save_to_catalog, write_jdbc
from stratamart.sources.tables import TableStore

# Layer names of publishing in the execution log.
SQL_EXPORT, CATALOG_SYNC = "sql_export", "catalog_sync"


def _publish_each(
    store: TableStore, run_id: str, layer: str, tables: Iterable[str], send: Callable[[DataFrame, str], None]
) -> None:
    """Send every table; failures are logged and raised together at the end."""
    failures: dict[str, Exception] = {}
    with RunLog(store, run_id, layer) as log:
        for name in tables:
            log.add(name, STARTED)
            try:
                sent = Observation()
                send(store.read(GOLD, name).drop(SALES_MONTH).observe(sent, F.count(F.lit(1)).alias("rows")), name)
                log.add(name, SUCCESS, records_out=sent.get["rows"])
            except Exception as error:
                log.add(name, FAILED, error=str(error))
                failures[name] = error
    raise_failures(layer, failures)


def publish_to_database(
    store: TableStore,
    run_id: str,
    target: JdbcTarget,
    tables: Iterable[str] = GOLD_TABLES,
    connections: int | None = None,
) -> None:
    """Overwrite database tables so that they mirror Gold."""
    _publish_each(
        store, run_id, SQL_EXPORT, tables, lambda df, name: write_jdbc(df, target, name, connections=connections)
    )


def save_all_to_catalog(
    store: TableStore, run_id: str, database: str, tables: Iterable[str] = GOLD_TABLES, location: str | None = None
) -> None:
    """Overwrite managed tables of a catalog database."""
    _publish_each(
        store, run_id, CATALOG_SYNC, tables, lambda df, name: save_to_catalog(df, database, name, location)
    )
