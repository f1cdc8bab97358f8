"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes partitions, splits skewed ones and picks broadcast
# joins from measured sizes, so no partition count is fixed here. A join side is
# broadcast up to 64 MB, by file statistics or as measured at run time.
SESSION_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "stratamart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SESSION_CONF`; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, the checkpoint folder of the running context serves. Only a
    local master may fall back to a temporary folder: there the driver and the executors
    are one process on one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stratamart-"))
    return context.getCheckpointDir()


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_folder`."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    Unlike a checkpoint, the files are read with pruned columns and pushed filters.
    """
    path = new_work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
