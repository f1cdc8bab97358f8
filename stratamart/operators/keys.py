"""Dense surrogate keys over a global order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.session import stored


def dense_surrogate_key(
    df: DataFrame, order: Sequence[str | Column], name: str, key_type: str = "int"
) -> DataFrame:
    """Number rows 1..N in ``order``, which must be a total order.

    The rows are range-sorted once and stored, a file per range. A row's number is its
    place in its file plus the rows of all earlier files, which are one small number per
    file. Files do not change, so neither do numbers, and readers prune columns. No task
    sees more than its own range, and a key with many versions may span several.
    """
    rows = stored(df.orderBy(*order), "ordered").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place")
    )
    # One number per file, so no more of them than the sort had ranges.
    counts = {r["_file"]: r["count"] for r in rows.groupBy("_file").count().collect()}
    starts, before = [], 0
    for file in sorted(counts, key=_file_number):
        starts.append((file, before))
        before += counts[file]
    first = df.sparkSession.createDataFrame(starts, "_file string, _start bigint")
    return rows.join(F.broadcast(first), "_file").select(
        (F.col("_start") + F.col("_place") + 1).cast(key_type).alias(name), *df.columns
    )


def _file_number(name: str) -> tuple[int, int]:
    """Writers number their files; a task that fills several numbers these as well."""
    task, part = re.match(r"part-(\d+)", name), re.search(r"-c(\d+)[.]", name)
    return int(task[1]) if task else 0, int(part[1]) if part else 0
