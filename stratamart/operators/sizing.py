"""Size-checked broadcast joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow join side that are safe to hold on every executor (tens of MB).
MAX_BROADCAST_ROWS = 500_000


def broadcast_within(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit, else unchanged.

    Without the hint the join shuffles both sides and adaptive execution splits
    partitions of hot keys. Pass frames that are cheap to count: stored tables or
    checkpointed results.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
