"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(columns: Iterable[str], unambiguous: bool = False) -> Column:
    """SHA-256 hex of the columns joined by ``||``; NULL counts as empty text.

    A value that holds ``||`` can then equal two values. With ``unambiguous`` every value
    is preceded by its length in characters and NULL has a mark of its own, so different
    rows have different texts.
    """
    texts = [F.col(name).cast("string") for name in columns]
    if unambiguous:
        return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)
    return F.sha2(F.concat_ws("||", *[F.coalesce(t, F.lit("")) for t in texts]), 256)
