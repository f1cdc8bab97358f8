"""Tables, scratch tables and text helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import new_work_folder

#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\x0b\x0c\r"
#: An odd multiplier for hashes of sequences.
M64 = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    The files outlive any executor and are read with pruned columns.
    """
    path = new_work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends tasks' rows to Python in batches of a few megabytes.

    Texts of any length then take bounded memory beside the executor's heap.
    """
    for key, most, text in (("maxRecordsPerBatch", 2000, "2000"), ("maxBytesPerBatch", 4 << 20, "4194304b")):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(df.sparkSession.conf.get(name).removesuffix("b"))
        if now <= 0 or now > most:
            df.sparkSession.conf.set(name, text)
    return df


def apart(docs: DataFrame, needed: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of ``docs``, whose columns but the ``needed`` ones it sees as one.

    ``work`` filters or changes rows and keeps that one column, so whatever the others
    are named, they meet no column of its own and come back as they were. Columns that
    ``work`` adds follow those of ``docs``; a name that is taken gets a number.
    """
    wanted = {name.lower() for name in needed}
    named = [c for c in docs.columns if c.lower() in wanted]
    others = [c for c in docs.columns if c.lower() not in wanted]
    if not others:
        return work(docs)
    packed = docs.select(*named, F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)]).alias("_packed"))
    made = work(packed)
    taken, added = {c.lower() for c in docs.columns}, []
    for c in made.columns:
        if c not in named and c != "_packed":
            free = next(n for k in count(1) if (n := c if k == 1 else f"{c}_{k}").lower() not in taken)
            taken.add(free.lower())
            added.append(F.col(f"`{c}`").alias(free))
    return made.select(*[F.col(f"`{c}`") if c in named else F.col("_packed")[f"c{others.index(c)}"].alias(c) for c in docs.columns], *added)


def framed(rows: list[tuple], *names: str) -> pd.DataFrame:
    """Rows of plain values as a frame whose columns keep their types, None and lists included."""
    return pd.DataFrame(rows, columns=list(names), dtype=object)


def encoded(text: str | None) -> bytes:
    """UTF-8 of ``text``; empty for whatever stands for null in a batch."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def mixed(h: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64; the longest table so far is kept."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _POWERS[base] = out
    return _POWERS[base][:n]


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))
#: An odd multiplier of the rolling hashes, and what undoes it modulo 2 ** 64.
BASE = 0x5851F42D4C957F2D
UNBASE = pow(BASE, -1, 1 << 64)


class Rolling:
    """Hashes of any slices of one byte string in constant time each (Karp-Rabin, modulo 2 ** 64)."""

    def __init__(self, data: bytes):
        codes = BYTE_CODES[np.frombuffer(data, np.uint8)]
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(len(codes), BASE), out=self.sums[1:])
        self.back = powers(len(codes) + 1, UNBASE)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


IS_SPACE = np.array([b in SPACES for b in range(256)])


def word_bounds(data: bytes, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``; ``separators`` says which bytes separate."""
    space = separators[np.frombuffer(data, np.uint8)]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


SHINGLE = 5


def shingles(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``words`` words of ``text`` with A-Z lower-cased, by place.

    Shorter texts are one run; without words there is none.
    """
    data = encoded(text).lower()
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    hashes = Rolling(data).of(starts, ends) + (ends - starts).astype(np.uint64)
    n = min(words, len(hashes))
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= M64
        out += hashes[k : k + len(out)]
    return mixed(out + np.uint64(n))
