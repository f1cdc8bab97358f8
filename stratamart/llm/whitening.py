"""Whitening of embeddings: exact covariances from variances of single dimensions and of sums of two."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored

#: Components that are returned.
COMPONENTS = 4
#: Integers leave a task as two parts of this many bits, so that sums of decimals stay exact.
LIMB = 62
LONGEST = (1 << 63) - 1


def integers(vector: Column) -> Column:
    """Entries c of a vector as long floor(256 * c); entries beyond a long take the nearest long."""
    return F.transform(vector, lambda c: (F.floor(256 * c.cast("double")) + 0).cast("long"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors of a batch as rows of a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def totals(rows: DataFrame, dimensions: int, sums: Callable[[np.ndarray], np.ndarray], growth: int) -> list[int]:
    """Sums over all vectors of what ``sums`` adds up for a matrix, as exact integers.

    ``growth`` is the degree of a term in the entries: batches whose sums might leave 64
    bits are added up as Python integers. A task sends one row per sum; their number
    depends on the dimensions alone.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            x = matrix(batch.column(0), dimensions)
            if not len(x):
                continue
            largest = max(abs(int(x.min())), abs(int(x.max())), 1) * 4
            if largest**growth * len(x) > LONGEST:
                x = x.astype(object)
            part = sums(x).astype(object)
            held = part if held is None else held + part
        if held is not None:
            values = [int(v) for v in held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(values)), pa.int32()),
                    pa.array([v >> LIMB for v in values], pa.decimal128(38, 0)),
                    pa.array([v & ((1 << LIMB) - 1) for v in values], pa.decimal128(38, 0)),
                ],
                ["at", "high", "low"],
            )

    parts = small_batches(rows).mapInArrow(add, "at int, high decimal(38,0), low decimal(38,0)")
    found = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("at").collect()
    return [(int(r["high"]) << LIMB) + int(r["low"]) for r in found]


def pair_squares(x: np.ndarray, base: list[int]) -> np.ndarray:
    """Sums of squares of every dimension less its ``base``, then of every sum of two such dimensions."""
    y = x - np.array(base, x.dtype)
    return np.concatenate([(y * y).sum(0), *[((y[:, i + 1 :] + y[:, i : i + 1]) ** 2).sum(0) for i in range(y.shape[1])]])


class Axes:
    """Mean, eigenvalues and unit eigenvectors of a list of distinct integer vectors."""

    def __init__(self, n: int, sums: list[int], squares: list[int], keep: int):
        d = len(sums)
        self.n = n
        # x - S/n is (x - base) - rest/n with whole parts in the first term.
        self.base = [s // n for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.base, strict=True)]
        own = [n * q - r * r for q, r in zip(squares, self.rest)]
        covariance, at = np.zeros((d, d)), d
        for i in range(d):
            covariance[i, i] = own[i] / (n * n)
            for j in range(i + 1, d):
                both = n * squares[at] - (self.rest[i] + self.rest[j]) ** 2
                covariance[i, j] = covariance[j, i] = (both - own[i] - own[j]) / (2 * n * n)
                at += 1
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:keep]
        self.values, self.vectors = values[order], vectors[:, order]
        largest = np.abs(self.vectors).argmax(0)
        self.vectors = self.vectors * np.sign(self.vectors[largest, range(len(order))])
        # Eigenvalues that rounding cannot tell from 0 have no whitened values.
        self.flat = self.values <= 4 * d * np.finfo(float).eps * max(values[-1], 0.0)
        trace = float(sum(own)) / (n * n) if sum(own) else 0.0
        self.explained = [None if not trace else 0.0 if flat else float(e) / trace for e, flat in zip(self.values, self.flat)]

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Values of centred integer vectors on each component, spread 1; NaN on components without spread."""
        centred = y.astype(float) - np.array(self.rest, float) / self.n
        scale = np.where(self.flat, np.nan, np.sqrt(np.where(self.flat, 1.0, self.values)))
        return centred @ self.vectors / scale

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S) ** 2; None where a long cannot hold it."""
        d, largest = y.shape[1], int(np.abs(y).max(initial=1)) if len(y) else 1
        exact = y if max(largest, self.n) * largest * d <= LONGEST else y.astype(object)
        squares, mixed = (exact * exact).sum(1), exact @ np.array(self.rest, dtype=exact.dtype)
        constant = sum(r * r for r in self.rest)
        found = (self.n * self.n * int(a) - 2 * self.n * int(b) + constant for a, b in zip(squares, mixed))
        return [v if v <= LONGEST else None for v in found]


def projected(rows: DataFrame, axes: Axes) -> DataFrame:
    """The columns of ``rows`` beside x, with ``deviation`` and the list ``whitened``."""
    others = [c for c in rows.columns if c != "x"]
    d, k = len(axes.base), len(axes.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.array(axes.base, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), d)
            spread = int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, axes.base))
            y = x - base if spread < LONGEST // 2 else x.astype(object) - np.array(axes.base, object)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            values = pa.array(axes.whitened(y).ravel(), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(axes.deviations(y), pa.int64()), pa.ListArray.from_arrays(offsets, values)],
                [*others, "deviation", "whitened"],
            )

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in others)
    return small_batches(rows.select("x", *others)).mapInArrow(project, f"{kinds}deviation long, whitened array<double>")


def whitened_components(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: int = COMPONENTS) -> DataFrame:
    """Whitened values of every vector on the leading components of all distinct ones.

    Returns ``key``, component, n, deviation, whitened, explained, identity_error: per
    remaining row and component. Rows go whose vector is null, empty, or holds null, NaN
    or infinite entries; of vectors of several lengths those of the most frequent length
    stay (the longest of equally frequent). Keys may be null or repeat, each row has its
    own result; other columns are not read. Entries become integers; mean and covariances
    come from the distinct vectors by exact sums: squares of each centred dimension and
    of each sum of two. The driver holds one number per pair of dimensions. On components
    without spread, as beyond the rank, ``whitened`` is null and ``explained`` 0.0 (null if
    there is no spread at all); ``identity_error`` covers the others and is null without
    any. ``deviation`` is null where a long cannot hold it. Without vectors there are no rows.
    """
    spark = vectors.sparkSession
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    sound = vectors.where(F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(fine, F.lit(False)))
    lengths = sound.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kind = vectors.schema[key].dataType.simpleString()
    if lengths is None:
        return spark.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    d = lengths["d"]
    rows = sound.where(F.size(vector) == d).select(integers(F.col(vector)).alias("x"), key)
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    n = fit.count()
    sums = totals(fit, d, lambda x: x.sum(0), 1)
    base = [s // n for s in sums]
    squares = totals(fit, d, lambda x: pair_squares(x, base), 2)
    axes = Axes(n, sums, squares, min(keep, d))
    live = [c for c, flat in enumerate(axes.flat) if not flat]
    error = None
    if live:
        pairs = [(a, b) for a in live for b in live if a <= b]
        moments = projected(fit, axes).agg(*[F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs]).first()
        error = max(abs(v - (a == b)) for (a, b), v in zip(pairs, moments, strict=True))
    explained = F.lit(axes.explained) if any(e is not None for e in axes.explained) else F.lit(None).cast("array<double>")
    return projected(rows, axes).select(key, "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        key, (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("_at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
