"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: each phrase is the shortest run of code points
that the dictionary lacks. The set of phrases says what a compressor would learn from
the text. Its smallest hashes are the fingerprint, and two fingerprints estimate the
Jaccard likeness of two phrase sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, UNBASE, encoded, framed, mixed, powers, small_batches

#: Hashes in a fingerprint. Sets of so many phrases at most are compared exactly.
KEPT = 128


def parse(
    text: str, root: dict | None = None, ends: list[int] | None = None, node: dict | None = None, start: int = 0,
    parents: list[dict] | None = None,
):
    """The tree of all phrases of ``text``, their ends, and the node at which the open phrase stands.

    A node of the tree maps a code point to the node of the phrase that is longer by it,
    so every code point is looked up once. To go on from ``start``, give what an earlier
    call returned. ``parents`` gets the node that each new phrase was hung on.
    """
    root = {} if root is None else root
    ends = [] if ends is None else ends
    node = root if node is None else node
    hung = [] if parents is None else parents
    for at, point in enumerate(text[start:] if start else text, start + 1):
        longer = node.get(point)
        if longer is None:
            node[point] = {}
            hung.append(node)
            ends.append(at)
            node = root
        else:
            node = longer
    return root, ends, node


#: Spread values of the most usual code points.
CODES = mixed(np.arange(1, (1 << 13) + 1, dtype=np.uint64))


class Codes:
    """Hashes of slices of one text by code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        small = not len(codes) or codes.max() < len(CODES)
        spread = CODES[codes.astype(np.int64)] if small else mixed(codes + np.uint64(1))
        np.cumsum(spread * powers(len(codes), BASE), out=self.sums[1:])
        self.back = powers(len(codes) + 1, UNBASE)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def smallest(text: str, starts: list[int], ends: list[int]) -> np.ndarray:
    """The :data:`KEPT` smallest hashes of the phrases, sorted."""
    hashes = Codes(text).of(np.array(starts, np.int64), np.array(ends, np.int64))
    # Phrases are distinct, so twice as many hashes hold enough distinct ones unless hashes collide.
    if len(hashes) > 2 * KEPT:
        few = np.unique(np.partition(hashes, 2 * KEPT - 1)[: 2 * KEPT])
        if len(few) >= KEPT:
            return few[:KEPT]
    return np.unique(hashes)[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among the smallest of both; 1.0 for two empty sets."""
    both = np.union1d(a, b)[:KEPT]
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


class Parsed:
    """A text's phrases, its fingerprint, and its tree as of the end of its first half."""

    def __init__(self, text: str | None):
        self.text = text if isinstance(text, str) else ""
        self.keep = len(self.text) - len(self.text) // 2
        self.root, self.ends, self.node = parse(self.text[: self.keep])
        ends = self._on(self.text)
        self.own = smallest(self.text, [0, *ends[:-1]] if ends else [], ends)

    def _on(self, text: str) -> list[int]:
        """Ends of the phrases of ``text``, which begins with the first half; the tree is as before afterwards."""
        parents: list[dict] = []
        _, ends, _ = parse(text, self.root, list(self.ends), self.node, self.keep, parents)
        for parent, end in zip(parents, ends[len(self.ends) :], strict=True):
            del parent[text[end - 1]]
        return ends

    def edited(self, following: Parsed) -> tuple[str, np.ndarray]:
        """The text whose second half is the beginning of ``following``, and its fingerprint.

        Both texts share the parse of the first half, which does not depend on what comes after.
        """
        text = self.text[: self.keep] + following.text[: len(self.text) - self.keep]
        ends = self._on(text)
        return text, smallest(text, [0, *ends[:-1]] if ends else [], ends)


#: Buckets at most; rows of a bucket stream through its task, so their number is not bounded.
MAX_BUCKETS = 20_000


def bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above an id, by a coarse and a fine look; -1 for null."""
    if not bounds:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.size(F.filter(F.lit(bounds[step - 1 :: step]), lambda b: b <= doc_id)) * step
    fine = F.size(F.filter(F.slice(F.lit(bounds), coarse + 1, F.lit(step)), lambda b: b <= doc_id))
    return F.when(doc_id.isNull(), -1).otherwise(coarse + fine)


def in_order(docs: DataFrame, per_bucket: int) -> DataFrame:
    """``docs`` in buckets of ascending ids, each followed by a copy of the row that comes next.

    Bucket bounds come from a scan of the ids alone. Texts are shuffled once, plus one
    row per bucket; a task streams through its buckets.
    """
    rows = docs.agg(F.count("doc_id")).first()[0]
    cuts = min(MAX_BUCKETS, rows // per_bucket)
    bounds: list[int] = []
    if cuts > 1:
        shares = [k / cuts for k in range(1, cuts)]
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10 * cuts)).first()[0]))
    placed = docs.select("doc_id", "text", bucket_of(F.col("doc_id"), bounds).alias("_bucket"), F.xxhash64("text").alias("_hash"))
    least = placed.groupBy("_bucket").agg(F.min(F.struct("doc_id", "_hash")).alias("_first")).collect()
    firsts = sorted((r["_bucket"], r["_first"]["doc_id"], r["_first"]["_hash"]) for r in least)
    # The first row of a bucket also ends the bucket before it; the very first ends the last.
    heads = docs.sparkSession.createDataFrame(
        [(firsts[k - 1][0], *firsts[k]) for k in range(len(firsts))], "_before int, _own int, _id long, _same long"
    )
    met = (F.col("_bucket") == F.col("_own")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_same"))
    copies = placed.join(F.broadcast(heads), met).dropDuplicates(["_before"])
    copies = copies.select("doc_id", "text", F.col("_before").alias("_bucket"), "_hash", F.lit(True).alias("_end"))
    both = placed.withColumn("_end", F.lit(False)).unionByName(copies)
    parts = max(1, len(firsts) // 4)
    return both.repartition(parts, "_bucket").sortWithinPartitions("_bucket", "_end", F.col("doc_id").asc_nulls_first(), "_hash")


def phrase_fingerprints(docs: DataFrame, per_bucket: int = 1000) -> DataFrame:
    """Fingerprint of every text, of its edited text, and both likenesses.

    The edited text replaces the last half of a text by the beginning of the text that
    follows by ascending doc_id (after the last: the first). Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts
    count as empty: no phrases, an empty fingerprint, likeness 1.0 to other empty ones
    and 0.0 to the rest. Null ids come first; rows with equal ids follow each other by a
    hash of their text, and each row gets its own result. A single row follows itself.
    Other columns are not read.
    """

    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, doc_id, held = None, None, None
        for batch in batches:
            rows = []
            for to, end, number, text in zip(batch["_bucket"], batch["_end"], batch["doc_id"], batch["text"], strict=True):
                parsed = Parsed(text)
                if held is not None and bucket == to:
                    edited, new = held.edited(parsed)
                    rows.append((
                        None if pd.isna(doc_id) else int(doc_id), len(held.text), sha256(encoded(edited)).hexdigest(), as_text(held.own),
                        as_text(new), likeness(held.own, new), likeness(held.own, parsed.own),
                    ))
                bucket, doc_id, held = to, number, None if end else parsed
            yield framed(rows, *columns)

    return in_order(small_batches(docs.select("doc_id", "text")), per_bucket).select("_bucket", "_end", "doc_id", "text").mapInPandas(
        walk,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
