"""Benchmark decontamination by greedy string tiling.

Seeds, runs of a few tokens, of documents and benchmark items are joined; documents drop
those that a filter of the items' seeds does not know before anything is shuffled. Pairs
that share enough seeds are tiled: the longest common runs that do not overlap are marked
one after another, so passages in another order are found as well. A document is
contaminated by an item of whose tokens its tiles cover enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sized

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import M64, Rolling, encoded, framed, mixed, small_batches, stored, word_bounds

#: Shortest tile in tokens, and least covered share of an item.
MIN_TILE, COVER = 5, 0.6
#: Bits of the filter per seed of the benchmark, and in all: 16 MB. Beyond, it lets more seeds through to the join.
SEED_BITS, FILTER_BITS = 64, 1 << 27

NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def token_hashes(text: str | None) -> np.ndarray:
    """A hash of every lower-cased word of ``text``; whatever ASCII is no letter or digit separates."""
    data = encoded(text.lower() if isinstance(text, str) else None)
    starts, ends = word_bounds(data, NO_WORD)
    if not len(starts):
        return np.empty(0, np.uint64)
    return mixed(Rolling(data).of(starts, ends) + (ends - starts).astype(np.uint64))


def windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` tokens."""
    out = np.zeros(max(0, len(tokens) - size + 1), np.uint64)
    for k in range(size if len(out) else 0):
        out = mixed(out * M64 + tokens[k : k + len(out)])
    return out


def tiles(item: Sized, doc: Sized, shortest: int = MIN_TILE, seeds: dict | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, doc start, length), longest first, then by item and doc start.

    Seeds are equal runs of ``shortest`` tokens, item starts by how far the document's
    start lies behind; where they are given, only the sides' lengths matter. On each diagonal they join into maximal
    matches; each round marks the longest one of unmarked tokens on both sides.
    """
    if seeds is None:
        places = defaultdict(list)
        for i, h in enumerate(windows(item, shortest).tolist()):
            places[h].append(i)
        seeds = defaultdict(list)
        for d, h in enumerate(windows(doc, shortest).tolist()):
            for i in places.get(h, ()):
                seeds[d - i].append(i)
    runs = []
    for shift, starts in seeds.items():
        for i in sorted(starts):
            if runs and runs[-1][0] == shift and runs[-1][2] >= i:
                runs[-1][2] = i + shortest
            else:
                runs.append([shift, i, i + shortest])
    # Longest first; a run that meets marked tokens is cut to its free parts and queued again.
    by_length = defaultdict(list)
    for shift, a, b in runs:
        by_length[b - a].append((a, a + shift))
    used_item, used_doc, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    for length in range(max(by_length, default=0), shortest - 1, -1):
        for a, d in sorted(by_length.pop(length, ())):
            busy = used_item[a : a + length] | used_doc[d : d + length]
            if not busy.any():
                out.append((a, d, length))
                used_item[a : a + length] = True
                used_doc[d : d + length] = True
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([True], busy, [True])).astype(np.int8)))
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if hi - lo >= shortest:
                    by_length[hi - lo].append((a + lo, d + lo))
    return out


class SeedFilter:
    """Bits of the seeds of the benchmark, two a seed: what it does not hold is no seed of any item."""

    def __init__(self, bits: int, places: np.ndarray, words: np.ndarray):
        self.mask = np.uint64(bits - 1)
        self.words = np.zeros(bits >> 6, np.uint64)
        self.words[places] = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for bit in (hashes & self.mask, (hashes >> np.uint64(32)) & self.mask):
            out &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def filter_of(seeds: DataFrame) -> SeedFilter:
    """The filter of ``hash`` of ``seeds``; its words are put together in tasks, at most :data:`FILTER_BITS` reach the driver."""
    n = seeds.select("hash").distinct().count()
    bits = min(FILTER_BITS, 1 << max(6, (SEED_BITS * n - 1).bit_length() if n else 6))
    h, last = F.col("hash"), F.lit(bits - 1).cast("long")
    bit = F.explode(F.array(h.bitwiseAND(last), F.shiftrightunsigned(h, 32).bitwiseAND(last)))
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    got = seeds.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("place")).agg(F.bit_or(one).alias("word")).toPandas()
    return SeedFilter(bits, got["place"].to_numpy(np.int64), got["word"].to_numpy(np.int64).view(np.uint64))


def item_seeds(items: DataFrame, shortest: int) -> DataFrame:
    """Seeds of items (item, text): hash, size in tokens, item, at, words of the item.

    An item shorter than a seed is one of its own length.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"], strict=True):
                tokens = token_hashes(text)
                size = min(shortest, len(tokens))
                got = windows(tokens, size) if size else tokens
                yield pd.DataFrame({"hash": got.view(np.int64), "size": size, "item": int(item), "at": np.arange(len(got)), "words": len(tokens)})

    return items.select("item", "text").mapInPandas(cut, "hash long, size int, item long, at int, words int")


def document_seeds(docs: DataFrame, known: SeedFilter, sizes: list[int], shortest: int) -> DataFrame:
    """Seeds of ``text`` of ``docs`` that the filter holds, by :func:`text_key`: key, hash, size, at.

    Of seeds shorter than ``shortest``, which are whole items, one place is enough.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                tokens = token_hashes(text)
                for size in sizes:
                    got = windows(tokens, size)
                    at = np.flatnonzero(sent.value.holds(got))
                    if size < shortest and len(at):
                        at = at[np.unique(got[at], return_index=True)[1]]
                    if len(at):
                        out.append(pd.DataFrame({"key": key, "hash": got[at].view(np.int64), "size": size, "at": at}))
            if out:
                yield pd.concat(out, ignore_index=True)

    rows = small_batches(docs).where("text is not null").select(text_key(F.col("text")).alias("key"), "text")
    # Copies share their key, so their seeds become one set before the join.
    return rows.mapInPandas(cut, "key string, hash long, size int, at int").distinct()


def text_key(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tiled(docs: DataFrame, benchmark: DataFrame, cover: float, shortest: int) -> DataFrame:
    """Texts of ``docs`` that items contaminate: leak (the text's key), item_id, n_tiles, n_tokens, coverage."""
    items = stored(benchmark.select("item_id", "text").distinct().withColumn("item", F.monotonically_increasing_id()), "leak-items")
    of_items = stored(item_seeds(small_batches(items), shortest), "leak-item-seeds")
    sizes = sorted(r["size"] for r in of_items.select("size").distinct().collect())  # at most ``shortest`` numbers
    of_docs = stored(document_seeds(docs, filter_of(of_items), sizes, shortest), "leak-document-seeds")
    met = of_docs.withColumnRenamed("at", "there").join(of_items, ["hash", "size"])
    pairs = met.groupBy("key", "item", "words", "size").agg(F.collect_list(F.struct("at", "there")).alias("seeds"))
    # What seeds reach bounds what tiles can cover, so most chance hits need no tiling.
    pairs = pairs.where(F.size(F.array_distinct("seeds.at")) * F.col("size") >= F.col("words") * cover)

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for key, item, words, size, seeds in batch[["key", "item", "words", "size", "seeds"]].itertuples(index=False):
                shifts = defaultdict(list)
                for seed in seeds:
                    shifts[seed["there"] - seed["at"]].append(seed["at"])
                reach = max(seed["there"] for seed in seeds) + size
                got = tiles(range(words), range(reach), size, shifts)
                n = sum(length for *_, length in got)
                if n >= cover * words:
                    found.append((key, item, len(got), n, n / words))
            yield framed(found, "leak", "item", "n_tiles", "n_tokens", "coverage")

    got = pairs.mapInPandas(tile, "leak string, item long, n_tiles long, n_tokens long, coverage double")
    return stored(got.join(items.select("item", "item_id"), "item").drop("item"), "leaks")


def contaminations(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, shortest: int = MIN_TILE) -> DataFrame:
    """Pairs of documents and items: doc_id, item_id, n_tiles, n_tokens, coverage.

    ``coverage`` is the share of the item's tokens that the tiles hold, at least
    ``cover``. An item with fewer than ``shortest`` words is one tile, found where all its
    words stand in a row. Items without words are never found, nor are null and empty
    documents. Repeated documents each give their rows; repeated items count once. Ids
    may be null and of any type. Other columns are not read; an empty table on either
    side gives no rows. Neither side passes the driver: texts stay where they are read,
    seeds that both sides have meet by their hash, and pairs come back to the documents
    by the hash of their text.
    """
    leaks = tiled(docs, benchmark, cover, shortest)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("leak"))
    return rows.join(leaks, "leak").select("doc_id", "item_id", "n_tiles", "n_tokens", "coverage")


def without_leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, shortest: int = MIN_TILE) -> DataFrame:
    """``docs`` that no item contaminates, all columns kept whatever their names."""
    leaks = tiled(docs, benchmark, cover, shortest).select("leak").distinct()
    return docs.join(leaks, text_key(docs["text"]) == leaks["leak"], "left_anti")
