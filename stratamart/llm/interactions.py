"""Interaction of text filters: what each removes in any order; duplicates found by radix text tries."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping
from hashlib import blake2b
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import framed, small_batches, stored

#: Text of one trie partition, its bytes as in the table.
RANGE_BYTES = 32 << 20
#: Partitions at most; larger ones stream through their task, whose tries stay small.
MAX_RANGES = 20_000
#: Rows looked at per partition to place the bounds. Bounds balance work, results do not depend on them.
LOOKS = 32
#: Code points of the first prefixes, their growth, and the longest ones.
FIRST_PREFIX, GROWTH, LONGEST_PREFIX = 16, 4, 4096
#: Bytes of texts in a trie after which it is traversed and a new one begun.
TRIE_BYTES = 16 << 20


def word_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that is not null."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


class Node:
    """A node of a trie; where a text ends, its smallest id and the rows (part, mask) that have it."""

    __slots__ = ("edges", "least", "rows")

    def __init__(self):
        self.edges: dict[str, tuple[str, Node]] = {}
        self.least = None
        self.rows: dict[tuple[str, int], int] | None = None


def shared_length(label: str, text: str, at: int) -> int:
    """Length of the longest prefix of ``label`` that stands in ``text`` at ``at``."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """A compressed trie of whole texts."""

    def __init__(self):
        self.root, self.bytes = Node(), 0

    def terminal(self, text: str) -> Node:
        """The node where ``text`` ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = (text[at:], leaf)
                self.bytes += len(text) - at + 400
                return leaf
            label, child = edge
            if not text.startswith(label, at):
                k = shared_length(label, text, at)
                middle = Node()
                middle.edges[label[k]] = (label[k:], child)
                node.edges[text[at]] = (label[:k], middle)
                self.bytes += 400
                label, child = label[:k], middle
            node, at = child, at + len(label)
        return node

    def insert(self, text: str, doc_id, row: tuple[str, int], n: int) -> Iterator[tuple]:
        """Add rows of one document; yields the rows that a smaller id than theirs just made duplicates."""
        node = self.terminal(text)
        if node.rows is None or doc_id < node.least:
            for (part, mask), count in (node.rows or {}).items():
                yield node.least, part, mask, count, True
            node.least, node.rows = doc_id, {row: n}
        elif doc_id == node.least:
            node.rows[row] = node.rows.get(row, 0) + n
        else:
            yield doc_id, *row, n, True

    def traverse(self) -> Iterator[tuple]:
        """The rows that hold the smallest id of their text."""
        below = [self.root]
        while below:
            node = below.pop()
            below += [child for _, child in node.edges.values()]
            for (part, mask), count in (node.rows or {}).items():
                yield node.least, part, mask, count, False


def prefix_bounds(texts: DataFrame, parts: int, rows: int) -> list[str]:
    """Texts' prefixes in ascending order that cut ``texts`` into about ``parts`` ranges of equal size.

    Prefixes are as long as balance needs: where one covers more than a range and its
    texts differ, prefixes four times as long take its place. What reaches the driver is
    at most ``LOOKS`` prefixes a range; copies of one text stay in one range.
    """
    if parts < 2:
        return []
    # Bounds only balance the tries, so a look at some rows is enough.
    looks = texts.sample(min(1.0, LOOKS * parts / max(1, rows)), 5).select(
        "text", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("hash")
    )

    def heads(length: int, among: list[str] | None) -> list[tuple[str, int, bool]]:
        some = looks if among is None else looks.where(F.substring("text", 1, length // GROWTH).isin(among))
        grouped = some.groupBy(F.substring("text", 1, length).alias("head")).agg(
            F.sum("bytes").alias("bytes"), (F.min("hash") != F.max("hash")).alias("differ")
        )
        return [tuple(r) for r in grouped.collect()]

    known = {head: (size, differ) for head, size, differ in heads(FIRST_PREFIX, None)}
    share = sum(size for size, _ in known.values()) / parts
    length, heavy = FIRST_PREFIX, [h for h, (size, differ) in known.items() if differ and size > share]
    while heavy and length < LONGEST_PREFIX:
        length *= GROWTH
        longer = heads(length, heavy)
        for head in heavy:
            del known[head]
        known.update({head: (size, differ) for head, size, differ in longer})
        heavy = [head for head, size, differ in longer if differ and size > share]
    bounds, held = [], 0
    for head in sorted(known):
        size = known[head][0]
        if held and held + size > share:
            bounds.append(head)
            held = 0
        held += size
    return bounds


def duplicate_masks(docs: DataFrame, filters: Mapping[str, Column], bit: int) -> DataFrame:
    """Rows (doc_id, part, mask, n): documents by the filters they fail; ``bit`` marks those that repeat a smaller id's text.

    ``docs`` has doc_id, part and text without nulls in the last two and must give the
    same rows again when read again, as files do. Texts cross the network once: a task
    sends a text on when it has no smaller id for it, and knows the others as duplicates.
    """
    checked = docs.select("doc_id", "part", "text", sum((c.cast("int") * F.lit(1 << k) for k, c in enumerate(filters.values())), F.lit(0)).alias("mask"))
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, min(MAX_RANGES, -(-size // RANGE_BYTES)))
    parts = max(parts, min(docs.sparkSession.sparkContext.defaultParallelism * 2, rows))
    bounds = prefix_bounds(docs, parts, rows)
    parts = len(bounds) + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows with the range of their text; rows that are decided go without text to any partition."""
        seen: dict[bytes, object] = {}
        turn = TaskContext.get().partitionId()
        for batch in batches:
            counts: dict[tuple, int] = {}
            least: dict[str, object] = {}
            for doc_id, part, text, mask in zip(batch["doc_id"], batch["part"], batch["text"], batch["mask"], strict=True):
                doc_id = None if pd.isna(doc_id) else doc_id
                key = (doc_id, part, text, mask)
                counts[key] = counts.get(key, 0) + 1
                if doc_id is not None and (text not in least or doc_id < least[text]):
                    least[text] = doc_id
            placed = {}
            for text, doc_id in least.items():
                digest = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=32).digest()
                if seen.setdefault(digest, doc_id) >= doc_id:
                    seen[digest] = doc_id
                    placed[text] = bisect_right(bounds, text)
            out = []
            for (doc_id, part, text, mask), n in counts.items():
                if doc_id is not None and text in placed and doc_id == least[text]:
                    out.append((placed[text], doc_id, part, mask, n, None, text))
                else:
                    turn += 1
                    out.append((turn % parts, doc_id, part, mask, n, doc_id is not None, None))
            yield framed(out, "to", "doc_id", "part", "mask", "n", "fails", "text")

    def sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Decided rows pass; the others go through tries. Equal texts follow each other, so a full trie may end between two texts."""
        trie, last = RadixTrie(), None
        for batch in batches:
            out = []
            for doc_id, part, mask, n, fails, text in zip(*(batch[c] for c in ("doc_id", "part", "mask", "n", "fails", "text")), strict=True):
                if not isinstance(text, str):
                    out.append((None if pd.isna(doc_id) else doc_id, part, mask, n, bool(fails)))
                    continue
                if trie.bytes > TRIE_BYTES and text != last:
                    out += trie.traverse()
                    trie = RadixTrie()
                out += trie.insert(text, doc_id, (part, mask), n)
                last = text
            yield framed([(d, p, m | bit if again else m, n) for d, p, m, n, again in out], "doc_id", "part", "mask", "n")
        yield framed([(d, p, m, n) for d, p, m, n, _ in trie.traverse()], "doc_id", "part", "mask", "n")

    kind = docs.schema["doc_id"].dataType.simpleString()
    spread = small_batches(checked).mapInPandas(place, f"to int, doc_id {kind}, part string, mask int, n long, fails boolean, text string")
    return (
        spread.repartitionById(parts, "to").sortWithinPartitions("text")
        .select("doc_id", "part", "mask", "n", "fails", "text")
        .mapInPandas(sift, f"doc_id {kind}, part string, mask int, n long")
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang", filters=word_filters, duplicate: str = "E") -> DataFrame:
    """What each text filter and the duplicate filter remove in every order, per part of the corpus.

    ``filters`` gives failure conditions by letter for a text column; ``duplicate`` names
    the filter that fails documents whose text a smaller doc_id has anywhere in the
    table. Returns part, filter_order, step, filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, one row per part, order and step.

    Null texts count as empty ones, which repeat each other; a null part is the empty
    string. A null id is no smaller than any: its document neither fails as a duplicate
    nor makes others fail, and has no labels. Rows that share id and text do not fail
    each other. Repeated labels of an id count once, as 1 if any is 1. Without documents
    there are no rows; other columns are not read. Masks of all documents are reduced to
    counts before the orders come in.
    """
    letters = [*filters(F.col("text")), duplicate]
    texts = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    flagged = duplicate_masks(texts, filters(F.col("text")), 1 << (len(letters) - 1))
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")
    )
    counted = flagged.join(marks, F.col("doc_id") == F.col("_id"), "left").groupBy(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    ).agg(F.sum("n").alias("n"))
    return every_order(stored(counted, "masks"), letters)


def every_order(counted: DataFrame, letters: list[str]) -> DataFrame:
    """Counts by (part, mask, good, toxic) applied to all orders of the filters."""
    orders = permutations(range(len(letters)))
    names = F.lit(["".join(letters[k] for k in order) for order in orders])
    steps = counted.select("*", F.explode(names).alias("filter_order")).select("*", F.posexplode(F.split("filter_order", "")).alias("step", "filter"))
    bits = F.create_map(*[F.lit(x) for k, letter in enumerate(letters) for x in (letter, 1 << k)])
    steps = steps.withColumn("bit", bits[F.col("filter")]).withColumn(
        "earlier", F.aggregate(F.split(F.expr("left(filter_order, step)"), ""), F.lit(0), lambda a, x: a.bitwiseOR(F.coalesce(F.try_element_at(bits, x), F.lit(0))))
    )
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    # A filter comes first among the j that a document fails in one of j orders.
    first_in = F.create_map(*[F.lit(x) for j in range(1, len(letters) + 1) for x in (j, factorial(len(letters)) // j)])

    def total(condition: Column, times: Column | None = None) -> Column:
        amount = F.col("n") if times is None else F.col("n") * times
        return F.sum(F.when(condition, amount).otherwise(F.lit(0))).cast("long")

    return steps.groupBy("part", "filter_order", (F.col("step") + 1).alias("step"), "filter").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
        total(fails, first_in[F.bit_count("mask")]).alias("shapley"),
    )
