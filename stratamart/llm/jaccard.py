"""Similarity join on word shingles by grouped prefixes.

Shingles are ordered from rare to common. Two sets that are similar enough share a
shingle among the first few of each, the prefix. Documents with one prefix and size
form a group, and groups that share a prefix shingle are candidates; their members are
verified on whole sets.

Only classes of linked documents are asked for, so not every candidate pair has to be
looked at. First each list of groups with a common shingle is tied to leaders; whatever
these links connect needs no more pairs. Then all pairs of a list whose members are
still in different classes are verified, so that no link is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, framed, mixed, shingles, small_batches, stored

#: Two sets link when ``100 * common >= PERCENT * union``.
PERCENT = 80
#: Counters that order shingles by how common they are, of which each task adds up all: 16 MB.
COUNTERS_BITS = 22
#: Rounds in which lists are tied to leaders before pairs are formed.
ROUNDS = 3
#: Lists up to this length say by pairs which groups need whole sets; of longer ones all do.
SHORT_LIST = 12
#: Bits of the filter that says which groups need whole sets, at most; it only saves work.
FILTER_BITS = 26


def counters(docs: DataFrame) -> np.ndarray:
    """In how many documents the shingles of each counter are, over all documents.

    What a task hands on has a fixed size whatever it read, and so has the sum.
    """
    pieces = 64

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(1 << COUNTERS_BITS, np.uint32)
        for batch in batches:
            for text in batch["text"]:
                # Two shingles of one text on one counter count once, which no order depends on.
                sums[(shingles(text) & np.uint64((1 << COUNTERS_BITS) - 1)).astype(np.int64)] += 1
        parts = np.split(sums, pieces)
        yield pd.DataFrame({"piece": range(pieces), "n": [zlib.compress(p.tobytes(), 1) for p in parts]})

    def add(table: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(n), np.uint32).astype(np.uint64) for n in table["n"])
        n = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32)
        return pd.DataFrame({"piece": [table["piece"].iloc[0]], "n": [zlib.compress(n.tobytes(), 1)]})

    rows = docs.select("text").mapInPandas(count, "piece int, n binary").groupBy("piece").applyInPandas(add, "piece int, n binary").collect()
    out = np.zeros(1 << COUNTERS_BITS, np.uint32)
    size = len(out) // pieces
    for row in rows:
        out[row["piece"] * size : (row["piece"] + 1) * size] = np.frombuffer(zlib.decompress(bytes(row["n"])), np.uint32)
    return out


def prefix_length(n: int) -> int:
    """How many of the first of ``n`` shingles must hold one in common with any set that links."""
    return n - (n * PERCENT + 99) // 100 + 1


def described(text: str | None, common: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray, int] | None:
    """Sorted set, its 128-bit name, prefix in order, and group (a hash of size and prefix) of a text."""
    hashes = np.unique(shingles(text))
    n = len(hashes)
    if not n:
        return None
    order = np.lexsort((hashes, common[(hashes & np.uint64(len(common) - 1)).astype(np.int64)]))
    prefix = hashes[order[: prefix_length(n)]]
    name = np.array([mixed(hashes + np.uint64(k)).sum() + np.uint64(n) for k in (0x1F, 0x2F3)], np.uint64)
    place = np.arange(1, len(prefix) + 1, dtype=np.uint64)
    group = mixed(np.array([mixed(prefix ^ (place * np.uint64(0x9E3779B97F4A7C15))).sum() + np.uint64(n)]))
    return hashes, name.tobytes(), prefix, int(group.view(np.int64)[0])


def labelled(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v): (id, label) with the smallest id reachable, for ids with an edge.

    Alternates large and small stars until no edge moves. Minima combine before each
    shuffle, and each pass is written out.
    """
    links = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "components")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "components")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return links.select(F.col("u").alias("id"), F.col("v").alias("label"))
        seen = now


def with_classes(ids: DataFrame, key: str, labels: DataFrame | None) -> DataFrame:
    """``ids`` with ``class``: the label of their component, else themselves."""
    if labels is None:
        return ids.withColumn("class", F.col(key))
    return ids.join(labels.withColumnRenamed("id", key), key, "left").withColumn("class", F.coalesce("label", key)).drop("label")


def sizes_fit(a: Column, b: Column) -> Column:
    return (a * 100 >= b * PERCENT) & (b * 100 >= a * PERCENT)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of items whose whole sets link."""
    one = sets.select(F.col("id").alias("u"), F.col("hashes").alias("_a"))
    two = sets.select(F.col("id").alias("v"), F.col("hashes").alias("_b"))
    met = pairs.join(one, "u").join(two, "v")
    common = F.size(F.array_intersect("_a", "_b"))
    return met.where(common * 100 >= (F.size("_a") + F.size("_b") - common) * PERCENT).select("u", "v")


def near_classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A set holds the distinct runs of five words; shorter texts are one run; null, empty
    and blank texts have none and link with nothing. Rows with equal sets are one class
    whatever their ids. Null ids get the smallest id of their class, null if there is
    none. Repeated ids count as the rows they are. Other columns are not read.

    ``key`` (xxhash64 of the text) tells rows apart that share an id.

    Texts are read three times and never shuffled; prefixes, a fifth of the shingles,
    are shuffled by shingle, as plain aggregates and equality joins that adaptive
    execution can split. Whole sets leave the scan only for groups that share a shingle.
    """
    spark = docs.sparkSession
    docs = small_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("key")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    common = spark.sparkContext.broadcast(counters(docs))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, key in zip(batch["doc_id"], batch["text"], batch["key"], strict=True):
                got = described(text, common.value)
                row = (None if pd.isna(doc_id) else int(doc_id), key)
                rows.append((*row, 0, None, None, None) if got is None else (*row, len(got[0]), got[1], got[3], got[2].view(np.int64)))
            yield framed(rows, "doc_id", "key", "n", "name", "group", "prefix")

    rows = stored(docs.mapInPandas(describe, f"doc_id {kind}, key long, n long, name binary, group long, prefix array<long>"), "shingles")
    # An item is a set, whatever rows have it; its id is fixed by writing it.
    items = rows.where("n > 0").groupBy("name").agg(F.min("n").alias("n"), F.min("group").alias("group"))
    items = stored(items.withColumn("id", F.monotonically_increasing_id()), "items")
    groups = rows.where("n > 0").groupBy("group").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    posted = groups.select(F.posexplode("prefix").alias("place", "token"), "group", "n")
    # Written, so that the join has an exchange of its own on both sides and can split a crowded token.
    shared = stored(posted.groupBy("token").agg(F.count("*").alias("k")).where("k > 1"), "shared")
    lists = stored(posted.join(shared, "token"), "lists")
    crowded = items.groupBy("group").agg(F.count("*").alias("k")).where("k > 1").select("group")
    a, b = lists.where(F.col("k") <= SHORT_LIST).alias("a"), lists.where(F.col("k") <= SHORT_LIST).alias("b")
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.group") < F.col("b.group")) & sizes_fit(F.col("a.n"), F.col("b.n")))
    pairs = met.groupBy(F.col("a.group").alias("u"), F.col("b.group").alias("v"), F.col("a.n").alias("n"), F.col("b.n").alias("m")).agg(F.count("*").alias("c"))
    near = pairs.where(may_link(F.col("n"), F.col("m"), F.col("c"))).select(F.explode(F.array("u", "v")).alias("group"))
    long_lists = lists.where(F.col("k") > SHORT_LIST).select("group")
    involved = stored(near.unionByName(long_lists).unionByName(crowded).distinct(), "involved")
    sets = stored(whole_sets(docs, items, involved, common), "sets")
    # Expanded to members. Those of one group are candidates of each other, so the group is one more list.
    lists = lists.select("token", "place", "group").join(involved, "group").unionByName(crowded.select(F.col("group").alias("token"), F.lit(-1).alias("place"), "group"))
    lists = stored(lists.join(items.select("group", "id", "n"), "group"), "lists")
    found, labels = None, None
    for k in range(ROUNDS + 1):
        now = with_classes(lists, "id", labels)
        open_lists = now.groupBy("token").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("token")
        now = stored(now.join(open_lists, "token"), "lists")
        # One text has a bounded prefix, and so has the window over its lists.
        own = Window.partitionBy("id")
        now = now.withColumns({"most": F.count("*").over(own), "nth": F.row_number().over(own.orderBy("place"))})
        pairs = tied(now, k) if k < ROUNDS else crossed(now)
        links = stored(verified(pairs, sets), "links")
        found = links if found is None else found.unionByName(links)
        labels = labelled(found)
    classes = with_classes(items.select("name", "id"), "id", labels)
    members = rows.select("doc_id", "key", "n", "name").join(classes.select("name", "class"), "name", "left")
    least = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    return members.join(least, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "key", "class",
    )


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of linked texts: the smallest id, null last, then by a hash of the text.

    Rows without words link with nothing and stay. All columns are kept as they are,
    whatever their names. Texts are shuffled once, to meet the rows that stay.
    """
    return apart(docs, ("doc_id", "text"), _representatives)


def _representatives(docs: DataFrame) -> DataFrame:
    classes = near_classes(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    kept = classes.where("class is not null").groupBy("class").agg(best.alias("best"))
    kept = kept.select(F.col("best.doc_id").alias("_id"), F.col("best.key").alias("_key"))
    bare = ~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    chosen = rows.where(~bare).join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")), "left_semi")
    chosen = chosen.dropDuplicates(["doc_id", "_hash"])
    return chosen.unionByName(rows.where(bare)).select(*docs.columns)


def may_link(n: Column, m: Column, c: Column) -> Column:
    """Whether sets of ``n`` and ``m`` shingles with ``c`` common ones in their prefixes can link.

    Whatever else they share is behind the prefix of one of them.
    """
    behind = F.ceil(F.greatest(n, m) * PERCENT / 100) - 1
    return (c + behind) * (100 + PERCENT) >= (n + m) * PERCENT


def counted(met: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs (u, v) of the items ``a`` and ``b`` whose common prefix shingles, one per row of ``met``, leave a link possible."""
    one_group = F.col(f"{a}.group") == F.col(f"{b}.group")
    pairs = met.groupBy(
        F.col(f"{a}.id").alias("u"), F.col(f"{b}.id").alias("v"), F.col(f"{a}.n").alias("n"), F.col(f"{b}.n").alias("m"), one_group.alias("one_group")
    ).agg(F.count("*").alias("c"))
    return pairs.where(F.col("one_group") | may_link(F.col("n"), F.col("m"), F.col("c"))).select("u", "v")


def tied(lists: DataFrame, k: int) -> DataFrame:
    """A pair with the leader of each list and size class for all its other members; leaders differ by round.

    A pair is not counted in lists that another one leads, so some pairs that could link
    are left to :func:`crossed`.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + k / ROUNDS)
    rows = lists.withColumn("band", band)
    # The first leader shares most of its prefix, as the least edited of many copies does; later ones are any.
    rank = -F.col("most") / F.col("n") if k == 0 else F.lit(0.0)
    leaders = rows.groupBy("token", "band").agg(F.min(F.struct(rank.alias("r"), F.xxhash64("id", F.lit(k)).alias("h"), "id", "n", "class", "group")).alias("m"))
    met = rows.alias("a").join(leaders.select("token", "band", "m.*").alias("b"), ["token", "band"])
    met = met.where((F.col("a.id") != F.col("b.id")) & (F.col("a.class") != F.col("b.class")) & sizes_fit(F.col("a.n"), F.col("b.n")))
    return counted(met, "a", "b")


def crossed(lists: DataFrame) -> DataFrame:
    """All pairs of a list of fitting sizes whose members are in different classes and can link.

    Two such members have all their common shingles in the lists given, in one order. A
    pair is formed only where both have enough lists left for a link; its first common
    shingle is such a place, while the many common ones at the end of near misses are not.
    """
    left = 1 + F.least(F.col("a.most") - F.col("a.nth"), F.col("b.most") - F.col("b.nth"))
    met = lists.alias("a").join(lists.alias("b"), F.col("a.token") == F.col("b.token"))
    met = met.where(
        (F.col("a.id") > F.col("b.id")) & (F.col("a.class") != F.col("b.class")) & sizes_fit(F.col("a.n"), F.col("b.n"))
        & ((F.col("a.group") == F.col("b.group")) | may_link(F.col("a.n"), F.col("b.n"), left))
    )
    return met.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def whole_sets(docs: DataFrame, items: DataFrame, involved: DataFrame, common) -> DataFrame:
    """(id, hashes) of the items of ``involved`` groups, from another scan of the texts.

    A filter of bounded size keeps most other sets from leaving the scan; the join
    afterwards is exact.
    """
    spark = docs.sparkSession
    bits = min(FILTER_BITS, max(16, (16 * involved.count()).bit_length()))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << bits, bool)
        for batch in batches:
            seen[(batch["group"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)] = True
        yield pd.DataFrame({"seen": [zlib.compress(np.packbits(seen).tobytes(), 1)]})

    seen = np.zeros(1 << bits, bool)
    for row in involved.coalesce(8).mapInPandas(mark, "seen binary").toLocalIterator():
        seen |= np.unpackbits(np.frombuffer(zlib.decompress(bytes(row["seen"])), np.uint8)).astype(bool)
    sent = spark.sparkContext.broadcast(seen)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                got = described(text, common.value)
                if got is not None and sent.value[(got[3] % (1 << 64)) >> (64 - bits)]:
                    rows.append((got[1], got[0].view(np.int64)))
            yield framed(rows, "name", "hashes")

    emitted = docs.select("text").mapInPandas(emit, "name binary, hashes array<long>")
    wanted = items.join(involved, "group").select("name", "id")
    return emitted.groupBy("name").agg(F.first("hashes").alias("hashes")).join(wanted, "name").select("id", "hashes")
