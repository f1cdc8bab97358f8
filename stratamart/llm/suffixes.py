"""Repeated windows by a depth-limited radix sort of suffixes.

Suffixes are told apart only through the first ``WINDOW`` bytes, digit by digit from the
most significant one: suffixes that are alone in their group leave, and what is left in
a group after the last digit is a repeated window.

The first digit is read where it costs least. Among the ``DIGIT``-byte strings of a
window the one of smallest hash is its anchor; equal windows have equal anchors at equal
offsets, so all windows of a text share few anchors. Only windows whose anchor occurs
elsewhere go on to the following digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import M64, Rolling, encoded, framed, mixed, small_batches, stored

#: Bytes that a repeated window has, and bytes of its anchor.
WINDOW, DIGIT = 200, 40
#: Anchors with more places than this are sorted window by window across tasks, not within one.
CROWDED = 20_000
_PLACE_BITS = 20
#: Bytes of surroundings that a task sorts at once; whole groups of an anchor stay together.
SORTED_BYTES = 1_500_000


def anchors_of(rolling: Rolling, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window, hash) for a text of ``n`` bytes, by place; windows by their start.

    Every window belongs to exactly one anchor. Ties of hashes go to the leftmost, which
    depends on the window alone.
    """
    windows = n - WINDOW + 1
    if windows <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, np.uint64)
    at = np.arange(n - DIGIT + 1)
    hashes = rolling.of(at, at + DIGIT)
    width = WINDOW - DIGIT + 1
    step = (1 << _PLACE_BITS) - 2 * WINDOW
    places = []
    for begin in range(0, windows, step):
        count = min(step, windows - begin)
        part = hashes[begin : begin + count + width - 1]
        low = np.uint64((1 << _PLACE_BITS) - 1)
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        pad = -len(keys) % width
        rows = np.concatenate((keys, np.full(pad, ~np.uint64(0)))).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        places.append((least & low).astype(np.int64) + begin)
    owner = np.concatenate(places)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    last = np.concatenate((first[1:], [windows])) - 1
    anchor = owner[first]
    return anchor, first, last, hashes[anchor]


def repeated(groups: np.ndarray, anchors: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, around: list[bytes]) -> np.ndarray:
    """Which windows are repeated, row after row: row r has the windows ``firsts[r] .. lasts[r]``.

    ``around[r]`` holds the bytes from the first window's start to the last one's end.
    Within groups of equal anchors the digits are the window's halves; windows alone
    with their digits so far leave before the next.
    """
    counts = lasts - firsts + 1
    rolling = Rolling(b"".join(around))
    base = np.concatenate(([0], np.cumsum([len(a) for a in around])[:-1])).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = base[row] + nth
    key = mixed(groups.view(np.uint64)[row] + mixed((anchors[row] - firsts[row] - nth).astype(np.uint64)))
    active = np.arange(len(row))
    half = WINDOW // 2
    for begin, end in ((0, half), (half, WINDOW)):
        at = start[active]
        key = mixed(key * M64 + rolling.of(at + begin, at + end))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        shared = np.zeros(len(active), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        active, key = active[shared], key[shared]
    out = np.zeros(len(row), bool)
    out[active] = True
    return out


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def name_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def repeated_windows(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``removed``, the runs (start, end) that go.

    A byte goes if a window of :data:`WINDOW` bytes that covers it also starts anywhere
    else, in the same text or another; windows are judged on the input. Null and empty
    texts have no bytes. Texts that occur more than once and are long enough go whole.
    Ids may be null or repeat; each row is a text of its own. Other columns are not read.

    Anchors are added up across tasks as (hash, text, place). The texts meet their
    repeated anchors in one equality join, surroundings of those anchors are dealt out
    by anchor, and the texts of the runs found are joined once more. A text that many
    rows share sends its surroundings once per task. An anchor with more than
    ``crowded`` places is not sorted within one task: its windows are counted by hash
    across all tasks.
    """
    texts = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = F.octet_length("text") >= WINDOW
    rows = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), name_of(F.col("text")).alias("name"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    long_texts = texts.where(short).select(F.xxhash64("text").alias("d"), "text")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            d, h, at = [], [], []
            for name, text in zip(batch["d"].to_numpy(), batch["text"], strict=True):
                data = encoded(text)
                anchor, _, _, hashes = anchors_of(Rolling(data), len(data))
                d.append(np.full(len(anchor), name))
                h.append(hashes.view(np.int64))
                at.append(anchor)
            if d:
                yield pd.DataFrame({"h": np.concatenate(h), "d": np.concatenate(d), "at": np.concatenate(at)})

    anchors = long_texts.mapInPandas(find, "h long, d long, at int")
    place = F.struct("d", "at")
    shared = anchors.groupBy("h").agg(F.count("*").alias("k"), F.min(place).alias("a"), F.max(place).alias("b"))
    # Anchors that only copies of one text have need no sorting.
    # Written, so that the join has an exchange of its own on both sides and can split a crowded anchor.
    shared = stored(shared.where("a <> b").select("h", (F.col("k") > crowded).alias("crowded")), "suffix-shared")
    wanted = anchors.join(shared, "h").groupBy("d").agg(F.collect_set(F.struct("at", "crowded")).alias("wanted"))

    def surround(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            out = []
            for text, places in zip(batch["text"], batch["wanted"], strict=True):
                data = encoded(text)
                name = md5(data).digest()
                if name in seen:
                    continue
                seen.add(name)
                kinds = {p["at"]: p["crowded"] for p in places}
                for anchor, first, last, h in zip(*(x.tolist() for x in anchors_of(Rolling(data), len(data))), strict=True):
                    if anchor in kinds:
                        out.append((h - (1 << 64) if h >> 63 else h, name, anchor, first, last, data[first : last + WINDOW], kinds[anchor]))
            yield framed(out, "h", "name", "anchor", "first", "last", "around", "crowded")

    around = long_texts.join(wanted, "d").select("text", "wanted").mapInPandas(
        surround, "h long, name binary, anchor int, first int, last int, around binary, crowded boolean"
    )
    around = stored(around, "suffix-surroundings")
    found = sorted_within(around.where("not crowded")).unionByName(counted_across(around.where("crowded")))
    gone = stored(found.groupBy("name").agg(F.collect_list(F.struct("start", "end")).alias("runs")), "suffix-runs")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, text, runs in zip(batch["name"], batch["text"], batch["runs"], strict=True):
                data = np.frombuffer(encoded(text), np.uint8)
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, [r["start"] for r in runs], 1)
                np.add.at(depth, [r["end"] for r in runs], -1)
                off = np.cumsum(depth[:-1]) > 0
                starts, ends = runs_of(off)
                spans = [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                out.append((name, int(off.sum()), sha256(data[~off].tobytes()).hexdigest(), spans))
            yield framed(out, "name", "n", "kept", "spans")

    span = "array<struct<start: long, end: long>>"
    copies = rows.groupBy("name").agg(F.count("*").alias("copies"))
    cuts = texts.where(short).select(name_of(F.col("text")).alias("name"), "text").join(gone, "name")
    cuts = cuts.select("name", "text", "runs").mapInPandas(cut, f"name binary, n long, kept string, spans {span}")
    cuts = cuts.groupBy("name").agg(F.first("n").alias("n"), F.first("kept").alias("kept"), F.first("spans").alias("spans"))
    verdicts = copies.join(cuts, "name", "left").where("copies > 1 or n is not null")
    out = rows.join(verdicts, "name", "left")
    all_goes = (F.col("copies") > 1) & (F.col("n_bytes") >= WINDOW)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    removed = F.when(all_goes, everything).otherwise(F.coalesce("spans", F.array().cast(span)))
    return out.select(
        "doc_id", "n_bytes", F.when(all_goes, F.col("n_bytes")).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"), F.when(all_goes, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
        removed.alias("removed"),
    )


def sorted_within(around: DataFrame) -> DataFrame:
    """(name, start, end) of the bytes that repeated windows cover; all places of an anchor meet in one task."""

    def work(held: pd.DataFrame) -> pd.DataFrame:
        firsts, lasts = held["first"].to_numpy(np.int64), held["last"].to_numpy(np.int64)
        flags = repeated(held["h"].to_numpy(np.int64), held["anchor"].to_numpy(np.int64), firsts, lasts, [bytes(x) for x in held["around"]])
        # A gap after each row keeps runs of neighbours apart.
        counts = lasts - firsts + 1
        ends = np.cumsum(counts + 1)
        spaced = np.zeros(int(ends[-1]), bool)
        begins = ends - counts - 1
        spaced[np.arange(len(flags)) + np.repeat(np.arange(len(counts)), counts)] = flags
        lo, hi = runs_of(spaced)
        row = np.searchsorted(ends, lo, "right")
        start = firsts[row] + lo - begins[row]
        names = held["name"].to_numpy()[row]
        return pd.DataFrame({"name": names, "start": start, "end": start + (hi - lo) - 1 + WINDOW})

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += int(batch["around"].map(len).sum())
            if size >= SORTED_BYTES:
                rows = pd.concat(held, ignore_index=True)
                # The last group may go on in the next batch.
                done = rows["h"].to_numpy() != rows["h"].iloc[-1]
                if done.any():
                    yield work(rows[done])
                held = [rows[~done]]
                size = int(held[0]["around"].map(len).sum())
        if held and len(rows := pd.concat(held, ignore_index=True)):
            yield work(rows)

    dealt = around.select("h", "name", "anchor", "first", "last", "around").repartition("h").sortWithinPartitions("h")
    return dealt.mapInPandas(sort, "name binary, start int, end int")


def counted_across(around: DataFrame) -> DataFrame:
    """As :func:`sorted_within`, by counting the windows of each hash across tasks."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for name, anchor, first, last, data in batch.itertuples(index=False):
                rolling, at = Rolling(bytes(data)), np.arange(last - first + 1)
                halves = rolling.of(at, at + WINDOW // 2), rolling.of(at + WINDOW // 2, at + WINDOW)
                names = np.full(len(at), None, object)
                names[:] = [name] * len(at)
                parts.append((halves[0].view(np.int64), halves[1].view(np.int64), anchor - first - at, names, first + at))
            if parts:
                yield pd.DataFrame(dict(zip(("a", "b", "o", "name", "start"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    windows = around.select("name", "anchor", "first", "last", "around").mapInPandas(spread, "a long, b long, o int, name binary, start int")
    twice = windows.groupBy("a", "b", "o").agg(F.count("*").alias("k")).where("k > 1").select("a", "b", "o")
    # Written, so that the join has an exchange of its own on both sides and can split a crowded window.
    twice = stored(twice, "suffix-twice")
    return windows.join(twice, ["a", "b", "o"]).select("name", "start", (F.col("start") + WINDOW).alias("end"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows of :func:`repeated_windows` without the runs."""
    return repeated_windows(docs).drop("removed")
