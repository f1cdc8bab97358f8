import random

import numpy as np
import pytest

from stratamart.llm import decontaminate
from stratamart.llm.decontaminate import contaminations, tiles, token_hashes, without_leaks

from .conftest import EDGES, words


def plain(item, doc, shortest):
    """Greedy string tiling by looking at all places in each round."""
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n >= shortest and (best is None or (-n, i, d) < best):
                    best = (-n, i, d)
        if best is None:
            return out
        n, i, d = -best[0], best[1], best[2]
        out.append((i, d, n))
        free_i[i : i + n] = [False] * n
        free_d[d : d + n] = [False] * n


def test_tiles_equal_brute_force():
    pick = random.Random(6)
    for _ in range(150):
        item = np.array([pick.randrange(3) for _ in range(pick.randrange(12))], np.uint64)
        doc = np.array([pick.randrange(3) for _ in range(pick.randrange(25))], np.uint64)
        got, expected = tiles(item, doc, 3), plain(item.tolist(), doc.tolist(), 3)
        assert sorted(got) == sorted(expected)


def test_reordered_and_changed_passages(spark, documents):
    item = words(40, 1)
    rows = [
        (1, " ".join(words(30, 2) + item + words(30, 3))), (2, " ".join(item[20:] + words(9, 4) + item[:20])),
        (3, " ".join(item).upper().replace(" ", "!! ")), (4, " ".join(item[:12] + words(60, 5))), (5, " ".join(words(200, 6))),
    ]
    items = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (None, None), (7, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r for r in contaminations(documents(rows), items).collect()}
    assert set(got) == {1, 2, 3} and {r["item_id"] for r in got.values()} == {7}
    assert got[1]["coverage"] == 1.0 and got[2]["n_tiles"] == 2 and got[3]["n_tokens"] == 40
    clean = without_leaks(documents(rows), items)
    assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5] and clean.columns == documents(rows).columns


def small_corpus(seed):
    """Texts and items of few words, so that they share many runs; copies, nulls and one word over and over included."""
    pick = random.Random(seed)
    items = [(pick.randrange(9), " ".join(words(pick.randrange(1, 14), pick.random(), 3))) for _ in range(12)]
    rows = [(k, " ".join(words(pick.randrange(40), pick.random(), 3))) for k in range(40)]
    rows += [rows[3], rows[3], (None, rows[3][1]), (None, None), (90, "w1 " * 30), (91, items[0][1] + " x " + items[1][1])]
    return rows, [*items, items[0], (None, items[1][1]), (None, None), (50, "w1 " * 12)]


def plain_contaminations(rows, items, cover=0.6, shortest=5):
    out = []
    for doc_id, text in rows:
        for item_id, item in set(items):
            a, b = (t.split() if t else [] for t in (item, text))
            got = plain(a, b, min(shortest, len(a))) if a else []
            if 0 < len(a) < shortest:
                got = got[:1] if got and got[0][2] == len(a) else []
            n = sum(length for *_, length in got)
            if got and n >= cover * len(a):
                out.append((doc_id, item_id, len(got), n, round(n / len(a), 9)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_contaminations_equal_brute_force(spark, documents, monkeypatch, bits):
    # A filter that is too small lets all seeds through and changes nothing.
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    rows, items = small_corpus(4)
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["n_tiles"], r["n_tokens"], round(r["coverage"], 9)) for r in contaminations(documents(rows), frame).collect()]
    expected = plain_contaminations(rows, items)
    assert len(expected) > 20 and sorted(got, key=repr) == expected
    dirty = {d for d, *_ in expected}
    clean = without_leaks(documents(rows).withColumnRenamed("key", "leak"), frame)
    texts = {t for d, t in rows if d in dirty}
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted((d for d, t in rows if t not in texts), key=repr)
    assert [c for c in clean.columns if c == "leak"] == ["leak"]


def test_ids_of_any_type(spark, documents):
    items = spark.createDataFrame([("i", "one two three four five")], "item_id string, text string")
    docs = documents([(1, "so one two three four five")]).selectExpr("concat('d', doc_id) as doc_id", "text")
    assert [(r["doc_id"], r["item_id"]) for r in contaminations(docs, items).collect()] == [("d1", "i")]


def test_filter_holds_all_seeds(spark):
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    known = decontaminate.filter_of(spark.createDataFrame([(int(h),) for h in hashes], "hash long"))
    assert known.holds(hashes.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63 - 1, 20_000).astype(np.uint64)
    assert known.holds(others).mean() < 0.01
    assert not decontaminate.filter_of(spark.createDataFrame([], "hash long")).holds(others).any()


def test_edges(spark, documents):
    items = spark.createDataFrame([(1, " ".join(words(30, 9)))], "item_id long, text string")
    assert contaminations(documents(EDGES), items).count() == 0
    assert contaminations(documents(EDGES), items.limit(0)).count() == 0
    assert contaminations(documents(EDGES).limit(0), items).count() == 0
    assert without_leaks(documents(EDGES), items).count() == len(EDGES)
    assert len(token_hashes(None)) == 0


def test_short_items_are_one_run(spark, documents):
    """Items of 1 to 4 words, alone, inside a text and in another order, in texts shorter than a tile as well."""
    items = spark.createDataFrame([(1, "Zebra"), (2, "red fox"), (3, "red fox runs"), (4, "a red fox runs"), (5, "!! ."), (6, "")], "item_id long, text string")
    rows = [(10, "a red fox runs"), (11, "the red fox, the zebra and others of that kind"), (12, "fox red"), (13, "zebra"), (14, "runs red fox runs"), (15, ""), (16, None)]
    got = sorted((r["doc_id"], r["item_id"], r["n_tiles"], r["n_tokens"], r["coverage"]) for r in contaminations(documents(rows), items).collect())
    pairs = [(10, 2, 2), (10, 3, 3), (10, 4, 4), (11, 1, 1), (11, 2, 2), (13, 1, 1), (14, 2, 2), (14, 3, 3)]
    assert got == [(d, k, 1, n, 1.0) for d, k, n in pairs]
    assert sorted(r["doc_id"] for r in without_leaks(documents(rows), items).collect()) == [12, 15, 16]
