import random
import re
from itertools import permutations

import pytest

from stratamart.llm import interactions
from stratamart.llm.interactions import RadixTrie, audit_filters, prefix_bounds

from .conftest import EDGES, words

LABELS = "doc_id long, quality int, toxic int, part string, n int"


def plain(rows, labels):
    """Row by row: every order applied to every document."""
    texts = [(d, t or "", lang or "") for d, t, lang, *_ in rows]
    fails = []
    for d, t, _ in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and any(o is not None and o < d and u == t for o, u, _ in texts),
        })
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    out, shapley = {}, {}
    for part in {p for *_, p in texts}:
        for order in permutations("ABCDE"):
            alive = [k for k, (*_, p) in enumerate(texts) if p == part]
            gone = []
            for step, x in enumerate(order, 1):
                now = [k for k in alive if fails[k][x]]
                alive = [k for k in alive if not fails[k][x]]
                only = [k for k, (*_, p) in enumerate(texts) if p == part and fails[k][x] and sum(fails[k].values()) == 1]
                out[part, "".join(order), step] = [
                    len(alive), len(now), sum(fails[k][x] for k in gone), len(only), sum(texts[k][0] in good for k in now), sum(texts[k][0] in toxic for k in now),
                ]
                shapley[part, x] = shapley.get((part, x), 0) + len(now)
                gone += now
    return {key: tuple([*v, shapley[key[0], key[1][key[2] - 1]]]) for key, v in out.items()}


def found(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in names) for r in df.collect()}


@pytest.fixture
def corpus():
    """Texts that fail any set of filters, copies near and far, ids that repeat or are null."""
    pick, rows = random.Random(8), []
    for k in range(60):
        w = words(pick.choice([20, 99, 100, 130]), k, pick.choice([20, 9000]))
        if pick.random() < 0.4:
            w = [x.upper() if pick.random() < 0.6 else x for x in w]
        if pick.random() < 0.3:
            w[3] = "a$b"
        rows.append((k, " ".join(w), pick.choice(["en", "de", None, ""])))
    for k in range(60, 140):
        d, t, _ = rows[pick.randrange(60)] if pick.random() < 0.7 else rows[7]
        rows.append((pick.choice([k, d, k - 130, None]), t if pick.random() < 0.9 else t[:-1], pick.choice(["en", "de"])))
    return rows + [(d, t, None) for d, t in EDGES]


MARKS = [(k, k % 2, k % 3 == 0, "x", 1) for k in range(0, 140, 2)] + [(4, 1, None, "x", 1), (None, 1, 1, "x", 1), (6, None, 1, "x", 1)]


@pytest.mark.parametrize("size", [32 << 20, 2000])
def test_equals_row_by_row(spark, documents, corpus, monkeypatch, size):
    monkeypatch.setattr(interactions, "RANGE_BYTES", size)
    monkeypatch.setattr(interactions, "TRIE_BYTES", size)
    random.Random(1).shuffle(corpus)
    labels = spark.createDataFrame([(d, q, None if x is None else int(x), p, n) for d, q, x, p, n in MARKS], LABELS)
    got = audit_filters(documents(corpus).withColumnRenamed("key", "mask").withColumnRenamed("n", "to").repartition(5), labels)
    assert found(got) == plain(corpus, MARKS)


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABELS)
    assert audit_filters(documents(EDGES).limit(0), labels).count() == 0
    assert found(audit_filters(documents(EDGES), labels)) == plain([(*e, None) for e in EDGES], [])


def test_trie_holds_smallest_ids():
    pick = random.Random(3)
    for _ in range(30):
        texts = ["".join(pick.choices("abé", k=pick.randrange(0, 9))) for _ in range(60)]
        trie, failing, least = RadixTrie(), [], {}
        for k, text in enumerate(texts):
            doc_id = pick.randrange(40)
            least.setdefault(text, []).append(doc_id)
            failing += trie.insert(text, doc_id, ("p", 0), 1)
        kept = list(trie.traverse())
        assert sorted(d for d, *_ in kept) == sorted(min(ids) for ids in least.values())
        assert sum(n for *_, n, _ in kept) == sum(ids.count(min(ids)) for ids in least.values())
        assert sum(n for *_, n, _ in failing) + sum(n for *_, n, _ in kept) == len(texts)


def test_bounds_adapt_to_long_common_prefixes(spark, documents):
    head = "the same beginning of very many texts " * 30
    texts = documents([(k, head + f"{k:05d} " + "x" * 50) for k in range(400)] + [(1000 + k, "copy") for k in range(400)])
    bounds = prefix_bounds(texts, 8, 800)
    assert bounds == sorted(set(bounds)) and len(bounds) >= 4
    assert sum(b.startswith(head) for b in bounds) >= 4
    assert prefix_bounds(texts, 1, 800) == []
