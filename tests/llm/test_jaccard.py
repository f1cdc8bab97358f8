import random

import pytest

from stratamart.llm import jaccard
from stratamart.llm.jaccard import near_classes, representatives

from .conftest import EDGES, words


def sets_of(texts):
    out = []
    for text in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def plain(rows):
    """Row by row: set size and smallest id of the component."""
    sets = sets_of([t for _, t in rows])
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.fixture
def family():
    """Copies of a few texts with more and more edits, chains included."""
    pick, rows = random.Random(3), []
    for f in range(5):
        w = words(60 + 40 * f, f)
        for _ in range(14):
            w = list(w)
            for _ in range(pick.choice([0, 1, 1, 2, 4])):
                w[pick.randrange(len(w))] = f"e{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000 + k, " ".join(words(n, 77))) for k, n in enumerate((1, 2, 4, 5, 6, 9, 10, 11, 12))]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("rounds,short", [(3, 12), (0, 0)])
def test_equals_all_pairs(spark, documents, family, monkeypatch, rounds, short):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    assert found(near_classes(documents(family).repartition(3))) == plain(family)


def test_edges(spark, documents):
    assert found(near_classes(documents(EDGES))) == plain(EDGES)
    assert near_classes(documents(EDGES).limit(0)).count() == 0


def test_one_of_each_class_stays(spark, documents, family):
    family = [(d + 100, t) for d, t in family]
    rows = family + EDGES
    kept = representatives(documents(rows))
    assert kept.columns == documents(rows).columns
    bare = sum(1 for s in sets_of([t for _, t in rows]) if not s)
    classes = {c for _, n, c in plain(family) if n} | {4, 6, None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(classes) + bare
    assert classes - {None} <= set(ids)


def test_prefix_always_shares_a_shingle():
    for n in range(1, 300):
        for m in range((n * 80 + 99) // 100, n + 1):
            common = (80 * (n + m) + 179) // 180
            if common <= m:
                assert n - jaccard.prefix_length(n) < common
