import random
from collections import Counter
from hashlib import sha256

import pytest

from stratamart.llm.suffixes import WINDOW, repeated_windows

from .conftest import EDGES, words


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + WINDOW] for d in data for i in range(len(d) - WINDOW + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - WINDOW + 1):
            if seen[d[i : i + WINDOW]] > 1:
                gone[i : i + WINDOW] = b"\1" * WINDOW
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, sha256(bytes(b for b, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("crowded", [20_000, 1])
def test_equals_brute_force(spark, documents, crowded):
    pick = random.Random(5)
    passage = " ".join(words(90, 9)) + " é" * 20
    texts = [" ".join(words(pick.randrange(5, 200), k)) for k in range(20)]
    texts += [texts[0][:150] + passage + texts[1][:90], texts[2][:70] + passage, passage + texts[3], texts[4], texts[4], "a" * 700, "ab" * 300, "xyz" + "ab" * 150]
    texts += ["q" * 199, "q" * 199, "r" * 200, "r" * 200, "s" * 201]
    docs = documents([(k, t) for k, t in enumerate(texts)]).repartition(3)
    assert found(repeated_windows(docs, crowded)) == plain(texts)


def test_edges(spark, documents):
    assert found(repeated_windows(documents(EDGES))) == plain([t for _, t in EDGES])
    assert repeated_windows(documents(EDGES).limit(0)).count() == 0
