import random
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from stratamart.llm import language
from stratamart.llm.language import UNKNOWN, features_of, fit, follow_the_leader, identify, predict_languages, temperature_of, vector

from .conftest import EDGES

ALPHABETS = {"aa": "abcdefg", "bb": "efghijk", "cc": "äöüßklmn"}


def texts(n, seed=1):
    pick = random.Random(seed)
    rows = []
    for k in range(n):
        lang = sorted(ALPHABETS)[k % 3]
        rows.append((k, " ".join("".join(pick.choices(ALPHABETS[lang], k=5)) for _ in range(pick.randrange(3, 60))), lang if k % 7 else None))
    return rows


def test_held_out_accuracy(spark, documents):
    rows = texts(300)
    truth = {k: sorted(ALPHABETS)[k % 3] for k, _, _ in rows}
    got = predict_languages(documents(rows)).collect()
    assert len(got) == 300
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_is_learned_from_held_out_rows(spark, documents):
    rows = texts(120)
    spoiled = [(k, t, "zz" if crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows]
    assert {tuple(r) for r in predict_languages(documents(rows)).collect()} == {tuple(r) for r in predict_languages(documents(spoiled)).collect()}


def test_edges(spark, documents):
    got = predict_languages(documents([*((k + 100, *r) for k, *r in texts(60)), *EDGES, (99, "123 !?")])).collect()
    assert len(got) == 60 + len(EDGES) + 1
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 99)} == {UNKNOWN}
    assert {r["lang_pred"] for r in predict_languages(documents(EDGES)).collect()} == {UNKNOWN}
    assert predict_languages(documents(EDGES).limit(0)).count() == 0
    docs = documents(EDGES)
    assert set(identify(docs, fit(docs)).columns) == {*docs.columns, "lang_pred"}


def test_languages_beyond_two_hundred(spark, documents):
    pick = random.Random(3)
    names = [f"l{k:03d}" for k in range(230)]
    # Every language has letters of its own.
    rows = [(k, "".join(chr(0x4E00 + 8 * (k % 230) + pick.randrange(8)) for _ in range(12)), names[k % 230]) for k in range(230 * 12)]
    docs = documents(rows)
    model = fit(docs)
    assert model.labels == names
    got = identify(docs, model).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)


def test_sample_is_the_first_by_hash_whatever_copies_there_are(spark, documents):
    rows = [*texts(400), *[(None, "abc abd", "aa")] * 500]
    small, again = fit(documents(rows), per_label=20), fit(documents(rows[::-1]), per_label=20)
    assert small.values.tolist() == again.values.tolist() and small.temperature == again.temperature


def plain_leader(rows, targets, labels):
    """FTRL-proximal one coordinate at a time."""
    z, n = {}, {}

    def weight(key):
        zi, ni = z.get(key, 0.0), n.get(key, 0.0)
        if abs(zi) <= language.L1:
            return 0.0
        return -(zi - (language.L1 if zi > 0 else -language.L1)) / ((language.BETA + ni**0.5) / language.ALPHA + language.L2)

    for _ in range(language.PASSES):
        for row, y in zip(rows, targets, strict=True):
            scores = [sum(x * weight((f, c)) for f, x in row.items()) for c in range(labels)]
            e = [np.exp(v - max(scores)) for v in scores]
            moves = []
            for f, x in row.items():
                for c in range(labels):
                    g = x * (e[c] / sum(e) - (c == y))
                    old = n.get((f, c), 0.0)
                    moves.append(((f, c), g - ((old + g * g) ** 0.5 - old**0.5) / language.ALPHA * weight((f, c)), g * g))
            for key, dz, dn in moves:
                z[key], n[key] = z.get(key, 0.0) + dz, n.get(key, 0.0) + dn
    return {key: weight(key) for key in z}


def test_leader_and_temperature_equal_plain_ones():
    pick = random.Random(5)
    rows = [{f: pick.random() for f in pick.sample(range(12), 4)} for _ in range(40)]
    targets = [pick.randrange(3) for _ in rows]
    got = follow_the_leader([(np.array(sorted(r)), np.array([r[f] for f in sorted(r)])) for r in rows], targets, 3, 12)
    assert all(abs(got[f, c] - w) < 1e-4 for (f, c), w in plain_leader(rows, targets, 3).items())
    logits = np.array([[pick.gauss(0, 3) for _ in range(3)] for _ in range(50)])
    labels = np.array([int(r.argmax()) if k % 3 else 0 for k, r in enumerate(logits)])

    def loss(t):
        return sum(-np.log(np.exp(r[y] / t) / sum(np.exp(r / t))) for r, y in zip(logits, labels, strict=True))

    best = temperature_of(logits, labels)
    assert all(loss(best) <= loss(best * 2**step) + 1e-6 for step in (-0.1, 0.1) if 2**-5 <= best * 2**step <= 8)


def test_weights_by_inverse_frequency_and_sparse_logits(spark, documents):
    rows = [(k, t, lang) for k, t, lang in texts(60) if crc32(str(k).encode()) % 4 != 2]
    total, counts = language.document_frequencies(documents(rows))
    seen = [set(features_of(t).tolist()) for _, t, _ in rows]
    assert total == len(rows) and all(counts[f] == sum(f in s for s in seen) for f in set.union(*seen)) and counts.sum() == sum(map(len, seen))
    model = fit(documents(rows))
    dense = np.zeros((len(model.idf), len(model.labels)))
    dense[np.repeat(np.arange(len(model.idf)), np.diff(model.ends, prepend=0)), model.at] = model.values
    features, x = vector(features_of(rows[0][1]), model.idf)
    assert np.allclose(model.logits(features, x), x @ dense[features]) and abs((x * x).sum() - 1) < 1e-9
