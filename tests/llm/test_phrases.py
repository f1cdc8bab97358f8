from hashlib import sha256

from pyspark.sql import functions as F

from stratamart.llm.phrases import Parsed, bucket_of, from_text, likeness, parse, phrase_fingerprints

from .conftest import EDGES, words


def plain(text):
    known, out, start = set(), [], 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            out.append(end)
            start = end
    return out


def test_phrases():
    for text in ("", "a", "aaaaaaa", "abababab", " ".join(words(200, 1)), "é" * 50 + "日本" * 9):
        assert parse(text)[1] == plain(text)


def test_edited_texts_leave_the_tree_as_it_was():
    """An edited text has the fingerprint it has on its own, however many are made of one parse."""
    texts = ["", "a", "aaaaaaa", "abababababab", "é" * 50 + "日本" * 9, " ".join(words(300, 1)), " ".join(words(400, 2)), "x" * 999]
    for text in texts:
        first = Parsed(text)
        for following in [*texts, text]:
            edited, own = first.edited(Parsed(following))
            assert own.tolist() == Parsed(edited).own.tolist()
        assert first.edited(first)[1].tolist() == Parsed(first.edited(first)[0]).own.tolist()


def test_neighbours_and_edits(spark, documents):
    rows = [(k * 3, " ".join(words(20 + k % 50, k))) for k in range(120)] + [(1, "the same"), (2, "the same")]
    texts = dict(rows)
    order = sorted(texts)
    got = {r["doc_id"]: r for r in phrase_fingerprints(documents(rows).repartition(4), per_bucket=10).collect()}
    assert sorted(got) == order
    for doc_id, following in zip(order, order[1:] + order[:1], strict=True):
        text, row = texts[doc_id], got[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[following][:half]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), sha256(edited.encode()).hexdigest())
        assert row["near_next"] == likeness(from_text(row["fingerprint"]), from_text(got[following]["fingerprint"]))
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    long = [r for r in got.values() if r["n_chars"] > 60]
    assert all(r["near_edited"] > r["near_next"] for r in long)
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1.0


def test_buckets(spark):
    bounds = [3, 3, 8, 20, 21, 50, 51]
    got = spark.range(60).select("id", bucket_of(F.col("id"), bounds).alias("b")).collect()
    assert all(r["b"] == sum(b <= r["id"] for b in bounds) for r in got)


def test_edges(spark, documents):
    got = phrase_fingerprints(documents(EDGES)).collect()
    assert len(got) == len(EDGES)
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {""}
    assert phrase_fingerprints(documents(EDGES).limit(0)).count() == 0
    alone = phrase_fingerprints(documents([(7, "abcd")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
