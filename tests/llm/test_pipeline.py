"""The stages chained over a small corpus, and their treatment of columns that bear names of their own."""

import random

import pytest

import corpus_pipeline
from stratamart.llm.common import apart
from stratamart.llm.jaccard import representatives
from stratamart.llm.secret_scan import redacted

from .conftest import EDGES

ENGLISH = "the river and stone with wood house light when other people thought through night water".split()
GERMAN = "der fluss und stein mit holz haus licht wenn andere menschen dachten durch nacht wasser".split()
SECRET = "password = hunter2secretvalue"


def prose(words, n, seed):
    return " ".join(random.Random(seed).choices(words, k=n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """English and German prose, two copies and a near copy, a leak, a secret, and texts without a language."""
    rows = [(k, prose((ENGLISH, GERMAN)[k % 2], 60 + k % 9, k), ("en", "de")[k % 2], "ab"[k % 3 == 0]) for k in range(160)]
    passage = prose(ENGLISH, 30, 9999)
    first = rows[4][1]
    rows += [(900, first, "en", "a"), (901, first + " once", None, "b"), (902, prose(ENGLISH, 30, 7) + " " + passage, "en", "a")]
    rows += [(903, prose(ENGLISH, 40, 8) + " " + SECRET, "en", "b"), (904, None, "en", "a"), (905, "12 34 !!", None, "a"), (906, "", "de", None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.selectExpr("*", "char_length(text) as n_chars", "doc_id * 2 as spans", "'kept' as size", "doc_id + 1 as copy", "'x' as _hash", "-1.5 as score", "7 as _text")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, "stone stone stone")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_chain(spark, folder):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*columns, "size_2", "copy_2"]
    rows = out.collect()
    # Texts without a language, later copies, the near copy and leaks are gone; clean texts are all there or drawn 0 times.
    leaks = {k for k, r in docs.items() if "stone stone stone" in (r["text"] or "")} | {902}
    gone = {900, 901, 904, 905, 906} | leaks
    kept = set(docs) - gone
    assert {r["doc_id"] for r in rows} <= kept
    stage = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:4]:
        stage = corpus_pipeline.stored(step(spark, stage, folder), name)
        assert stage.columns == columns
    before_mix = {r["doc_id"]: r for r in stage.collect()}
    assert set(before_mix) == kept
    for doc_id, row in before_mix.items():
        was = docs[doc_id].asDict()
        if doc_id == 903:
            was |= {"text": was["text"].replace(SECRET, "[SECRET]"), "n_chars": len(was["text"].replace(SECRET, "[SECRET]"))}
        assert row.asDict() == was
    # The mixture: size in words; every source near its target; copies numbered.
    copies = {}
    for r in rows:
        assert r["size_2"] == len(r["text"].split()) and r["size"] == "kept" and r["copy"] == r["doc_id"] + 1
        copies.setdefault(r["doc_id"], []).append(r["copy_2"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2 for c in copies.values())
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_columns_of_any_name_come_back_as_they_were(spark, documents):
    rows = [(d, t, "en", "s") for d, t in EDGES] + [(50, "api_key: abcdefgh1234 and more", "en", "s")]
    clashing = documents(rows).selectExpr("*", "doc_id + 5 as _base", "'t' as _tests", "map('a', 1) as Class", "array(doc_id) as best", "3 as _packed2", "'h' as _hash", "doc_id as id")
    cut = redacted(clashing)
    assert cut.columns == clashing.columns and cut.dtypes == clashing.dtypes
    for row, was in zip(sorted(cut.collect(), key=repr), sorted(clashing.collect(), key=repr), strict=True):
        changed = {"text", "n_chars"} if was["doc_id"] == 50 else set()
        assert all(row[c] == was[c] for c in clashing.columns if c not in changed)
        assert row["doc_id"] != 50 or row["text"] == "[SECRET] and more" and row["n_chars"] == 17
    one = representatives(clashing)
    assert one.dtypes == clashing.dtypes
    known = [r.asDict() for r in clashing.collect()]
    assert all(r.asDict() in known for r in one.collect())


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, folder).count() == 0


def test_apart_numbers_taken_names(spark):
    docs = spark.range(2).selectExpr("id", "id + 1 as N", "id + 2 as n_2")
    out = apart(docs, ("id",), lambda rows: rows.withColumn("n", rows["id"] * 10))
    assert out.columns == ["id", "N", "n_2", "n_3"] and sorted(map(tuple, out.collect())) == [(0, 1, 2, 0), (1, 2, 3, 10)]
