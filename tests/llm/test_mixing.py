from hashlib import md5

import pytest
from pyspark.sql import functions as F

from stratamart.llm.mixing import chance, emitted, mix, source_targets

from .conftest import EDGES, words


def plain(sizes):
    """Targets by source size in source order, weights 3, 1, 2: shared again until none is above."""
    everything, stopped = 1.5 * sum(sizes), set()
    weights = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    while True:
        rest = everything - sum(2 * sizes[k] for k in stopped)
        per = sum(w for k, w in enumerate(weights) if k not in stopped)
        share = [rest * w / per if per else 0 for w in weights]
        now = {k for k in range(len(sizes)) if k not in stopped and share[k] > 2 * sizes[k]}
        if not now:
            return [2.0 * sizes[k] if k in stopped else share[k] for k in range(len(sizes))]
        stopped |= now


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 7, 3, 0, 900], [5], [0, 0], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]])
def test_targets(spark, sizes):
    rows = [(f"s{k:02d}" if k < len(sizes) - 1 or len(sizes) == 1 else None, n) for k, n in enumerate(sizes)]
    got = source_targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    by_source = {r["source"]: r["target"] for r in got}
    assert [by_source[s] for s, _ in rows] == pytest.approx(plain(sizes))


def test_mix_comes_near_targets_and_repeats(spark, documents):
    rows = [(k, " ".join(words(5 + k % 40, k)), None, ("a", "b", None, "d")[k % 4]) for k in range(1200)]
    got = mix(documents(rows)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in mix(documents(rows[::-1])).collect()}
    for source in ("a", "b", None, "d"):
        part = [r for r in got if r["source"] == source]
        assert sum(r["size"] for r in part) == part[0]["source_size"]
        assert sum(r["taken"] for r in part) == pytest.approx(part[0]["target"], rel=0.15)
        rate = part[0]["target"] / part[0]["source_size"]
        assert {r["copies"] for r in part} <= {int(rate), int(rate) + (rate > int(rate))}
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    assert emitted(mix(documents(rows))).count() == sum(r["copies"] for r in got)
    assert {r["taken"] for r in mix(documents(rows), seed=1).collect()} and [r["copies"] for r in mix(documents(rows), seed=1).orderBy("doc_id").collect()] != [
        r["copies"] for r in mix(documents(rows)).orderBy("doc_id").collect()
    ]


def plain_chance(doc_id, text, seed=0):
    mark = f"{seed}:{'' if doc_id is None else doc_id}:{md5((text or '').encode()).hexdigest()}"
    return int(md5(mark.encode()).hexdigest()[:13], 16) / 16**13


def test_draws_are_even_and_independent_of_ids(spark, documents):
    rows = [(k, "t") for k in range(4000)] + [(None, f"t {k}") for k in range(4000)] + [(1, None), (1, "")]
    got = [(r["doc_id"], r["text"], r["p"]) for r in documents(rows).withColumn("p", chance(F.col("doc_id"), F.col("text"))).collect()]
    assert all(p == plain_chance(doc_id, text) for doc_id, text, p in got)
    # Documents without an id, or with one id, are drawn each for itself; a thousandth part is met as it should be.
    for part in ([p for i, _, p in got if i is not None], [p for i, _, p in got if i is None]):
        for share in (0.05, 0.5, 0.9):
            assert sum(p < share for p in part) == pytest.approx(share * len(part), abs=4 * (len(part) * share * (1 - share)) ** 0.5)


def test_sources_use_the_series_nearest_their_target(spark, documents):
    """Small sources of uneven documents: one series alone leaves many of them far off."""
    rows = [(k, " ".join(words(3 + k * 37 % 90, k)), None, f"s{k % 12:02d}") for k in range(480)]
    got = mix(documents(rows)).collect()
    for source in sorted({r["source"] for r in got}):
        part = [r for r in got if r["source"] == source]
        target, rate = part[0]["target"], part[0]["target"] / part[0]["source_size"]
        texts = {doc_id: text for doc_id, text, _, s in rows if s == source}
        series = [
            sum(r["size"] * (int(rate) + (plain_chance(r["doc_id"], texts[r["doc_id"]], seed) < rate - int(rate))) for r in part) for seed in range(8)
        ]
        assert sum(r["taken"] for r in part) == min(series, key=lambda n: abs(n - target))
        assert sum(r["taken"] for r in part) == pytest.approx(target, rel=0.05)


def test_edges(spark, documents):
    got = mix(documents(EDGES))
    assert got.count() == len(EDGES)
    assert got.where("text is null").agg({"taken": "sum"}).first()[0] == 0
    assert mix(documents(EDGES).limit(0)).count() == 0
