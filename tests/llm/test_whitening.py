import random
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from stratamart.llm.whitening import whitened_components

SCHEMA = "vec_id long, embedding array<float>, n int, x string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", "y") for k, v in rows], SCHEMA)


def plain(rows, keep=4):
    """Per row exact deviations; covariance by fractions, whitened values by numpy."""
    rows = [(k, [floor(256 * float(np.float32(c))) for c in v]) for k, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    centred = [[Fraction(x[i]) - Fraction(sums[i], n) for i in range(d)] for x in fit]
    covariance = np.array([[float(sum(y[i] * y[j] for y in centred) / n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[: min(keep, d)]
    out = []
    for k, x in rows:
        deviation = sum((n * x[i] - sums[i]) ** 2 for i in range(d))
        y = np.array([float(Fraction(x[i]) - Fraction(sums[i], n)) for i in range(d)])
        for c, at in enumerate(order, 1):
            out.append((k, c, n, deviation, y @ vectors[:, at] / np.sqrt(values[at]), values[at] / values.sum()))
    return out


@pytest.fixture
def vectors():
    pick = random.Random(6)
    rows = [(k, [pick.gauss(0, 3 - 0.4 * i) + (0.5 if k % 3 else 0.0) for i in range(6)]) for k in range(120)]
    rows += [(200 + k, rows[5][1]) for k in range(60)] + [(None, rows[9][1]), (3, rows[10][1])]
    return rows + [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5)]


def test_equals_plain_statistics(spark, vectors):
    got = whitened_components(frame(spark, vectors).repartition(4)).collect()
    expected = plain(vectors)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    mine = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got), key=key)
    expected = sorted(expected, key=key)
    assert [r[:4] for r in mine] == [r[:4] for r in expected]
    assert [abs(r[4]) for r in mine] == pytest.approx([abs(r[4]) for r in expected], rel=1e-9, abs=1e-9)
    assert [r[5] for r in mine] == pytest.approx([r[5] for r in expected], rel=1e-9)
    for c in range(1, 5):
        signs = {np.sign(a[4] * b[4]) for a, b in zip(mine, expected, strict=True) if a[1] == c and abs(a[4]) > 1e-9}
        assert len(signs) == 1
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_large_entries_stay_exact(spark):
    """Squares beyond 64 bits, up to a deviation that no long holds."""
    pick = random.Random(2)
    rows = [(k, [pick.uniform(-1, 1) * 2.0**pick.choice([2, 20, 21]) for _ in range(3)]) for k in range(40)]
    got = {(r["vec_id"], r["component"]): r for r in whitened_components(frame(spark, rows)).collect()}
    for k, c, n, deviation, value, share in plain(rows):
        row = got[k, c]
        assert row["deviation"] == (deviation if deviation < 2**63 else None) and row["n"] == n
        assert abs(row["whitened"]) == pytest.approx(abs(value), rel=1e-9, abs=1e-9) and row["explained"] == pytest.approx(share, rel=1e-9)
    assert any(r["deviation"] is None for r in whitened_components(frame(spark, [(1, [3e9]), (2, [-3e9]), (3, [0.0])])).collect())
    whitened_components(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.5])])).collect()


def test_no_spread_and_short_rank(spark):
    got = whitened_components(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, None, None)}
    got = whitened_components(frame(spark, [(k, [k / 4.0, k / 2.0, 1.0]) for k in range(5)])).collect()
    assert {r["component"]: r["whitened"] is None for r in got if r["vec_id"] == 3} == {1: False, 2: True, 3: True}
    assert {round(r["explained"], 12) for r in got} == {1.0, 0.0}


def test_lengths_and_empty_tables(spark):
    got = whitened_components(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0]), (4, [1.0, 2.0, 3.0])])).collect()
    assert {r["vec_id"] for r in got} == {1, 2}
    empty = whitened_components(frame(spark, [(1, None)]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
