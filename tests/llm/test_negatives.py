import math
import random

import numpy as np
import pytest

from ledgerloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, slot int"


def brute(rows, n_positives=5, k=10):
    best = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (label, v) in best.items():
        if a % 100:
            continue
        told = sorted((-max(-negatives.MOST, min(negatives.MOST, sum(x * y for x, y in zip(v, w)))), i, own == label) for i, (own, w) in best.items() if i != a)
        for score, p, _ in [t for t in told if t[2]][:n_positives]:
            fit = [(-s, i) for s, i, same in told if not same and 30 * -score <= 100 * -s <= 90 * -score][:k]
            out += [(a, p, r + 1, i, -score, s) for r, (s, i) in enumerate(fit)]
    return sorted(out)


def found(spark, rows):
    given = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(given).collect())


@pytest.mark.parametrize("small", [False, True])
def test_like_brute_force(spark, monkeypatch, small):
    for name, value in (("ROWS", 40), ("ANCHORS", 2), ("STEP", 1), ("RUN", 2)) if small else ():
        monkeypatch.setattr(negatives, name, value)
    rng = random.Random(5)
    centre = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in centre[i % 4]], rng.choice([i % 4, 7]), "", 0) for i in range(900)]
    rows += [(2000 + i, list(rows[3][1]), 3, "", 0) for i in range(90)] + [(3000 + i, [0.25, 0.5, 0.0, 0.0, 0.0, 0.25], i % 3, "", 0) for i in range(120)]
    want = brute(rows)
    assert len(want) > 200 and found(spark, rows) == want


def test_awkward_rows(spark):
    rows = [(100, [1.0, 1.0], 1, "", 0), (101, [1.0, 0.5], 1, "", 0), (101, [0.75, 0.5], 1, "", 0), (102, [0.5, 0.25], 2, "", 0), (103, [0.5], 2, "", 0), (104, [0.5, 0.25, 9.0], 3, "", 0),
            (105, None, 2, "", 0), (106, [0.5, None], 2, "", 0), (107, [float("nan"), 1.0], 2, "", 0), (108, [float("inf"), 1.0], 2, "", 0), (109, [0.5, 0.5], None, "", 0),
            (None, [0.5, 0.5], 2, "", 0), (110, [], 2, "", 0), (200, [], 2, "", 0), (300, [-1.0, -1.0], 1, "", 0), (301, [0.3, 0.3], 5, "", 0), (301, [0.3, 0.3], 5, "", 0)]
    want = brute(rows)
    assert want and found(spark, rows) == want


@pytest.mark.parametrize("big", [3e6, 1e8, 1e12])
def test_large_components_are_exact_or_held(spark, big):
    rng = random.Random(int(big))
    rows = [(i, [rng.uniform(0, 1) for _ in range(4)], i % 2, "", 0) for i in range(90, 160)] + [(500 + i, [rng.uniform(0, big) for _ in range(4)], i % 3, "", 0) for i in range(120)]
    want = brute(rows)
    assert want and found(spark, rows) == want


def test_scores_are_integers_of_any_size():
    a, b = np.array([[1e200, 1.0], [3.0, 2.0**40]]), np.array([[-1e200, 0.0], [1.0, 2.0**20 + 1]])
    assert negatives.scores(a, b).tolist() == [[-negatives.MOST, negatives.MOST], [-negatives.MOST, 3 + 2**60 + 2**40]]


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0], 1, "", 0)]) == []
    assert found(spark, [(100, [1.0], 1, "", 0), (1, [1.0], 1, "", 0), (2, [0.5], 2, "", 0)]) == [(100, 1, 1, 2, 65536, 32768)]
