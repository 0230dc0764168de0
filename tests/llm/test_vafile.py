import math
import random

import pytest

from ledgerloom.llm import vafile

SCHEMA = "vec_id long, embedding array<double>, v string, low int"


def brute(rows, k, every):
    best = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(1024 * x) for x in v]
        best[i] = min(best.get(i, ints), ints)
    out = []
    for q, a in best.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in best.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, **how):
    return sorted(tuple(r) for r in vafile.top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect())


@pytest.mark.parametrize("cells, block, queries", [(256, 4096, 4096), (4, 50, 3)])
def test_like_brute_force(spark, monkeypatch, cells, block, queries):
    for name, value in (("CELLS", cells), ("BLOCK", block), ("QUERIES", queries)):
        monkeypatch.setattr(vafile, name, value)
    rng = random.Random(cells)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)], "", 0) for i in range(400)]
    rows += [(1000 + i, list(rows[200][1]), "", 0) for i in range(60)] + [(2000 + i, [rng.choice([-0.25, 0.25]) for _ in range(8)], "", 0) for i in range(80)]
    assert found(spark, rows, every=20) == brute(rows, 10, 20)


def test_awkward_vectors(spark):
    rows = [(0, [0.5, 0.5], "", 0), (100, [], "", 0), (1, None, "", 0), (2, [None, 1.0], "", 0), (3, [float("nan"), 1.0], "", 0), (4, [float("inf"), 1.0], "", 0),
            (None, [1.0, 1.0], "", 0), (5, [1.0], "", 0), (6, [0.1, 0.2, 0.3], "", 0), (7, [-1.0, 1.0], "", 0), (7, [1.0, 1.0], "", 0), (200, None, "", 0)]
    assert found(spark, rows) == brute(rows, 10, 100)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], "", 0)]) == []
    assert found(spark, [(100, [1.0], "", 0), (1, [2.0], "", 0)], k=3) == [(100, 1, 1, 2048 * 1024)]
