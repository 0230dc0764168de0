import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, _toxic int, _order string, score string"


def said(rng, n, bad=()):
    words = ["".join(rng.choice(["an", "re", "ti", "lo", "che", "un"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for w in bad:
        words[rng.randrange(n)] = w
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(700):
        toxic = int(i % 3 == 0)
        bad = [rng.choice(["vilgrub", "vilzork", "vilmuck", "Vilgrub!"]) for _ in range(rng.randint(2, 6))] if toxic else []
        rows.append((i, said(rng, rng.randint(10, 200), bad), "en", 0, "", ""))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def result(spark, corpus):
    rows, labels = corpus
    odd = [(9000, None, None, None, None, None), (9001, "", "en", 0, "", ""), (None, "re ti", None, 0, "", ""), (9002, " \n\t", "en", 0, "", ""),
           (9003, said(random.Random(5), 30_000, ["vilgrub", "vilmuck"]), "en", 0, "", ""), (9004, "!!! ???", "en", 0, "", ""), (3, rows[3][1], "de", 9, "z", "")]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    told = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, told, toxicity.toxicity(docs, told).collect()


def test_held_out_accuracy(corpus, result):
    truth = {i: t for i, _, t in corpus[1]}
    rows = [r for r in result[2] if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) > 100 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in result[2] if r["doc_id"] is not None)


def test_awkward_rows(result):
    rows = result[2]
    assert len(rows) == 707 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["score"] for i in (9000, 9001, 9002)] == [0, 0, 0] and by_id[9003]["predicted"] == 1 and by_id[9003]["n_windows"] > 800
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1 and by_id[None]["held_out"] is False


def test_clean_keeps_columns(result):
    docs, told, rows = result
    kept = toxicity.clean(docs, told)
    assert kept.schema == docs.schema and kept.count() == sum(r["score"] < 0.5 for r in rows)


def test_gradient():
    net = toxicity.Network()
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        net.p[name] = value.astype(np.float64)
    gates = rng.standard_normal((6, 6 * toxicity.HIDDEN))
    index, size = rng.integers(0, 6, (3, 5)), np.array([5, 3, 1])
    weigh = rng.standard_normal(3)
    logit, memory = net.run(gates, index, size, keep=True)
    g, d_gates = net.back(weigh, memory, 6)
    loss = lambda: float(net.run(gates, index, size) @ weigh)
    for values, slope in [(gates, d_gates), *((net.p[k], g[k]) for k in ("up", "att", "att0", "pick", "out", "out0"))]:
        flat, at = values.reshape(-1), int(rng.integers(values.size))
        was = flat[at]
        flat[at] = was + 1e-3
        more = loss()
        flat[at] = was - 1e-3
        less = loss()
        flat[at] = was
        assert (more - less) / 2e-3 == pytest.approx(float(slope.reshape(-1)[at]), rel=0.05, abs=2e-3)


def test_windows_cover_whole_texts():
    sizes = np.array([0, 1, 47, 48, 49, 84, 85, 1000])
    doc, start, size = toxicity._windows(sizes)
    base = np.cumsum(sizes) - sizes
    for i, n in enumerate(sizes):
        seen = {w for s, k in zip(start[doc == i], size[doc == i]) for w in range(s - base[i], s - base[i] + k)}
        assert seen == set(range(n))


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert toxicity.toxicity(spark.createDataFrame([(1, "a b", "", 0, "", "")], SCHEMA), none).first()["score"] == pytest.approx(0.5, abs=0.1)
