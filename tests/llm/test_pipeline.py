import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import mixing, pieces, simhash, suffixes, toxicity
from tests.llm.test_simhash import groups
from tests.llm.test_suffixes import brute
from tests.llm.test_toxicity import said

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    texts, labels = {}, []
    for i in range(420):
        bad = [rng.choice(["vilgrub", "vilzork", "vilmuck"]) for _ in range(5)] if i % 4 == 0 else []
        texts[i] = said(rng, rng.randint(30, 150), bad)
        labels.append((i, 1, int(bool(bad))))
    passage = said(rng, 120)
    for i in range(500, 506):
        texts[i] = said(rng, 60) + " " + passage + " " + said(rng, 60)
    for n in range(51, 61):  # words of a passage that three documents share
        passage = said(rng, n)
        for i in range(800 + 3 * (n - 51), 803 + 3 * (n - 51)):
            texts[i] = said(rng, 90) + " " + passage + " " + said(rng, 90)
    for i in range(600, 640):
        texts[i] = texts[1]
    texts |= {700: None, 701: "", 702: "  "}
    rows = [(i, t, "en", rng.choice(["a", "b", None]), len(t or ""), "x") for i, t in texts.items()]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, texts


def test_each_stage_on_what_the_one_before_kept(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        after = corpus_pipeline.stage(step(spark, docs, path), f"test-{name}")
        kept[name] = (docs.collect(), after.collect())
        if name != "sentencepiece":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        docs = after

    before, after = kept["toxicity"]
    scores = toxicity.Scorer(toxicity.fit(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")))
    told = dict(zip(texts, scores.scores(list(texts.values()))[0]))
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, s in told.items() if s < 0.5)
    assert sum(i < 420 and i % 4 == 0 for i in (r["doc_id"] for r in after)) <= 10 and len(after) > 330

    before, after = kept["simhash"]
    left = {r["doc_id"] for r in after}
    assert not left & set(range(600, 640)) and left & {700, 701, 702} == {700} and len(left) == len(after)
    ids = sorted(r["doc_id"] for r in before)
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in before}
    label = groups(np.array([fps[i] for i in ids], np.uint64)).tolist()
    assert left == {ids[label.index(x)] for x in set(label)}

    before, after = kept["suffix_dedup"]
    want = dict(zip((r["doc_id"] for r in before), brute([(r["text"] or "").encode() for r in before], 200)))
    assert all(len((r["text"] or "").encode()) == want[r["doc_id"]][0] - want[r["doc_id"]][1] for r in after)
    assert sum(want[i][1] > 500 for i in range(500, 506) if i in want) >= 5
    assert sum(want[i][1] >= 200 for i in range(800, 830) if i in want) >= 27
    clean = [i for i in want if i < 420]
    assert sum(want[i][1] == 0 for i in clean) >= 0.98 * len(clean)
    assert all(r["n_chars"] == len(r["text"] or "") for r in after)

    before, after = kept["mixing"]
    times = Counter(r["doc_id"] for r in after)
    assert set(times.values()) <= {1, 2} and set(times) <= {r["doc_id"] for r in before if (r["text"] or "").split()}

    before, after = kept["sentencepiece"]
    encoder = pieces.Encoder(pieces.Vocabulary())
    said_before = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before) and all(encoder.decode(r["ids"]) == said_before[r["doc_id"]] for r in after)


def test_run_is_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns[-4:] == ["n_chars", "n_ids", "ids", "same"] and got.where("NOT same").isEmpty() and got.count() > 100


def test_stages_take_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for step in (simhash.one_per_group, suffixes.shortened, mixing.mixed, pieces.encoded):
        assert step(docs).count() == 0
