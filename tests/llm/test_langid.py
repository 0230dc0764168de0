import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import langid

SCHEMA = "score long, doc_id long, text string, lang string, lang_pred string, source string, digest int"
SYLLABLES = {"aa": ["ka", "lo", "mi", "nu"], "bb": ["sch", "ei", "ung", "ver"], "cc": ["eau", "qué", "oux", "tre"], "dd": ["жа", "ло", "ми", "ну"]}


def said(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))).capitalize() for _ in range(n)) + "."


def made(seed=3, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((0, i, said(rng, lang, rng.randint(5, 60)), lang, "x", "s", 1))
    return rows


def found(spark, rows):
    return [r.asDict() for r in langid.identified(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_counts_are_those_of_all_grams(monkeypatch):
    texts = [langid.plain(t) for t in ("Ab, ba!", "x" * 50, "é ß Ä", "İstanbul ok")]
    whole = langid.counts(texts)
    want = [sum(1 for n in (1, 2, 3) for i in range(len(t) - n + 1) if n > 1 or t[i] != " ") for t in texts]
    assert whole.sum(1).tolist() == want
    monkeypatch.setattr(langid, "CHUNK", 3)
    assert (langid.counts(texts) == whole).all()
    assert all((langid.counts([t])[0] == row).all() for t, row in zip(texts, whole))


@pytest.mark.parametrize("text, want", [(None, ""), ("", ""), ("12 !", ""), ("²³ _", ""), ("A", " a "), ("a1B_c", " a b c ")])
def test_plain(text, want):
    assert langid.plain(text) == want


def test_clusters_of_one_language():
    rng = np.random.default_rng(1)
    base = np.abs(rng.normal(size=(3, 40))) * (rng.random((3, 40)) < 0.2)
    rows = np.array([base[i % 3] + 0.01 * np.abs(rng.normal(size=40)) for i in range(60)])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres = langid.clustered(rows, 3)
    own = (rows @ centres.T).argmax(1)
    assert len(centres) == 3 and all(len(set(own[i::3])) == 1 for i in range(3)) and len(set(own[:3])) == 3
    assert len(langid.clustered(rows[:1].repeat(5, 0), 3)) == 1


def test_held_out_texts_get_their_language(spark):
    rows = made()
    rng = random.Random(9)
    odd = [(0, 1000, None, "aa", "x", "s", 1), (0, 1001, "", "aa", "x", "s", 1), (0, 1002, "1234 --", "bb", "x", "s", 1), (0, None, said(rng, "cc", 40), None, "x", "s", 1),
           (0, 1003, said(rng, "dd", 60_000), None, "x", "s", 1), (0, 1004, "ⴰⵣⵓⵍ ⴼⵍⵍⴰⵡⵏ", None, "x", "s", 1)] + [rows[7]] * 3
    got = found(spark, rows + odd)
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"]) for r in got)
    told = {r["doc_id"]: r for r in got}
    assert all(told[i]["lang_pred"] == lang for _, i, _, lang, *_ in rows if held(i))
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 and told[i]["rejected"] for i in (1000, 1001, 1002))
    assert told[None]["lang_pred"] == "cc" and told[1003]["lang_pred"] == "dd"
    assert told[1004]["rejected"] and told[1004]["lang_pred"] in SYLLABLES
    assert sum(r["rejected"] for r in got) <= 12


def test_held_out_labels_are_not_read(spark):
    rows = made(4, 120)
    other = [(*r[:3], "zz", *r[4:]) if held(r[1]) else r for r in rows]
    told = [{r["doc_id"]: r for r in found(spark, x)} for x in (rows, other)]
    assert all(told[0][i]["lang_pred"] == told[1][i]["lang_pred"] and abs(told[0][i]["score"] - told[1][i]["score"]) < 1e-5 for i in range(120))


def test_nothing_to_learn_from(spark):
    assert found(spark, []) == []
    got = found(spark, [(0, 1, "some words", None, "x", "s", 1)])
    assert (got[0]["lang_pred"], got[0]["score"]) == ("und", 0.0)
    assert found(spark, [(0, 1, "1", "aa", "x", "s", 1)])[0]["lang_pred"] == "und"
