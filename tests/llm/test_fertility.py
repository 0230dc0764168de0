import random
import re
from collections import Counter

import pytest

from ledgerloom.llm import fertility

SCHEMA = "doc_id long, text string, lang string, s string, n_words string"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(*(words[i:] for i in range(5))))
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_figures_and_verdicts(spark):
    rng = random.Random(1)
    said = lambda n: " ".join(rng.choice(["the", "house", "is", "running", "over", "green", "hills", "today", "with", "many"]) + rng.choice(["", "", ",", "."]) for _ in range(n))
    texts = [said(rng.randint(1, 300)) for _ in range(160)]
    texts += [None, "", " \n", "a b c d e a b c d e", "x y\nx y\n \nx y\r\n", "one two \x1c three\x0bfour " * 9, "€" * 40 + " 😀" * 90, "x1 q9 " * 4000, "### *** $$$ " * 30]
    junk = "".join(rng.choice("ǂʘ჻ꙮ𐍈") + " " for _ in range(200))
    texts += [junk]
    rows = [(i, t, "en" if i % 7 else None, "", "") for i, t in enumerate(texts)] + [(None, "a", "en", "", "")]
    got = fertility.judged(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found = {r["doc_id"]: r for r in got.collect()}
    assert len(found) == len(rows)
    for i, t in enumerate(texts):
        r, want = found[i], base(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, repr(t)
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    assert not found[len(texts) - 1]["kept"] and found[len(texts) - 1]["fallback_share"] > 0.5
    passed = [found[i] for i in range(160) if not found[i]["base_failed"]]
    assert passed and all(r["kept"] for r in passed)


def test_fertility_figures():
    gauge = fertility.Gauge(fertility.Vocabularies())
    (row,) = gauge.figures(["the the the the"])
    assert row[5:] == (4, 3.0, 0.0, 0.0)
    assert gauge.figures([None, ""])[0][5:] == (0, None, None, None)


def test_empty_table(spark):
    assert fertility.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bands_follow_the_scatter_of_a_length(spark):
    rng = random.Random(4)
    said = lambda n: ["".join(rng.choice(["an", "er", "ti", "lo", "the", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    texts = [" ".join(said(rng.randint(100, 500))) for _ in range(400)]
    cut = [" ".join(w + rng.choice([" |", "", ""]) for w in said(rng.randint(100, 300))) for _ in range(30)]
    rows = [(i, t, "en", "", "") for i, t in enumerate(texts + cut)]
    kept = {r["doc_id"]: r["kept"] for r in fertility.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(kept[i] for i in range(400)) >= 385
    assert sum(kept[i] for i in range(400, 430)) <= 5
