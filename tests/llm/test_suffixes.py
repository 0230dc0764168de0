import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import suffixes

SCHEMA = "doc_id long, text string, block string, data string, n_chars int"


def brute(texts, size=400):
    """Removed spans of each text, by comparing all strings of ``size`` bytes."""
    seen, out = {}, []
    for t in texts:
        for i in range(len(t) - size + 1):
            key = t[i : i + size]
            seen[key] = seen.get(key, 0) + 1
    for t in texts:
        spans = []
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + size
                else:
                    spans.append([i, i + size])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        out.append((len(t), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, texts, window=suffixes.LONG):
    docs = spark.createDataFrame([(i, t, "a", None, 3) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in suffixes.cut_repeats(docs, window=window).select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts], window.size)


@pytest.mark.parametrize("order", [2, 3, 5, 7, 17])
def test_cover_has_every_difference(order):
    cover, period = suffixes.difference_cover(order), order * order + order + 1
    assert len(cover) == order + 1 and len({(a - b) % period for a in cover for b in cover}) == period


def test_packed_keys():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 100, dtype=np.uint64))
    assert (suffixes._unpacked(suffixes._packed(keys)) == keys).all() and len(suffixes._unpacked(b"")) == 0


@pytest.mark.parametrize("piece, block, bucket", [(1 << 18, 4 << 20, 16 << 20), (700, 3000, 4000)])
def test_like_brute_force(spark, monkeypatch, piece, block, bucket):
    monkeypatch.setattr(suffixes, "SLICE", piece)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(suffixes, "HEAVY_BYTES", block // 4)
    rng = random.Random(4)
    said = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, long = [said(n) for n in (360, 380, 399, 400, 401, 900, 2500)], said(1500)
    texts = [None, "", "short", long, long, long + "x", "y" + long, "ab" * 900, said(500) + "z" * 1300]
    texts += [said(rng.randint(0, 700)) + rng.choice(shared) + said(rng.randint(0, 300)) + rng.choice(shared) for _ in range(25)]
    check(spark, texts)


@pytest.mark.parametrize("window", [suffixes.PASSAGE, suffixes.Window(30, 3), suffixes.Window(7, 2)])
def test_other_windows(spark, monkeypatch, window):
    for name, value in (("SLICE", 300), ("BLOCK_BYTES", 2000), ("BUCKET_BYTES", 3000), ("HEAVY_BYTES", 500)):
        monkeypatch.setattr(suffixes, name, value)
    rng = random.Random(window.size)
    said = lambda n: "".join(rng.choice("abcdefgé \n") for _ in range(n))
    shared = [said(n) for n in (window.size - 1, window.size, window.size + 1, 3 * window.size)]
    check(spark, [None, "", "é" * 400] + [said(rng.randint(0, 300)) + rng.choice(shared) + said(rng.randint(0, 300)) for _ in range(40)], window)


def test_exactly_one_window(spark):
    check(spark, ["a" * 399, "b" * 400, "c" * 401, "d" * 399 + "e", "d" * 399 + "e"])


def test_shortened_keeps_columns(spark):
    twice = "xy" + "".join(chr(97 + i * 7 % 26) + "é" for i in range(600))
    docs = spark.createDataFrame([(1, twice, "a", "b", 9), (2, twice[1:], None, None, None), (None, None, None, None, 5), (4, "clean", "", "", 5)], SCHEMA)
    got = suffixes.shortened(docs)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["text"] == "x" and rows[1]["n_chars"] == 1 and rows[2]["text"] == "" and rows[1]["block"] == "a"
    assert rows[None]["text"] is None and rows[4]["text"] == "clean" and rows[4]["n_chars"] == 5


def test_empty_table(spark):
    assert suffixes.cut_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
