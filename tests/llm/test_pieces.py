import random
import time

import pytest

from ledgerloom.llm import pieces

SCHEMA = "doc_id long, text string, ids string, n_chars int, other string"


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary())


def best_score(v, text):
    """Score of the best way through a whole text, without windows."""
    text = " " + text
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        ways = []
        for size in range(1, min(v.longest, end) + 1):
            part = text[end - size : end]
            i = None if pieces.MARK in part else v.pieces.get(part.replace(" ", pieces.MARK))
            if i is not None and best[end - size] is not None:
                ways.append(best[end - size] + v.scores[i])
        if text[end - 1] == pieces.MARK or text[end - 1].replace(" ", pieces.MARK) not in v.pieces:
            ways.append(best[end - 1] + v.unknown)
        best[end] = max(ways)
    return best[-1]


def score(v, ids):
    spelt = b"".join(v.bytes[i] for i in ids if i in set(v.byte_ids))
    return sum(v.scores[i] for i in ids if i not in set(v.byte_ids)) + len(spelt.decode()) * v.unknown


def drawn(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["the", " ", "  ", "\n", "▁", "é", "中", "😀", "ing", "x", "ß", "12", "\t", "qu", "zz"]) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("text", drawn(1, 60) + ["", " ", "   a", "a" * 3000, "\n\n", "▁", "\x00\x01", " ▁ "])
def test_best_way_and_round_trip(encoder, text):
    ids = encoder.encode(text).tolist()
    assert encoder.decode(ids) == text
    assert not text or score(encoder.v, ids) == pytest.approx(best_score(encoder.v, text))


@pytest.mark.parametrize("seed", range(6))
def test_chunks_make_no_difference(encoder, seed):
    rng = random.Random(seed)
    text = " " + "".join(drawn(seed, 20)).replace("▁", "u")
    whole = [i for part in encoder.stream([text]) for i in part]
    cuts = sorted(rng.sample(range(len(text)), 12))
    parts = list(encoder.stream([text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]))
    assert [i for part in parts for i in part] == whole and len(parts) > 3


def test_search_window_stays_small(encoder):
    sizes = [len(part) for part in encoder.stream([" the quick brown fox jumps"] * 200)]
    assert len(sizes) > 50 and max(sizes) < 4 * pieces.STEP


@pytest.mark.parametrize("char", ["a", "-", "=", " ", "é", "中", "😀", "▁", "\n", "0"])
def test_long_runs_are_linear(encoder, char):
    short, long = char * 5_000, "x" + char * 1_000_000 + "y"
    start = time.process_time()
    ids = encoder.encode(long).tolist()
    assert time.process_time() - start < 12 and encoder.decode(ids) == long
    assert score(encoder.v, encoder.encode(short).tolist()) == pytest.approx(best_score(encoder.v, short))


@pytest.mark.parametrize("seed", range(8))
def test_runs_between_other_text(encoder, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["-", "=", "ab", "a", "é", "ing", "😀"]) * rng.randint(1, 400) for _ in range(12))
    assert score(encoder.v, encoder.encode(text).tolist()) == pytest.approx(best_score(encoder.v, text))
    parts = list(encoder.stream([" ", *(text[i : i + 7] for i in range(0, len(text), 7))]))
    assert [i for part in parts for i in part] == encoder.encode(text).tolist()


def test_table(spark, encoder):
    rows = [(1, "one two", "x", 3, None), (2, None, None, None, None), (2, "", "x", 3, "y"), (None, "中" * 5000, "x", 3, "y"), (1, "one two", "x", 3, None)]
    got = pieces.encoded(spark.createDataFrame(rows, SCHEMA), encoder.v)
    assert got.columns == ["doc_id", "other", "n_chars", "n_ids", "ids", "same"]
    found = got.collect()
    assert len(found) == 5 and all(r["same"] and r["n_ids"] == len(r["ids"]) for r in found)
    assert sorted(r["n_chars"] for r in found) == [0, 0, 7, 7, 5000]
    assert pieces.encoded(spark.createDataFrame([], SCHEMA), encoder.v).count() == 0
