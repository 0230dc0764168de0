import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import connected

SCHEMA = "doc_id long, text string, _row string, fp string"


def plain(text):
    """The fingerprint bit by bit."""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Smallest member reachable over links of at most 3 bits, by brute force."""
    label = np.arange(len(fps))
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3)
        label = simhash.merged(label, np.full(len(near), i), near)
    return label


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two Words", "ÄRGER Ärger ärger x", "a b c d", "a b c d e a b c " * 3000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_thresholds_obey_the_principle():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for parts in (2, 3, 4):
        bits = simhash._bits(fps).astype(float)
        plan = simhash.Plan(simhash.group_bits(500, bits.T @ bits, parts), rng.integers(0, 50, (parts, 1 << simhash.SLOT_BITS)).astype(float))
        assert sorted(np.concatenate(plan.groups)) == list(range(64))
        chosen = plan.thresholds(plan.values(fps))
        assert (chosen.sum(axis=0) == simhash.RADIUS - parts + 1).all() and chosen.min() >= -1


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_links_find_every_partner(spark, monkeypatch, parts):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, n, replace=False))) for b in base[:60] for n in (1, 3, 4)]
    dense = base[0] ^ (np.uint64(1) << np.arange(60, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, np.array(near, np.uint64), dense]))
    monkeypatch.setattr(simhash, "parts_for", lambda n: parts)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(4)
    got = {r["fp"]: r["component"] for r in simhash.components(rows).collect()}
    want = groups(fps)
    mine = np.array([got[int(x)] for x in fps.view(np.int64)])
    assert all((mine == mine[i]).tolist() == (want == want[i]).tolist() for i in range(len(fps)))


def test_awkward_rows(spark):
    rows = [(3, "same text here again", "x", "y"), (1, "same text here again", None, None), (1, "same text here again", "x", None), (None, "same text here again", "", ""),
            (7, None, "", ""), (6, "", "", ""), (None, "another thing entirely, with words", "", ""), (9, "word " * 30000, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got if r["fingerprint"] == f"{plain(rows[0][1]):016x}") == [("1", 1), ("1", 1), ("3", 1), ("None", 1)]
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {6}
    assert [r["component_id"] for r in got if r["fingerprint"] == f"{plain(rows[6][1]):016x}"] == [None]
    kept = simhash.one_per_group(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "6", "9", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_per_group(docs).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs, "a long, b long"), "a", "b", "t").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}


def test_fingerprint_is_sparks_hash(spark):
    text = "Ärger über drei"
    (got,) = spark.range(1).select(F.xxhash64(F.lit(text))).first()
    assert xxhash.xxh64_intdigest(text.encode(), 42) == got % (1 << 64)
