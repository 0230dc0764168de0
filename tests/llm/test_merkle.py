import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle

SCHEMA = "leaf long, text string, lang string, root string, doc_id long, source string, n_chars long, rank int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def layers(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def steps(tree, at):
    for nodes in tree[:-1]:
        first = at // 8 * 8
        yield nodes[first:at], nodes[at + 1 : first + 8]
        at //= 8


def brute(docs):
    """``docs``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for d in docs:
        groups.setdefault("" if d[2] is None else "=" + d[2], []).append((d[0] is not None, d[0] or 0, leaf(*d), d))
    trees = {g: layers([x[2] for x in sorted(rows, key=lambda x: x[:3])]) for g, rows in groups.items()}
    order = sorted(trees, key=str.encode)
    top = layers([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, (_, _, own, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            way = [*steps(trees[g], at), *steps(top, place)]
            fold = own
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[4] is not None:
                fold = leaf(*d[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in d[4]))
            for before, after in way:
                fold = h(*before, fold, *after)
            proof = h(*(x for before, after in way for x in (*before, *after)))
            out.append((d[0], own, trees[g][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=str)


def found(spark, docs):
    rows = [(1, t, lang, "x", i, s, n, 2) for i, s, lang, n, t in docs]
    return sorted((tuple(r) for r in merkle.verified(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=str)


def test_like_brute_force(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a", None, ""]), rng.choice(["de", "de", "de", "é", "Z", None]), i, rng.choice([None, "", "Ab é", "low", "É ÀB"]) ) for i in range(700)]
    docs += [docs[5]] * 20 + [(None, None, None, None, None)] * 2 + [(None, "s", "de", 3, "Xyz")] + [(9000 + i, "a", f"l{i}", 1, "T") for i in range(12)]
    got = found(spark, docs)
    assert got == brute(docs)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 65])
def test_small_trees(spark, n):
    docs = [(i, "s", "en", 2, "Ab") for i in range(n)]
    assert found(spark, docs) == brute(docs)


def test_some_requests_only(spark):
    docs = [(1, f"Text {i}", "en" if i % 3 else "fr", "x", i, "s", 1, 1) for i in range(200)]
    made = merkle.manifest(spark.createDataFrame(docs, SCHEMA), doc_id=F.col("doc_id"))
    asked = made.leaves.where("doc_id IN (7, 8, 60, 199)").select("g", "rank", "doc_id")
    got = merkle.proofs(made, asked).withColumn("ok", merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).collect()
    assert sorted(r["doc_id"] for r in got) == [7, 8, 60, 199] and all(r["ok"] for r in got)
    want = {d[4]: leaf(d[4], d[5], d[2], d[6], d[1]) for d in docs}
    assert all(r["leaf"] == want[r["doc_id"]] for r in got)


def test_equal_nodes_share_a_record(spark):
    docs = spark.createDataFrame([(1, "t", "en", "x", 1, "s", 1, 1)] * 64, SCHEMA)
    made = merkle.manifest(docs)
    assert [r.count() for r in made.below.records] == [1, 1]
