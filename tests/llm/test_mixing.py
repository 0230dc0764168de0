from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, sql

SCHEMA = "doc_id long, source string, text string, _row int, size string"


def rows(seed=3, n=300):
    import random
    rng = random.Random(seed)
    out = [(i, rng.choice(["b", "b", "b", "b", "a", "c", "é", None, "B"]), " ".join("w" for _ in range(rng.choice([0, 1, 5, 60, 400]))), 1, "x") for i in range(n)]
    return out + [(n, "tiny", "one two", 1, ""), (n + 1, "none", None, 1, ""), (n + 2, "none", " \t", 1, "")]


def oracle(data):
    import pandas as pd
    con = duckdb.connect()
    con.register("given", pd.DataFrame([(a, b, c) for a, b, c, *_ in data], columns=["doc_id", "source", "text"]))
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(source AS VARCHAR) AS source, CAST(text AS VARCHAR) AS text FROM given")
    return sorted(con.execute(sql.MIX).fetchall())


@pytest.mark.parametrize("block", [4096, 64, 7])
def test_like_the_closed_form(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing.pieces, "__defaults__", ("mix", "doc_id", block))
    data = rows()
    got = mixing.mix(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == oracle(data)
    by_target, target = Counter(), {}
    for _, size, source_size, goal, taken in found:
        assert 0 <= taken <= 2 * size
        by_target[source_size, goal] += taken
    assert all(abs(taken - goal) < 1 for (_, goal), taken in by_target.items())
    assert sum(by_target.values()) == pytest.approx(1.5 * sum(r[1] for r in found), abs=10)


def test_targets(spark):
    totals = spark.createDataFrame([("a", 100), ("b", 100), ("c", 1000), (None, 10)], "source string, size long")
    got = {r["source"]: (r["weight"], r["target"]) for r in mixing.targets(totals).collect()}
    assert got["a"] == (5, 200.0) and got["b"] == (2, 200.0) and got[None] == (5, 20.0) and got["c"] == (1, 1395.0)


def test_prefixes_of_the_schedule_keep_the_shares(spark):
    totals = spark.createDataFrame([(k, 100_000) for k in "abcdef"], "source string, size long")
    sources = mixing.targets(totals).persist()
    share = {r["sid"]: r["target"] / 900_000 for r in sources.collect()}
    slots = [r["sid"] for r in mixing.schedule(sources, 900, 1000).orderBy("slot").collect()]
    for n in (50, 200, 700):
        counts = Counter(slots[:n])
        assert all(abs(counts[s] - n * share[s]) <= 4 for s in share)


def test_ids_that_repeat_or_miss(spark):
    data = [(1, "a", "x y z", 0, ""), (1, "a", "x y z", 0, ""), (None, "a", "u v", 0, ""), (None, "a", "u v w x", 0, ""), (2, None, "", 0, "")]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == 5 and sum(r["taken"] for r in got) == 18 and all(r["taken"] <= 2 * r["size"] for r in got)


def test_mixed_documents(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    got = mixing.mixed(docs)
    assert got.schema == docs.schema
    times = Counter(r["doc_id"] for r in got.collect())
    assert max(times.values()) == 2 and not any(times[d] for d, _, text, *_ in data if not (text or "").split())
    words = docs.select("doc_id", F.size(F.split("text", " ")).alias("n")).collect()
    assert sum(times[r["doc_id"]] * r["n"] for r in words if times[r["doc_id"]]) == pytest.approx(1.5 * sum(len((t or "").split()) for _, _, t, *_ in data), rel=0.1)


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["taken"] for r in mixing.mix(spark.createDataFrame([(1, "a", "", 0, ""), (2, None, None, 0, "")], SCHEMA)).collect()] == [0, 0]
