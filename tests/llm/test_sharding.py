import duckdb
import pandas as pd
import pytest

from ledgerloom.llm import sharding, sql

SCHEMA = "doc_id long, text string, bits string, h int"


@pytest.mark.parametrize("limit", [50, 700, 5000, 1 << 20])
def test_like_the_sql(spark, limit):
    rows = [(i, "é" * (i % 37), "", 0) for i in range(500)] + [(900, "x" * 2000, "", 0), (901, None, "", 0), (902, "", "", 0)]
    con = duckdb.connect()
    con.register("given", pd.DataFrame([r[:2] for r in rows], columns=["doc_id", "text"]))
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text FROM given")
    want = sorted(con.execute(sql.shards(limit)).fetchall())
    got = sharding.shards(spark.createDataFrame(rows, SCHEMA).repartition(3), limit=limit)
    assert sorted(tuple(r) for r in got.collect()) == want
    entries = [r["entry"] for r in sharding.directory(got).collect()]
    depth = max(r[3] for r in want)
    assert len(entries) == len(set(entries)) <= 2**depth and all(len(e) == depth for e in entries)


def test_repeated_and_null_keys(spark):
    rows = [(1, "x" * 100, "", 0)] * 60 + [(None, "y" * 100, "", 0)] * 30
    got = sharding.shards(spark.createDataFrame(rows, SCHEMA).repartition(3), limit=1000).collect()
    assert len(got) == 90 and all(r["shard_bytes"] <= 1000 for r in got)
    sums = {}
    for r in got:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["n_bytes"]
    assert all(sums[r["shard"]] == r["shard_bytes"] for r in got)


def test_empty_table(spark):
    assert sharding.shards(spark.createDataFrame([], SCHEMA)).count() == 0
