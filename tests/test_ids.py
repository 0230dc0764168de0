"""Ranks, running totals and identity columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import ids
from ledgerloom.session import stage


def skewed(spark, partitions):
    """A third of the rows share one key, the rest spread out; several rows are equal in full."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), F.col("id") % 40)).alias("k"),
        (F.col("id") % 7).cast("string").alias("v"),
    )
    return df.repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 5])
def test_global_rank_equals_one_sorted_list(spark, partitions):
    ranked = ids.global_rank(skewed(spark, partitions), [F.col("k"), F.col("v")], "rank", "t").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 3001))
    pairs = [(r["k"], r["v"]) for r in ranked]
    assert pairs == sorted(pairs)


def test_global_rank_spreads_equal_rows(spark, monkeypatch):
    """One value for every row still fills several files, with each rank given once."""
    staged = []
    monkeypatch.setattr(ids, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = spark.range(0, 4000, 1, 8).select(F.lit("x").alias("k"))
        ranked = ids.global_rank(same, [F.col("k")], "rank", "t")
        assert ranked.agg(F.count_distinct("rank"), F.max("rank")).first()[:] == (4000, 4000)
        sizes = [r["count"] for r in staged[0].groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_rank_leaves_staged_rows_where_they_are(spark):
    """At a size at which the planner takes the partitions' offsets for too large to send."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        ranked = ids.global_rank(skewed(spark, 5), [F.col("k"), F.col("v")], "rank", "t")
        assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 3001))
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_global_rank_of_nothing(spark):
    assert ids.global_rank(spark.range(0).select(F.lit("x").alias("k")), [F.col("k")], "rank", "t").count() == 0


def test_nulls_come_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = {r["k"]: r["rank"] for r in ids.global_rank(df, [F.col("k")], "rank", "t").collect()}
    assert got == {None: 1, "a": 2, "b": 3}


def test_running_total_over_buckets(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "r").repartition(5)
    got = ids.running_total(df, "r", F.col("r") % 3 == 0, "n", bucket_rows=64).collect()
    assert all(r["n"] == r["r"] // 3 for r in got) and len(got) == 1000


def test_assign_identity_continues_the_counters(spark):
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = ids.assign_identity(new, [F.col("name")], {"id": 7, "key": 1000}, "t").orderBy("name").collect()
    assert [(r["name"], r["id"], r["key"]) for r in got] == [("a", 8, 1001), ("b", 9, 1002)]


def test_lookups_answer_together(spark):
    df = spark.createDataFrame([(3,), (9,)], "n int")
    got = ids.lookups(top=ids.highest(df, "n"), base=ids.highest(df.where("n > 10"), "n", 1000))
    assert got == {"top": 9, "base": 1000}


def test_occurrence_numbers_each_group(spark):
    df = spark.createDataFrame([("a" if i % 3 else None if i % 2 else "b", i) for i in range(200)], "g string, i int").repartition(5)
    got = ids.occurrence(df, F.col("g"), [F.col("i")], "n", "t").collect()
    for g in ("a", "b", None):
        own = sorted((r["i"], r["n"]) for r in got if r["g"] == g)
        assert [n for _, n in own] == list(range(1, len(own) + 1))


def test_occurrence_looks_up_repeated_groups_only_and_keeps_what_is_named(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(ids, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    df = spark.range(300).select("id", F.when(F.col("id") < 290, F.col("id").cast("string")).alias("g"), F.lit("wide").alias("unused"))
    got = ids.occurrence(df, F.concat("g", "unused"), [F.col("id")], "n", "t", ["id"])
    assert got.columns == ["id", "n"] and staged[0].columns == ["id", "_group", "_place"]
    assert sorted(r["n"] for r in got.collect()) == [1] * 291 + list(range(2, 11))
    assert [r["_g"] for r in staged[1].collect()] == [None]
