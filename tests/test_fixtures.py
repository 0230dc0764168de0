"""How the derived input tables are stored."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixtures
from ledgerloom.session import stage, stage_parts

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture
def fresh(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "_STORED", {})
    monkeypatch.setattr(fixtures, "ROWS_PER_FILE", 100)
    return fixtures.Fixtures(spark, SF_DIR)


def test_files_of_the_base_view_grow_in_number_with_the_orders(spark, fresh):
    fresh.landing("AMEX")
    base = fixtures._STORED[spark.sparkContext.applicationId, SF_DIR, "base"]
    sizes = [r["count"] for r in base.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1500 and len(sizes) > spark.sparkContext.defaultParallelism and max(sizes) < 300


def test_base_view_broadcasts_no_table_that_only_looks_small(spark, fresh, monkeypatch):
    """150 customers have 11 kB in memory and their file, by the columns read, under 6."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(fixtures, "stage", seen)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        assert fresh._base().count() == 1500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans[0].count("SortMergeJoin") == 1 and plans[0].count("BroadcastHashJoin") == 2


def test_facts_and_reporting_rows_are_written_where_they_lie(spark, fresh, monkeypatch):
    """Neither the facts nor what follows from them goes through a shuffle or a sort, and no row is lost."""
    plans = []

    def seen(parts, *how):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for _, df in parts)
        return stage_parts(parts, *how)

    monkeypatch.setattr(fixtures, "stage_parts", seen)
    assert fresh.table("TRANSACTIONS").count() == fresh.reporting().count() == 7 * 1500
    assert len(plans) == 14 and not any("hashpartitioning" in p or "RoundRobin" in p or "Sort" in p for p in plans)


def test_frames_of_one_partition_are_stored_together(spark):
    rows = spark.range(4).selectExpr("id", "CAST(id % 2 AS int) AS p")
    stored = stage_parts([(0, rows.where("p = 0")), (1, rows.where("id = 1")), (1, rows.where("id = 3"))], "t", "p")
    assert sorted(tuple(r) for r in stored.select("id", "p").collect()) == [(0, 0), (1, 1), (2, 0), (3, 1)]
