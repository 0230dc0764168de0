"""Registered queries against their checking SQL on the smallest data set.

All of them by default; set LEDGERLOOM_QUICK=1 for one of each kind.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "spend_by_channel", "spend_by_category", "monthly_summary", "monthly_categories", "transaction_log", "reconciliation",
    "food_spend_last_month", "load_amex", "load_axis_posted", "load_rejects_discover", "new_sub_categories_capitalone",
    "refresh_all", "preview_wellsfargo", "insert_ignore", "replace_into", "onboard_members", "schema_profile",
    "legacy_statement_projection", "text_functions", "global_rank",
]
WANTED = QUICK if os.environ.get("LEDGERLOOM_QUICK") else sorted(n for n in entry.oracle_sql() if n != "pipeline" and not n.startswith("op"))


@pytest.fixture(scope="module")
def checker():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return connect(SF_DIR)


def test_every_query_has_checking_sql():
    ours = {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}
    assert ours == {n for n in entry.oracle_sql() if n != "pipeline" and not n.startswith("op")}


@pytest.mark.skipif("LEDGERLOOM_QUICK" in os.environ, reason="a sample is asked for")
def test_every_query_is_run_by_default():
    assert set(WANTED) == {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}


@pytest.mark.parametrize("name", WANTED)
def test_query_matches_its_sql(spark, checker, name):
    ours, theirs, pairs = differences(spark, checker, name, SF_DIR)
    assert (ours, pairs) == (theirs, [])


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["CHANNEL", "MERCHANT", "TOTAL_AMOUNT"]
