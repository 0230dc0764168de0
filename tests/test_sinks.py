"""Load patterns, checks, profile and the read-only query."""

from __future__ import annotations

import contextlib
import gzip
import io
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import audit, legacy, profile, quality, sinks
from ledgerloom.plans import reports
from ledgerloom.schemas import CATEGORY, ETL_LOG, LANDING, SUB_CATEGORY, TABLES, TRANSACTIONS
from ledgerloom.session import counted, stage, weighed
from ledgerloom.sources import landing as source

NOW = datetime(2025, 1, 1)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_insert_ignore_first_wins_and_the_target_always_wins(spark):
    batch = frame(spark, "id int, o int, v string", (1, 2, "late"), (1, 1, "early"), (2, 1, "x"), (3, 1, "y"))
    target = frame(spark, "id int, v string", (3, "old"))
    assert rows(sinks.insert_ignore(batch, target, ["id"], ["o"])) == [(1, 1, "early"), (2, 1, "x")]


def test_first_per_key_limits_on_the_map_side(spark):
    hot = spark.range(1000).select(F.when(F.col("id") >= 0, 1).otherwise(F.col("id")).alias("id"), (-F.col("id")).alias("o"))
    picked = sinks.first_per_key(hot, ["id"], ["o"])
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        picked.explain()
    assert plan.getvalue().count("WindowGroupLimit") == 2
    assert rows(picked) == [(1, -999)]


def test_replace_into_resets_columns_that_are_not_given(spark):
    target = frame(spark, "id int, a string, b string", (1, "x", "keep"), (2, "y", "z"))
    source_rows = frame(spark, "id int, a string", (1, "new"), (3, "more"))
    table = TABLES["MCC_CATEGORY"]
    full = source_rows.withColumn("b", F.lit(None).cast("string"))
    assert rows(sinks.replace_into(full, target, ["id"]), "id") == [(1, "new", None), (2, "y", "z"), (3, "more", None)]
    stored = frame(spark, CATEGORY.schema, (1, "A", "u", NOW))
    partial = frame(spark, "CATG_ID int, CATG_NAME string", (1, "B"))
    assert rows(sinks.replace_into(partial, stored, ["CATG_ID"], table)) == [(1, "B", None, None)]


@pytest.mark.parametrize("large", [10, 100_000])
def test_insert_ignore_stages_the_batch_where_it_lies(spark, monkeypatch, large):
    """The whole batch is neither sorted nor shuffled; of repeated keys, NULL among them, the first row stays."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return counted(df, label)

    monkeypatch.setattr(sinks, "counted", seen)
    monkeypatch.setattr(sinks, "LARGE_BATCH", large)
    batch = frame(spark, "id long, o int, t string", *[(i, 0, f"t{i}") for i in range(3, 200)], (1, 2, "b"), (1, 1, "a"), (None, 5, "d"), (None, 4, "c"))
    target = frame(spark, "id long, o int, t string", *[(i, 0, "") for i in range(100, 300)])
    wanted = [(i, 0, f"t{i}") for i in range(3, 100)] + [(1, 1, "a"), (None, 4, "c")]
    assert sorted(map(str, rows(sinks.insert_ignore(batch, target, ["id"], ["o"])))) == sorted(map(str, wanted))
    assert len(plans) == 1 and not any(word in plans[0] for word in ("Exchange", "Sort", "Window"))


@pytest.mark.parametrize("size, sent", [(2000, True), (20_000, False)])
def test_insert_ignore_broadcasts_no_ids_that_only_look_few(spark, monkeypatch, size, sent):
    """Ids of a batch whose file is below the broadcast limit, and in memory above it in the second case."""
    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(sinks, "stage", seen)
    monkeypatch.setattr(sinks, "LARGE_BATCH", 10)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        wide = [F.lit("x").alias(f"t{i}") for i in range(10)]
        batch = spark.range(size).select((F.col("id") % (size - 100)).alias("id"), F.col("id").alias("o"), *wide)
        target = stage(spark.range(size // 2, 3 * size).select("id", F.lit(0).cast("long").alias("o"), *wide), "target")
        got = sinks.insert_ignore(batch, target, ["id"], ["o"])
        assert sorted((r["id"], r["o"]) for r in got.select("id", "o").collect()) == [(i, i) for i in range(size // 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert ("BroadcastHashJoin" in plans["insert-held"]) == sent and ("SortMergeJoin" in plans["insert-held"]) != sent


@pytest.mark.parametrize("limit, hinted", [("15k", True), ("17k", False), ("-1", True)])
def test_a_table_is_weighed_by_its_rows(spark, limit, hinted):
    """A thousand ids, 16 bytes each with the header of their row."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert all(("ResolvedHint" in df._jdf.queryExecution().analyzed().toString()) == hinted
                   for df in (weighed(spark.range(1000)), weighed(spark.range(1), 1000)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_insert_missing_ignores_case(spark):
    new = frame(spark, "n string, p int", ("A", 1), ("A", 1), ("b", 1), ("B", 1), ("A", 2))
    have = frame(spark, "n string, p int", ("a", 1))
    assert rows(sinks.insert_missing(new, have, ["n", "p"])) == [("A", 2), ("B", 1)]


def test_small_sinks(spark):
    table = frame(spark, "id int, v string", (1, "a"), (2, "b"))
    assert rows(sinks.update_where(table, F.col("id") == 2, v="c")) == [(1, "a"), (2, "c")]
    assert sinks.truncated(table).count() == 0 and sinks.truncated(table).schema == table.schema
    assert rows(sinks.cascade_delete(table, frame(spark, "id int", (2,)), "id")) == [(2, "b")]
    assert sinks.modify_columns(table, v="binary", LAST_4="string").dtypes == [
        ("id", "int"), ("v", "binary"), ("LAST_4", "string")
    ]
    stored = frame(spark, CATEGORY.schema, (1, "A", "u", NOW))
    grown = sinks.insert_row(stored, CATEGORY, CATG_ID=0, CATG_NAME="Z", ADDED_USER="u", ADDED_DATETIME=NOW)
    assert [r["CATG_ID"] for r in grown.orderBy("CATG_ID").collect()] == [0, 1]


def test_audit_keeps_one_latest_row_per_run(spark):
    empty = spark.createDataFrame([], ETL_LOG.schema)
    first = audit.log_row(empty, "p", 1, NOW)
    log = audit.log_frame(spark, [first])
    second = audit.log_row(log, "q", None, NOW)
    log = audit.log_frame(spark, [
        first, audit.finished(first, NOW, rows=5), second, audit.finished(second, NOW, error="broken"),
        audit.log_row(audit.log_frame(spark, [first, second]), "r", 2, NOW),
    ])
    got = {r["LOG_ID"]: (r["STATUS"], r["ROWS_PROCESSED"], r["ERROR_MSG"]) for r in audit.latest(log).collect()}
    assert got == {1: ("SUCCESS", 5, None), 2: ("FAILED", 0, "broken"), 3: ("STARTED", 0, None)}


def test_quality_report_finds_each_kind_of_breach(spark):
    categories = frame(spark, CATEGORY.schema, (1, "A", "u", NOW), (1, "B" * 151, "u", NOW), (2, "C", "u", NOW))
    subs = frame(spark, SUB_CATEGORY.schema, (1, "A", 1, "u", NOW), (2, "A", 9, "u", NOW), (3, "A", 9, "u", NOW))
    report = quality.quality_report({"MCC_CATEGORY": categories, "MCC_SUB_CATEGORY": subs}, TABLES)
    bad = {(r[0], r[1], r[2]): r[3] for r in report.where("BAD_ROWS > 0").collect()}
    assert bad == {
        ("MCC_CATEGORY", "key", "CATG_ID"): 1, ("MCC_CATEGORY", "length", "CATG_NAME"): 1,
        ("MCC_SUB_CATEGORY", "reference", "CATG_ID -> MCC_CATEGORY"): 2,
    }
    assert quality.longest_breach(categories, CATEGORY) == {"CATG_NAME": 1}
    assert quality.longest_breach(quality.cut_to_length(categories, CATEGORY), CATEGORY) == {}
    assert rows(quality.duplicate_keys(categories, ["CATG_ID"])) == [(1, 2)]


def test_profile(spark):
    names = [f"n{i:02d}" for i in range(40)]
    categories = frame(spark, CATEGORY.schema, *[(i, n, "u", NOW) for i, n in enumerate(names)])
    lines = profile.profile({"MCC_CATEGORY": categories}, TABLES)
    got = {r["FIELD"]: r for r in lines.collect()}
    assert got["CATG_NAME"]["SAMPLES"] == ", ".join(names[:15])
    assert got["ADDED_USER"]["SAMPLES"] is None and got["CATG_ID"]["COLUMN_KEY"] == "PRI"
    assert [r["VALUE"] for r in profile.column_samples(categories, "CATG_NAME", 2).collect()] == names[:2]


@pytest.mark.parametrize("groups", [1, 20, 128])
def test_first_values_of_columns_of_any_kind(spark, monkeypatch, groups):
    monkeypatch.setattr(profile, "GROUPS", groups)
    rng = random.Random(groups)
    columns = {
        "many": [f"v{rng.randrange(10**9):09d}" for _ in range(3000)], "cased": [rng.choice("abcABCxyzXYZ") for _ in range(900)],
        "few": ["b", "a", None] * 40, "same": ["x"] * 500, "none": [None] * 5, "wide": [rng.choice("éÉaA ßÄ") * n for n in range(60)], "fifteen": [f"{i % 15}" for i in range(300)],
    }
    names = list(columns)
    long = frame(spark, "NO int, VALUE string", *[(i, v) for i, n in enumerate(names) for v in columns[n]]).repartition(5)
    got = {names[r["NO"]]: r["SAMPLES"] for r in profile.first_values(long).collect()}
    for name, values in columns.items():
        lowest = {}
        for v in values:
            if v is not None:
                lowest[v.upper()] = min(v, lowest.get(v.upper(), v), key=str.encode)
        want = [lowest[k] for k in sorted(lowest, key=str.encode)[:15]]
        assert got.get(name, []) == want


@pytest.mark.parametrize(
    ("sql", "allowed"),
    [
        ("SELECT 1", True), (" select 'drop table x'", True), ("WITH a AS (SELECT 1 AS n) SELECT * FROM a", True),
        ("DESCRIBE t", True), ("EXPLAIN SELECT 1", True), ("DROP TABLE t", False), ("insert into t values (1)", False),
        ("TRUNCATE TABLE t", False), ("REPLACE INTO t VALUES (1)", False), ("CALL x()", False), ("SET a = 1", False),
        ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", False), ("", False), ("-- x\nDELETE FROM t", False),
        ("UPDATE t SET a = 1", False), ("ALTER TABLE t ADD c int", False), ("CREATE TABLE t (a int)", False),
        ("SELECT java_method('java.lang.System', 'exit', 1)", False), ("SELECT reflect('java.util.UUID', 'randomUUID')", False),
        ("WITH a AS (SELECT 1 AS update) SELECT update FROM a", True), ("SHOW TABLES", True), ("EXPLAIN FORMATTED SELECT 1", True),
        ("EXPLAIN INSERT INTO t VALUES (1)", False), ("SELECT * FROM (SELECT 1) x ORDER BY 1 LIMIT 3", True), ("not sql", False),
    ],
)
def test_read_only_guard(spark, sql, allowed):
    assert profile.is_read_only(spark, sql) is allowed


def test_read_only_query(spark):
    got = profile.read_only_query(spark, "SELECT :a + 1 AS n;", {"a": 1})
    assert list(profile.rows(got)) == [{"n": 2}]
    with pytest.raises(PermissionError):
        profile.read_only_query(spark, "DROP TABLE x")


def test_landing_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Description,Amount,Extra\n"SHOP, ""A""",007\nx,\n')
    got = source.read_csv(spark, str(tmp_path / "s.csv"))
    assert got.schema.fieldNames() == LANDING.columns
    assert sorted((r["DESCRIPTION"], r["AMOUNT"], r["DEBIT"]) for r in got.collect()) == [
        ('SHOP, "A"', "007", None), ("x", None, None)
    ]
    got.write.parquet(str(tmp_path / "p"))
    assert source.read_parquet(spark, str(tmp_path / "p")).count() == 2


def test_landing_files_of_two_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Transaction_Date,Description,Amount\n01/02/2025,A,5\n")
    (tmp_path / "b.csv").write_text("AMOUNT,TRANSACTION_DATE,DESCRIPTION\n6,01/03/2025,B\n7,01/04/2025,C\n")
    got = source.read_csv(spark, str(tmp_path))
    assert sorted((r["TRANSACTION_DATE"], r["DESCRIPTION"], r["AMOUNT"]) for r in got.collect()) == [
        ("01/02/2025", "A", "5"), ("01/03/2025", "B", "6"), ("01/04/2025", "C", "7")
    ]


def test_headers_of_many_files(spark, tmp_path):
    kinds = {"Description,Amount": [], "amount,DESCRIPTION": [], "": []}
    for i in range(60):
        head = list(kinds)[i % 2]
        name = tmp_path / f"part {i}.csv{'.gz' if i % 5 == 0 else ''}"
        text = f"{head}\n" + "".join("a,1\n" if i % 2 == 0 else "1,a\n" for _ in range(i))
        name.write_bytes(gzip.compress(text.encode()) if i % 5 == 0 else text.encode())
        kinds[head].append(name.name)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "_hidden").write_text("other\n")
    got = source.headers(spark, str(tmp_path))
    assert {k: sorted(f.rsplit("/", 1)[1] for f in v) for k, v in got.items()} == {k: sorted(v) for k, v in kinds.items() if v}
    rows = source.read_csv(spark, str(tmp_path)).select("DESCRIPTION", "AMOUNT").distinct().collect()
    assert [tuple(r) for r in rows] == [("a", "1")] and source.read_csv(spark, str(tmp_path)).count() == sum(range(60))


def test_no_landing_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert source.read_csv(spark, str(tmp_path)).count() == 0


def test_reference_by_the_own_key_is_not_counted_by_value_first(spark):
    """Rows of the child count each, a doubled key too; a key goes to its parent without a grouping."""
    facts = frame(spark, "TRANSACTION_ID long", *[(i,) for i in range(50)], (7,))
    told = frame(spark, "TRANSACTION_ID long", *[(i,) for i in range(40, 60)], (59,), (59,), (None,))
    tables = {"TRANSACTION_REPORTING": told, "TRANSACTIONS": facts}
    found = quality.reference_checks(tables, TABLES["TRANSACTION_REPORTING"])
    assert rows(found) == [("TRANSACTION_REPORTING", "reference", "TRANSACTION_ID -> TRANSACTIONS", 12)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" not in plan


def test_reference_to_a_parent_that_is_not_given_is_told(spark):
    subs = frame(spark, SUB_CATEGORY.schema, (1, "A", 1, "u", NOW))
    report = quality.quality_report({"MCC_SUB_CATEGORY": subs}, TABLES)
    assert [(r["DETAIL"], r["BAD_ROWS"]) for r in report.where("CHECK_NAME = 'reference'").collect()] == [("CATG_ID -> MCC_CATEGORY", None)]


def test_names_under_a_collation(spark):
    named = frame(spark, "n string, v int", ("Café", 1), ("CAFE", 2), ("cafe ", 4), ("Cafe", 8), (None, 16), ("Kafe", 32))
    assert rows(reports.by_name(named, ["n"], F.sum("v").alias("v"), collation="UNICODE_CI_AI")) == [(None, 16), ("CAFE", 11), ("Kafe", 32), ("cafe ", 4)]
    assert rows(reports.distinct_values(named, "n", collation="UNICODE_CI_AI")) == [(None,), ("CAFE",), ("Kafe",), ("cafe ",)]
    have = frame(spark, "n string", ("CAFÉ",))
    assert rows(sinks.insert_missing(named.select("n").where("v < 16"), have, ["n"])) == [("CAFE",), ("cafe ",)]
    spark.conf.set("spark.ledgerloom.nameCollation", "UNICODE_CI_AI")
    try:
        assert rows(sinks.insert_missing(named.select("n").where("v < 16"), have, ["n"])) == [("cafe ",)]
        assert rows(named.where(text.same_name(F.col("n"), "cafè")).select("v")) == [(1,), (2,), (8,)]
        assert rows(named.where(text.name_holds(F.col("n"), "ÁF")).select("v")) == [(1,), (2,), (4,), (8,), (32,)]
    finally:
        spark.conf.unset("spark.ledgerloom.nameCollation")


def test_names_in_two_spellings_count_together(spark):
    assert rows(reports.distinct_values(frame(spark, "n string, k int", ("b", 1), ("B", 1), ("a", 1), (None, 1)), "n")) == [(None,), ("B",), ("a",)]
    named = frame(spark, "n string, v int", ("Shop", 1), ("SHOP", 2), (None, 4))
    assert rows(reports.by_name(named, ["n"], F.sum("v").alias("v"))) == [(None, 4), ("SHOP", 3)]
    banks = frame(spark, "BANK_ID int, BANK_NAME string", (1, "One Bank"), (2, "ONE BANK"))
    told = frame(spark, "CARD_ID int, BANK_ID int", (7, 1), (7, 2), (7, 2))
    assert rows(reports.reporting_per_card(told, banks)) == [(3, 7, "ONE BANK")]
    assert [r["VALUE"] for r in profile.column_samples(named, "n").collect()] == ["SHOP"]


def test_equal_sort_values_spread_over_tasks(spark):
    facts = spark.range(40_000).select(F.col("id").alias("TRANSACTION_ID"), F.lit(NOW).alias("ADDED_DATETIME")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in reports.recent_transactions(facts).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_first_values_of_texts_with_one_prefix_odd_bytes_and_cases(spark):
    texts = ["", "\x00", "a", "A\x00", "é", "日本語の長い名前です", "\U0010ffff" * 5, "z" * 40] + [f"one long shared prefix {i:03d}" for i in range(300)]
    given = spark.createDataFrame([(n, t) for n in (1, 2) for t in texts + [t.upper() for t in texts] if n == 1 or t < "b"], "NO int, VALUE string")
    got = {r["NO"]: r["SAMPLES"] for r in profile.first_values(given.repartition(3), 40).collect()}
    for n in (1, 2):
        lowest = {}
        for r in given.where(f"NO = {n}").select("VALUE", F.upper("VALUE").alias("k")).collect():
            lowest[r["k"]] = min(r["VALUE"], lowest.get(r["k"], r["VALUE"]), key=str.encode)
        assert got[n] == [lowest[k] for k in sorted(lowest, key=str.encode)[:40]]


def test_prefix_numbers_give_their_bytes_back(spark):
    given = spark.createDataFrame([("",), ("a",), ("\U0010ffff" * 5,), ("aaaaaaa" + "é" * 4,), ("\x00b" * 9,)], "t string")
    back = given.select("t", profile.number_bytes(profile.prefix_number(F.col("t"))).alias("b")).collect()
    assert all(bytes(r["b"]) == r["t"].encode()[:15].ljust(15, b"\x00") for r in back)


def test_profile_hashes_the_rows_it_reads_and_sorts_none(spark):
    long = spark.range(1000, numPartitions=1).selectExpr("CAST(id % 2 AS int) AS NO", "CAST(uuid() AS string) AS VALUE")
    plan = profile.first_values(long)._jdf.queryExecution().executedPlan().toString()
    # The two that are left are for the lowest spelling of the few values that remain.
    assert plan.count("SortAggregate") == 2 and "partial_min(" in plan


def test_rows_that_lie_by_partition_are_appended_without_a_shuffle(spark):
    store = sinks.Warehouse(spark, "append_test")
    store.create("TRANSACTIONS")
    row = dict.fromkeys(TABLES["TRANSACTIONS"].columns, "x") | {"TRANSACTION_AMOUNT": Decimal(1), "ADDED_DATETIME": NOW, "POSTED_DATE": None}
    row |= dict.fromkeys(("CATG_ID", "SUB_CATG_ID", "CARD_ID", "MEMBER_ID"), 1)
    given = [row | {"TRANSACTION_ID": i, "BANK_ID": i % 2, "TRANSACTION_DATE": datetime(2025, 1 + i % 3, 1)} for i in range(12)]
    rows = spark.createDataFrame([tuple(r.values()) for r in given], TABLES["TRANSACTIONS"].schema)
    assert "Exchange" not in store._ready("TRANSACTIONS", rows, gather=False)._jdf.queryExecution().executedPlan().toString()
    store.append("TRANSACTIONS", rows, gather=False)
    stored = spark.table("append_test.TRANSACTIONS").select("TRANSACTION_ID", "BANK_ID", "TXN_MONTH").collect()
    assert sorted(tuple(r) for r in stored) == [(i, i % 2, 202501 + i % 3) for i in range(12)]


def test_small_batch_does_not_move_the_stored_ids(spark, tmp_path):
    spark.range(300_000).selectExpr("id AS k", "uuid() AS text").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.range(299_950, 300_050).selectExpr("id AS k", "'x' AS text")
    got = sinks.insert_ignore(batch, target, ["k"], ["text"])
    assert got.count() == 50
    plan = got._jdf.queryExecution().executedPlan().toString().split("Final Plan")[-1].split("Initial Plan")[0]
    got.collect()
    above = plan[: plan.index(f"{tmp_path}/t")].split("\n")[-8:]
    assert "BroadcastHashJoin" in plan and not any("Exchange hashpartitioning" in line for line in above[-3:])


def test_legacy_projection_takes_one_owner_and_every_sub_category_of_a_name(spark):
    row = dict.fromkeys(LANDING.columns) | {
        "REFERENCE": "'12", "TRANSACTION_DATE": "01/05/2025", "AMOUNT": "-0.4", "CATEGORY": "A-x", "CITY_STATE": "Ab\nTX",
    }
    statement = frame(spark, LANDING.schema, tuple(row[c] for c in LANDING.columns))
    categories = frame(spark, CATEGORY.schema, (1, "a", "u", NOW))
    subs = frame(spark, SUB_CATEGORY.schema, (1, "X", 1, "u", NOW), (2, "x", 2, "u", NOW))
    owners = [
        frame(spark, "MEMBER_ID int, FIRST_NAME string", (2, "Ann"), (1, "ANN")),
        frame(spark, "BANK_ID int, BANK_NAME string", (3, "B")),
        spark.createDataFrame([], "CARD_ID int, LAST_4 string"),
    ]
    got = legacy.legacy_statement_projection(statement, categories, subs, *owners, "ann", "b", "0000", NOW).collect()
    assert sorted(r["SUB_CATG_ID"] for r in got) == [1, 2]
    assert {(r["TRANSACTION_TYPE"], r["AMOUNT"], r["MEMBER_ID"], r["BANK_ID"], r["CARD_ID"], r["CITY"], r["STATE"])
            for r in got} == {("DBT", Decimal("-0.4000"), 1, 3, None, "Ab", "TX")}


def test_month_with_no_income_is_overspent(spark):
    fact = (1, NOW, None, "CDT", Decimal("100"), "d", None, None, None, None, None, None, None, 1, 1, 1, 1, 1, "u", NOW)
    spent = (2, NOW, None, "DBT", Decimal("80.0001"), *fact[5:])
    table = frame(spark, TRANSACTIONS.schema, fact, spent)
    assert reports.monthly_summary(table).first()["BUDGET_STATUS"] == "OVERSPENT"
    income_only = reports.monthly_summary(frame(spark, TRANSACTIONS.schema, fact)).first()
    assert (income_only["BUDGET_STATUS"], income_only["NET_SAVINGS"]) == ("WITHIN BUDGET", Decimal("100"))
    literal = reports.monthly_summary(table, income_code="CRD").first()
    assert (literal["TOTAL_INCOME"], literal["BUDGET_STATUS"]) == (0, "OVERSPENT")


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_rows_are_counted_as_they_are_written(spark, n):
    rows = spark.range(n).withColumn("v", F.col("id") % 7)
    staged, seen = counted(rows, "counted", rows=F.count(F.lit(1)), most=F.max("v"))
    assert seen == {"rows": n, "most": min(n - 1, 6) if n else None} and staged.count() == n
    assert counted(rows.where("id < 0"), "counted")[1] == {"rows": 0}


@pytest.mark.parametrize("new, old, replaced", [((), (), 0), ((1, 2), (), 0), ((), (1, 2), 0), ((2, 3, 9), (1, 2, 3), 2)])
def test_replaced_rows_are_counted_on_the_way(spark, new, old, replaced):
    batch = spark.createDataFrame([(i, "n") for i in new], "id long, v string")
    target = spark.createDataFrame([(i, "o") for i in old] + [(None, "o")], "id long, v string")
    kept, seen = sinks.untouched_counted(batch, target, ["id"])
    assert sorted(stage(kept, "kept").collect(), key=str) == sorted(sinks.untouched(batch, target, ["id"]).collect(), key=str)
    assert seen.get == {"replaced": replaced}
