"""Whole jobs over stored tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from ledgerloom.operators import audit, profile
from ledgerloom.operators.sinks import Warehouse
from ledgerloom.plans import reports
from ledgerloom.plans.pipeline import Ledger
from ledgerloom.schemas import BANKS, LANDING, TABLES
from ledgerloom.session import claimed, staging_root
from tests.test_onboarding import APPLICANTS, applicant

END = datetime(9999, 12, 31, 23, 59, 59)


class Clock:
    def __init__(self):
        self.now = datetime(2025, 1, 1)

    def __call__(self):
        self.now += timedelta(minutes=1)
        return self.now


@pytest.fixture(scope="module")
def ledger(spark):
    store = Warehouse(spark, "ledger_test")
    store.create()
    ledger = Ledger(store, Clock())
    people = [applicant(1, "Ann", "Lee", "1 Oak", "Axis Bank", "4000111122221111"),
              applicant(2, "Ann", "Lee", "1 Oak", "Apple Bank", "4000111122222222")]
    frame = spark.createDataFrame([tuple(p[c] for c in APPLICANTS.columns) for p in people], APPLICANTS.schema)
    assert ledger.onboard(frame, "key") == 6
    return ledger


def statement(spark, *rows):
    return spark.createDataFrame([tuple(r.get(c) for c in LANDING.columns) for r in rows], LANDING.schema)


def axis_rows(spark):
    row = {"TRANSACTION_DATE": "05-01-2025", "DEBIT": "5"}
    return statement(
        spark, {**row, "STATEMENT_DESC": "POS/SHOP/PUNE"}, {**row, "STATEMENT_DESC": "POS/SHOP/PUNE"},
        {**row, "STATEMENT_DESC": "x", "DEBIT": "n/a"},
    )


def staged_tables(spark):
    return set(Path(staging_root(spark).removeprefix("file:")).glob("*"))


def state(ledger, proc):
    rows = audit.latest(ledger.store.read("ETL_LOG")).where(F.col("PROC_NAME") == proc).orderBy("LOG_ID").collect()
    return [(r["STATUS"], r["ROWS_PROCESSED"]) for r in rows]


def done(ledger, proc):
    rows = ledger.runs().where(F.col("PROC_NAME") == proc).orderBy("LOG_ID").collect()
    return [(r["INSERTED"], r["REPLACED"], r["REJECTED"]) for r in rows]


def test_counts_of_runs(spark, tmp_path):
    store = Warehouse(spark, "ledger_counts")
    store.create()
    ledger = Ledger(store, Clock(), keep_counts=True)
    person = applicant(1, "Ann", "Lee", "1 Oak", "Axis Bank", "4000111122221111")
    ledger.onboard(spark.createDataFrame([tuple(person[c] for c in APPLICANTS.columns)], APPLICANTS.schema), "key")
    ledger.load("AXIS", axis_rows(spark), "Ann", "Axis Bank", "1111", rejects_path=str(tmp_path / "rejects"))
    ledger.refresh(["AXIS", "CITI"])
    late = [{"TRANSACTION_DATE": d, "DEBIT": "8", "STATEMENT_DESC": "UPI/P2M/1/SHOP/2"} for d in ("11-01-2025", "02-04-2025")]
    ledger.load("AXIS", statement(spark, *late), "Ann", "Axis Bank", "1111")
    ledger.refresh(["AXIS"], changed_only=True)
    ledger.refresh(["AXIS"], changed_only=True)
    assert done(ledger, "onboard_members") == [(4, None, None)]
    assert done(ledger, "load_axis") == [(2, None, 1), (2, None, None)]
    assert done(ledger, "refresh_axis") == [(2, 0, None), (2, 2, None), (0, 0, None)]  # January holds two earlier facts as well
    assert done(ledger, "refresh_citi") == [(None, None, None)]


def test_load_refresh_and_repeat(spark, ledger, tmp_path):
    store, rejects = ledger.store, str(tmp_path / "rejects")
    before = staged_tables(spark)
    assert ledger.load("AXIS", axis_rows(spark), "Ann", "Axis Bank", "1111", rejects_path=rejects) == 2
    assert [r["REASON"] for r in spark.read.parquet(rejects).collect()] == ["no usable amount"]
    assert store.read("TRANSACTIONS").count() == 2
    assert ledger.load("AXIS", axis_rows(spark), "Ann", "Axis Bank", "1111") == 0
    assert staged_tables(spark) == before
    assert store.read("TRANSACTIONS").count() == 2
    assert state(ledger, "load_axis") == [("SUCCESS", 2), ("SUCCESS", 0)]

    ledger.load(
        "APPLE",
        statement(spark, {"TRANSACTION_DATE": "01/05/2025", "AMOUNT": "3", "DESCRIPTION": "cafe (return)",
                          "STATEMENT_DESC": "Credit"}),
        "Ann", "Apple Bank", "2222",
    )
    states = ledger.refresh(["AXIS", "CITI", "APPLE"])
    assert states == {"AXIS": "SUCCESS", "CITI": "FAILED", "APPLE": "SUCCESS"}
    assert state(ledger, "refresh_citi") == [("FAILED", 0)] and state(ledger, "refresh_apple") == [("SUCCESS", 1)]
    first = sorted((r["TRANSACTION_ID"], r["PAYMENT_CHANNEL"], r["ENTITY_NAME"]) for r in
                   store.read("TRANSACTION_REPORTING").collect())
    assert [r[1:] for r in sorted(first, key=lambda r: r[1])] == [
        ("DEBIT CARD", "SHOP"), ("DEBIT CARD", "SHOP"), ("RETURN", "CAFE")
    ]
    before = store.read("TRANSACTION_REPORTING").agg(F.max("LAST_REFRESHED")).first()[0]
    ledger.refresh(["AXIS"])
    again = store.read("TRANSACTION_REPORTING")
    assert sorted((r["TRANSACTION_ID"], r["PAYMENT_CHANNEL"], r["ENTITY_NAME"]) for r in again.collect()) == first
    assert again.agg(F.max("LAST_REFRESHED")).first()[0] > before
    assert set(_partitions(spark, store.name("TRANSACTIONS"))) == {"BANK_ID=1/TXN_MONTH=202501", "BANK_ID=2/TXN_MONTH=202501"}


def _partitions(spark, table):
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _files(spark, table, where):
    rows = spark.table(table).where(where).select(F.col("_metadata.file_path").alias("f"), "TXN_MONTH").distinct()
    return {(r["TXN_MONTH"], r["f"]) for r in rows.collect()}


def _mined(store):
    return sorted(tuple(r)[:-1] for r in store.read("TRANSACTION_REPORTING").select(*TABLES["TRANSACTION_REPORTING"].columns).collect())


def test_refresh_of_changed_months_only(spark, ledger):
    store, table = ledger.store, ledger.store.name("TRANSACTION_REPORTING")
    rows = [{"TRANSACTION_DATE": d, "DEBIT": "7", "STATEMENT_DESC": f"POS/M{i}/X"} for i, d in enumerate(["07-02-2025", "09-03-2025", "01-03-2025"])]
    ledger.load("AXIS", statement(spark, *rows), "Ann", "Axis Bank", "1111")
    assert ledger.refresh(["AXIS"], changed_only=True) == {"AXIS": "SUCCESS"} and state(ledger, "refresh_axis")[-1] == ("SUCCESS", 3)
    before = _files(spark, table, "BANK_ID = 1")
    others = _files(spark, table, "BANK_ID <> 1")
    assert {m for m, _ in before} == {202501, 202502, 202503}

    ledger.refresh(["AXIS"], changed_only=True)  # nothing came in
    assert state(ledger, "refresh_axis")[-1] == ("SUCCESS", 0) and _files(spark, table, "BANK_ID = 1") == before

    late = [{"TRANSACTION_DATE": d, "DEBIT": "8", "STATEMENT_DESC": "UPI/P2M/1/SHOP/2"} for d in ("11-03-2025", "02-04-2025")]
    ledger.load("AXIS", statement(spark, *late), "Ann", "Axis Bank", "1111")
    ledger.refresh(["AXIS"], changed_only=True)
    after = _files(spark, table, "BANK_ID = 1")
    assert {m for m, _ in after - before} == {202503, 202504} and {m for m, _ in before & after} == {202501, 202502}
    assert _files(spark, table, "BANK_ID <> 1") == others
    partly = _mined(store)
    ledger.refresh(["AXIS"])
    assert _mined(store) == partly and len(partly) == len(set(partly))


def test_summary_is_kept_up_to_date_by_month(spark):
    store = Warehouse(spark, "ledger_sums")
    store.create("TRANSACTIONS", "ETL_LOG")
    clock = Clock()
    ledger = Ledger(store, clock)
    told = lambda df: sorted(map(tuple, df.collect()))

    def add(*facts):
        given = [dict(zip(TABLES["TRANSACTIONS"].columns, [i, d, None, kind, Decimal(amount), "x", *[None] * 7, 1, 1, bank, 1, 1, "u", clock()])) for i, d, kind, amount, bank in facts]
        store.append("TRANSACTIONS", spark.createDataFrame([tuple(f.values()) for f in given], TABLES["TRANSACTIONS"].schema))

    assert ledger.summarize() == 0 and told(ledger.monthly_summary()) == []
    for n in range(5):
        add(*[(10 * n + i, datetime(2025, 1 + (n * i) % 4, 3 + n), "DBT" if i % 3 else "CDT", f"{n + 1}.{i}", 1 + i % 2) for i in range(6)])
        before = _files(spark, store.name("MONTHLY_SUMS"), "true")
        ledger.summarize()
        assert told(ledger.monthly_summary()) == told(reports.monthly_summary(store.read("TRANSACTIONS")))
        touched = {202500 + 1 + (n * i) % 4 for i in range(6)}
        after = _files(spark, store.name("MONTHLY_SUMS"), "true")
        assert {m for m, _ in after - before} == touched and {f for f in before if f[0] not in touched} <= after
    assert ledger.summarize() == 0 and told(ledger.monthly_summary(income_code="CRD")) == told(reports.monthly_summary(store.read("TRANSACTIONS"), income_code="CRD"))
    store.truncate("TRANSACTIONS")
    assert ledger.summarize(whole=True) == 0 and told(ledger.monthly_summary()) == []


def test_load_open_during_a_refresh_is_seen_by_the_next(spark):
    day = lambda h: datetime(2025, 5, 1, h)
    run = lambda i, proc, start, end, bank=1: dict(LOG_ID=i, PROC_NAME=proc, BANK_ID=bank, START_TIME=day(start), END_TIME=end and day(end), ROWS_PROCESSED=1, STATUS="SUCCESS" if end else "STARTED", ERROR_MSG=None)
    since = lambda *rows: audit.unseen_since(audit.log_frame(spark, list(rows)), "refresh_axis", 1)
    refresh = run(3, "refresh_axis", 5, 6)
    assert since() is None and since(run(1, "load_axis", 1, 2)) is None and since({**refresh, "STATUS": "FAILED"}) is None
    assert since(run(1, "load_axis", 1, 2), refresh) == day(5)
    assert since(run(1, "load_axis", 1, 7), refresh, run(4, "load_axis", 8, 9)) == day(1)
    assert since(run(1, "load_axis", 2, None), refresh) == day(2)
    assert since(run(1, "load_axis", 2, None, bank=2), refresh) == day(5)


def test_load_under_a_collation_knows_accented_names(spark, ledger):
    row = {"TRANSACTION_DATE": "01/07/2025", "AMOUNT": "3", "DESCRIPTION": "x", "STATEMENT_DESC": "Debit"}
    load = lambda *names: ledger.load("APPLE", statement(spark, *({**row, "CATEGORY": n, "DESCRIPTION": f"{n} {len(names)}"} for n in names)), "Ann", "Apple Bank", "2222")
    count = lambda: ledger.store.read("MCC_SUB_CATEGORY").count() + ledger.store.read("MCC_CATEGORY").count()
    load("Crème", "Thé")
    before = count()
    spark.conf.set("spark.ledgerloom.nameCollation", "UNICODE_CI_AI")
    try:
        assert load("CREME", "the", "Thè") == 3 and count() == before
    finally:
        spark.conf.unset("spark.ledgerloom.nameCollation")
    assert load("CREME", "the") == 2 and count() > before


def test_months_of_the_rows_must_be_those_given(spark, ledger):
    rows = ledger.store.read("TRANSACTION_REPORTING").where("BANK_ID = 1")
    old = _mined(ledger.store)
    with pytest.raises(ValueError):
        ledger.store.overwrite_partition("TRANSACTION_REPORTING", rows, [202501], BANK_ID=1)
    assert _mined(ledger.store) == old


def test_failed_load_is_logged_and_raised(spark, ledger):
    with pytest.raises(ValueError):
        ledger.load("AXIS", axis_rows(spark), "Nobody", "Axis Bank", "1111")
    with pytest.raises(Exception):
        ledger.load("AXIS", axis_rows(spark).drop("DEBIT"), "Ann", "Axis Bank", "1111")
    assert state(ledger, "load_axis")[-1] == ("FAILED", 0)


def test_moving_closes_a_version(spark, ledger, tmp_path):
    moved = applicant(1, "Ann", "Lee", "9 Elm", "Axis Bank", "4000111122221111")
    frame = spark.createDataFrame([tuple(moved[c] for c in APPLICANTS.columns)], APPLICANTS.schema)
    results = str(tmp_path / "results")
    ledger.onboard(frame, "key", results_path=results)
    result = spark.read.parquet(results).first()
    members = {r["MEMBER_ID"]: (r["IS_CURRENT"], r["EFF_END_DATE"] == END) for r in ledger.store.read("MEMBERS").collect()}
    assert {k: members[k] for k in (1, 2)} == {1: (0, False), 2: (1, True)} and result["ACTIVE_MEMBER_ID"] == 2
    assert ledger.store.read("CARDS").where("LAST_4 = '1111' AND IS_CURRENT = 1").count() == 2


def test_failed_writes_keep_the_old_rows(spark, ledger, monkeypatch):
    """A task that fails while a table is written leaves table and log as they should be."""
    store = ledger.store

    @F.udf("string")
    def fails(x):
        raise RuntimeError("lost")

    broken = lambda rows, column: rows.withColumn(column, fails(F.lit("x")))
    old = sorted(map(tuple, store.read("MEMBERS").collect()))
    with pytest.raises(Exception):
        store.overwrite("MEMBERS", broken(store.read("MEMBERS"), "FIRST_NAME"))
    assert sorted(map(tuple, store.read("MEMBERS").collect())) == old and old

    told = store.read("TRANSACTION_REPORTING")
    rows = sorted(map(str, told.collect()))
    with pytest.raises(Exception):
        store.overwrite_partition("TRANSACTION_REPORTING", broken(told, "ENTITY_NAME"), BANK_ID=1)
    assert sorted(map(str, store.read("TRANSACTION_REPORTING").collect())) == rows and rows

    first = Warehouse.overwrite
    monkeypatch.setattr(Warehouse, "overwrite", lambda self, name, df: first(self, name, broken(df, "FIRST_NAME")))
    new = applicant(1, "Bob", "Ray", "2 Ash", "Axis Bank", "4000111122223333")
    frame = spark.createDataFrame([tuple(new[c] for c in APPLICANTS.columns)], APPLICANTS.schema)
    with pytest.raises(Exception):
        ledger.onboard(frame, "key")
    assert sorted(map(tuple, store.read("MEMBERS").collect())) == old
    assert state(ledger, "onboard_members")[-1] == ("FAILED", 0)
    monkeypatch.undo()
    assert ledger.onboard(frame, "key") == 2  # the address was there already


def test_overwrite_reads_its_own_table(spark, ledger):
    store = ledger.store
    n = store.read("BANKS").count()
    store.overwrite("BANKS", store.read("BANKS").withColumn("ADDED_USER", F.lit("again")))
    store.append("BANKS", store.read("BANKS").limit(1))
    assert store.read("BANKS").count() == n + 1 and store.read("BANKS").where("ADDED_USER = 'again'").count() == n + 1
    store.overwrite("BANKS", store.read("BANKS").dropDuplicates(["BANK_ID"]))
    assert store.read("BANKS").count() == n


def test_profile_of_a_stored_database(spark, ledger):
    lines = profile.profile_database(spark, "ledger_test", TABLES).collect()
    assert {r["TABLE_NAME"] for r in lines} == set(TABLES)
    assert [r["FIELD"] for r in sorted(lines, key=lambda r: r["POSITION"]) if r["TABLE_NAME"] == "TRANSACTIONS"] == TABLES["TRANSACTIONS"].columns


def test_refresh_log_has_the_bank(ledger):
    log = ledger.store.read("ETL_LOG").where("PROC_NAME = 'refresh_axis' AND STATUS = 'SUCCESS'")
    assert {r["BANK_ID"] for r in log.collect()} == {1}


def test_names_of_stored_tables(spark, ledger):
    assert {r[0] for r in profile.list_tables(spark, "ledger_test").collect()} == set(TABLES)
    assert [r["FIELD"] for r in profile.describe(spark, ledger.store.read("BANKS").schema, BANKS).collect()] == BANKS.columns


def test_clear_then_cascade(spark, ledger):
    ledger.clear_transactions()
    assert ledger.store.read("TRANSACTIONS").count() == 0
    assert ledger.store.read("TRANSACTION_REPORTING").count() > 0
    ledger.cascade()
    assert ledger.store.read("TRANSACTION_REPORTING").count() == 0


def test_jobs_take_turns(spark):
    store = Warehouse(spark, "ledger_turns")
    store.create()
    people = [applicant(1, first, "Lee", "1 Oak", bank, card) for first, bank, card in
              (("Ann", "Axis Bank", "4000111122221111"), ("Bob", "Apple Bank", "4000111122222222"))]
    frames = [spark.createDataFrame([tuple(p[c] for c in APPLICANTS.columns)], APPLICANTS.schema) for p in people]
    with ThreadPoolExecutor(2) as threads:
        done = list(threads.map(lambda f: Ledger(store, Clock(), wait=300).onboard(f, "key"), frames))
    assert len(done) == 2
    for table, key in (("MEMBERS", "MEMBER_ID"), ("BANKS", "BANK_ID"), ("CARDS", "CARD_ID")):
        ids = [r[0] for r in store.read(table).select(key).collect()]
        assert len(ids) == len(set(ids)) == 2
    assert audit.latest(store.read("ETL_LOG")).select("STATUS").collect() == [("SUCCESS",)] * 2
    late = Ledger(store, Clock(), wait=0)
    with store.only_writer(0):
        with pytest.raises(TimeoutError):
            late.onboard(frames[0], "key")
    assert late.onboard(frames[0], "key") == 0 and store.read("MEMBERS").count() == 2


def test_writer_file_removed_while_it_is_claimed(spark, tmp_path):
    """The writer before ends between the refused claim and a look at its file: this one has to try again, not to fail."""
    class Place:
        """A path and its store, of which a refused claim finds nothing any more."""

        def __init__(self, name):
            self.file = spark._jvm.org.apache.hadoop.fs.Path(name)
            self.store = self.file.getFileSystem(spark._jsc.hadoopConfiguration())

        def getFileSystem(self, _):
            return self

        def create(self, _, overwrite):
            try:
                return self.store.create(self.file, overwrite)
            except Py4JJavaError:
                self.store.delete(self.file, False)
                raise

        def exists(self, _):
            return self.store.exists(self.file)

    hadoop = SimpleNamespace(fs=SimpleNamespace(Path=Place))
    jvm = SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=hadoop)))
    late = SimpleNamespace(_jvm=jvm, _jsc=spark._jsc)
    path = f"{tmp_path}/_writer"
    assert claimed(spark, path) and not claimed(late, path)
    assert claimed(late, path) and not claimed(spark, path)
