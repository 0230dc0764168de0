
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime
from importlib import import_module
from importlib.util import find_spec
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from ledgerloom.fixtures import AS_OF, BANK_NUMBER, DESCRIPTIONS, Fixtures  # noqa: E402
from ledgerloom.functions import text as X  # noqa: E402
from ledgerloom.functions.ids import global_rank, hash_id  # noqa: E402
from ledgerloom.functions.secrets import ECB, decrypt  # noqa: E402
from ledgerloom.operators import audit, legacy, loaders, mining, onboarding, profile, quality, sinks  # noqa: E402
from ledgerloom.plans import reports  # noqa: E402
from ledgerloom.plans.pipeline import Ledger  # noqa: E402
from ledgerloom.schemas import REPORTING, TABLES, TRANSACTIONS  # noqa: E402
from ledgerloom.session import staging_root  # noqa: E402
from ledgerloom.sources import landing  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_DIR = "/root/testdata/sf0.001"
USER, LAST_4, KEY = "Customer#000000001", "0001", "not a real key"
BANK_NAMES = {
    "AXIS": "Axis Bank", "WELLSFARGO": "WellsFargo Bank", "AMEX": "American Express", "DISCOVER": "Discover Bank",
    "CAPITALONE": "CapitalOne Bank", "APPLE": "Apple Bank", "CITI": "Citi Bank",
}
POSTED_VARIANTS = ("AXIS", "WELLSFARGO", "CITI")
LATER = datetime(2025, 2, 1)
LATE_FROM = datetime(1998, 6, 20)


def _dims(fx: Fixtures) -> loaders.Dimensions:
    names = ("MCC_CATEGORY", "MCC_SUB_CATEGORY", "BANKS", "MEMBERS", "CARDS")
    return loaders.Dimensions(*[fx.table(n) for n in names])


def _load(spark, sf, bank, **options) -> loaders.LoadResult:
    """A load against the whole stored fact table, some of whose ids the statement holds again."""
    fx = Fixtures(spark, sf)
    return loaders.load_statement(
        bank, fx.landing(bank), _dims(fx), fx.table("TRANSACTIONS"), USER, BANK_NAMES[bank], LAST_4, AS_OF, **options
    )


def _enriched(fx: Fixtures, bank: str) -> DataFrame:
    return mining.enrich(
        bank, fx.table("TRANSACTIONS"), fx.table("MCC_CATEGORY"), fx.table("MCC_SUB_CATEGORY"), BANK_NUMBER[bank], AS_OF
    )


def _preview(fx: Fixtures, bank: str) -> DataFrame:
    return mining.preview(bank, fx.table("TRANSACTIONS"), fx.table("MCC_SUB_CATEGORY"), BANK_NUMBER[bank])


def _over(function: Callable, *tables: str, **options) -> Query:
    """A query that hands stored tables to a report function."""
    def run(spark, sf):
        fx = Fixtures(spark, sf)
        given = [fx.reporting() if n == "TRANSACTION_REPORTING" else fx.table(n) for n in tables]
        return function(*given, **options)

    return run


def _onboarded(spark, sf) -> onboarding.Onboarded:
    fx = Fixtures(spark, sf)
    dims = [fx.table(n) for n in ("APPLICANTS", "MEMBER_ADDRESS", "MEMBERS", "BANKS", "CARDS")]
    return onboarding.onboard(*dims, KEY, AS_OF, mode=ECB)


def _opened_secrets(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: decrypt(F.col(c), KEY, ECB) for c in columns})


def _members_after(spark, sf) -> DataFrame:
    members = Fixtures(spark, sf).table("MEMBERS")
    after = onboarding.members_after(members, _onboarded(spark, sf), AS_OF)
    return _opened_secrets(after, "DATE_OF_BIRTH")


def _replace(spark, sf) -> DataFrame:
    """Apple's rows again, later and without a place: the place falls back to its default."""
    fx = Fixtures(spark, sf)
    rows = _enriched(fx, "APPLE").drop("GEOGRAPHY").withColumn("LAST_REFRESHED", X.moment(LATER))
    return sinks.replace_into(rows, fx.reporting(), list(REPORTING.key), REPORTING)


def _cascade(spark, sf) -> DataFrame:
    fx = Fixtures(spark, sf)
    left = fx.table("TRANSACTIONS").where("TRANSACTION_TYPE = 'DBT'")
    return sinks.cascade_delete(fx.reporting(), left, "TRANSACTION_ID")


def _reconcile(spark, sf) -> DataFrame:
    """As after a refresh in which one bank failed."""
    fx = Fixtures(spark, sf)
    done = fx.reporting().where(F.col("BANK_ID") != BANK_NUMBER["CITI"])
    return reports.reconciliation(fx.table("TRANSACTIONS"), done)


def _insert_ignore(spark, sf) -> DataFrame:
    """Reporting rows of one bank, numbered past some of the stored ids, into the whole reporting table."""
    fx = Fixtures(spark, sf)
    rows = _enriched(fx, "APPLE").withColumn("TRANSACTION_ID", F.col("TRANSACTION_ID") * 2)
    return sinks.insert_ignore(rows, fx.reporting(), list(REPORTING.key), ["TRANSACTION_DATE"]).select(*REPORTING.columns)


def _insert_missing(spark, sf) -> DataFrame:
    fx = Fixtures(spark, sf)
    names = fx.landing("AMEX").where("CATEGORY IS NOT NULL").select(
        X.clean_upper(X.before(F.col("CATEGORY"), "-")).alias("CATG_NAME")
    )
    return sinks.insert_missing(names, fx.table("MCC_CATEGORY"), ["CATG_NAME"])


def _insert_row(spark, sf) -> DataFrame:
    return sinks.insert_row(
        Fixtures(spark, sf).table("MCC_CATEGORY"), TABLES["MCC_CATEGORY"], CATG_ID=0, CATG_NAME=legacy.CREDIT_TO_BANK,
        ADDED_USER="LOADER", ADDED_DATETIME=AS_OF,
    )


def _rename(spark, sf) -> DataFrame:
    subs = Fixtures(spark, sf).table("MCC_SUB_CATEGORY")
    return sinks.update_where(subs, F.col("SUB_CATG_ID") == 32, SUB_CATG_NAME=legacy.CREDIT_TO_BANK)


def _modify(spark, sf) -> DataFrame:
    cards = Fixtures(spark, sf).table("CARDS").withColumn("CARD_TEXT", F.col("CARD_ID").cast("string"))
    changed = sinks.modify_columns(cards.drop("LAST_4"), CARD_TEXT="binary", LAST_4="string")
    return changed.select("CARD_ID", "CARD_TYPE", F.col("CARD_TEXT").cast("string").alias("CARD_TEXT"), "LAST_4")


def _seed_subs(spark, sf) -> DataFrame:
    """With one stored category under a statement's name, so that the name join has a match."""
    fx = Fixtures(spark, sf)
    categories = sinks.update_where(fx.table("MCC_CATEGORY"), F.col("CATG_ID") == 1, CATG_NAME="AUTOMOBILE")
    return legacy.seed_sub_categories(fx.landing("AMEX"), categories, fx.table("MCC_SUB_CATEGORY"), AS_OF)


def _legacy_projection(spark, sf) -> DataFrame:
    fx = Fixtures(spark, sf)
    dims = [fx.table(n) for n in ("MCC_CATEGORY", "MCC_SUB_CATEGORY", "MEMBERS", "BANKS", "CARDS")]
    return legacy.legacy_statement_projection(fx.landing("AMEX"), *dims, USER, "American Express", LAST_4, AS_OF)


def _stored_tables(spark, sf) -> dict[str, DataFrame]:
    """All declared tables, in their declared types."""
    fx = Fixtures(spark, sf)
    special = {"TRANSACTION_REPORTING": fx.reporting, "LND_TRANSACTIONS": lambda: fx.landing("AMEX")}
    rows = {n: special[n]() if n in special else fx.table(n) for n in TABLES}
    return {n: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[n].schema]) for n, df in rows.items()}


def _warehouse(spark, sf, *names: str, **given: DataFrame) -> sinks.Warehouse:
    """A database of its own in the shared folder that holds the tables named, or all; some with the rows given.

    The rows come from tables that are stored by bank and date.
    """
    store = sinks.Warehouse(spark, f"ledger_{uuid4().hex}")
    store.create(*names, location=f"{staging_root(spark)}/{store.database}")
    tables = _stored_tables(spark, sf) | given
    for name in names or TABLES:
        store.append(name, tables[name], gather=False)
    return store


def _refresh_changed(spark, sf) -> DataFrame:
    """The reporting table after a late statement of one bank: only the months that it fell in are refreshed."""
    tables = _stored_tables(spark, sf)
    late = (F.col("BANK_ID") == BANK_NUMBER["APPLE"]) & (F.col("TRANSACTION_DATE") >= F.lit(LATE_FROM).cast("timestamp_ntz"))
    run = audit.log_row(tables["ETL_LOG"], "refresh_apple", BANK_NUMBER["APPLE"], datetime(2026, 1, 15))
    log = audit.log_frame(spark, [audit.finished(run, datetime(2026, 1, 15, 1))])
    names = ("TRANSACTIONS", "TRANSACTION_REPORTING", "MCC_CATEGORY", "MCC_SUB_CATEGORY", "BANKS", "ETL_LOG")
    before = {n: tables[n].where(~late) for n in names[:2]}
    store = _warehouse(spark, sf, *names, **before, ETL_LOG=log)
    store.append("TRANSACTIONS", tables["TRANSACTIONS"].where(late).withColumn("ADDED_DATETIME", X.moment(datetime(2026, 1, 20))))
    Ledger(store, clock=lambda: datetime(2026, 2, 1)).refresh(["APPLE"], changed_only=True)
    return store.read("TRANSACTION_REPORTING")


def _summary_kept(spark, sf) -> DataFrame:
    """The monthly summary from stored sums, brought up to date after late facts of one bank."""
    facts, log = (_stored_tables(spark, sf)[n] for n in ("TRANSACTIONS", "ETL_LOG"))
    late = (F.col("BANK_ID") == BANK_NUMBER["APPLE"]) & (F.col("TRANSACTION_DATE") >= F.lit(LATE_FROM).cast("timestamp_ntz"))
    store = _warehouse(spark, sf, "TRANSACTIONS", "ETL_LOG", TRANSACTIONS=facts.where(~late), ETL_LOG=log.limit(0))
    times = iter([datetime(2027, 2, d) for d in range(1, 9)])
    ledger = Ledger(store, clock=lambda: next(times))
    ledger.summarize()
    store.append("TRANSACTIONS", facts.where(late).withColumn("ADDED_DATETIME", X.moment(datetime(2027, 2, 2))))
    ledger.summarize()
    return ledger.monthly_summary()


def _truncate(spark, sf) -> DataFrame:
    """Rows of a stored fact table before and after it is emptied."""
    store = _warehouse(spark, sf, "TRANSACTIONS")
    counts = {"before": store.read("TRANSACTIONS").count()}
    store.truncate("TRANSACTIONS")
    counts["after"] = store.read("TRANSACTIONS").count()
    return spark.createDataFrame(list(counts.items()), "STATE string, N long")


def _profile_database(spark, sf) -> DataFrame:
    return profile.profile_database(spark, _warehouse(spark, sf).database, TABLES)


def _landing_csv(spark, sf) -> DataFrame:
    """A statement in files of two column orders, read as one."""
    rows = Fixtures(spark, sf).landing("CITI")
    folder = f"{staging_root(spark)}/csv-{uuid4().hex}"
    odd = F.length("DESCRIPTION") % 2 == 1
    as_is = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.where(odd).write.csv(f"{folder}/one", **as_is)
    rows.where(~F.coalesce(odd, F.lit(False))).select(*reversed(rows.columns)).write.csv(f"{folder}/two", **as_is)
    blank = {c: F.nullif(F.col(c), F.lit("")) for c in ("DEBIT", "CREDIT")}  # a file has one form for both
    return landing.read_csv(spark, f"{folder}/*").withColumns(blank)


def _read_only(spark, sf) -> DataFrame:
    Fixtures(spark, sf).table("TRANSACTIONS").createOrReplaceTempView("ledger_facts")
    return profile.read_only_query(
        spark, "SELECT BANK_ID, count(*) AS CNT, CAST(sum(TRANSACTION_AMOUNT) AS DECIMAL(38,4)) AS TOTAL "
               "FROM ledger_facts GROUP BY BANK_ID"
    )


def _text_functions(spark, sf) -> DataFrame:
    d = F.col("DESCRIPTION")
    amount = F.col("TRANSACTION_AMOUNT")
    return Fixtures(spark, sf).table("TRANSACTIONS").select(
        "TRANSACTION_ID",
        X.nth_field(d, "/", 2).alias("second_field"),
        X.after_last(d, " ").alias("last_word"),
        X.byte_length(d).alias("byte_size"),
        F.locate(" ", d).alias("space_at"),
        F.right(d, F.lit(4)).alias("last_four"),
        F.btrim(d, F.lit("/")).alias("no_slashes"),
        X.drop_all(F.replace(d, F.lit("A"), F.lit("E")), ["TST* "]).alias("replaced"),
        F.concat_ws(" ", "EXT_DESCRIPTION", "ZIPCODE").alias("joined"),
        F.concat("EXT_DESCRIPTION", "ZIPCODE").alias("strict_joined"),
        X.regex_drop(d, "[0-9]+", "#").alias("masked"),
        X.regex_first(d, "[0-9]{10,}").alias("long_number"),
        amount.try_cast("decimal(30,0)").alias("whole"),
        X.plain_number_text(amount).alias("plain_amount"),
        reports.month().alias("month"),
        reports.month(pattern="yyyy-MM-01").alias("month_start"),
        F.coalesce("EXT_DESCRIPTION", F.lit("none")).alias("filled"),
        F.nullif(F.col("TRANSACTION_TYPE"), F.lit("CDT")).alias("debit_only"),
        hash_id(F.concat(d, F.col("ZIPCODE"))).alias("hashed"),
    )


def _accented(spark, sf) -> DataFrame:
    """Statement rows in which every other category is spelt with accents, counted and summed by name."""
    spelt = F.translate("CATEGORY", "AEIOUaeiou", "ÁÈÎÕÜáèîõü")
    rows = Fixtures(spark, sf).landing("AMEX").withColumn("CATEGORY", F.when(F.length("DESCRIPTION") % 2 == 1, spelt).otherwise(F.col("CATEGORY")))
    return reports.by_name(rows, ["CATEGORY"], F.count(F.lit(1)).alias("CNT"), F.sum(F.length("DESCRIPTION")).alias("N_CHARS"), collation="UNICODE_CI_AI")


def _global_rank(spark, sf) -> DataFrame:
    facts = Fixtures(spark, sf).table("TRANSACTIONS").select("TRANSACTION_DATE", "DESCRIPTION", "TRANSACTION_ID")
    order = [F.col(c) for c in facts.columns]
    return global_rank(facts, order, "RANK", "rank").select("TRANSACTION_ID", "RANK")


def _optional(of: str) -> dict:
    """What the operators for training data and their pipeline add, where those modules are there."""
    found = {}
    if find_spec("ledgerloom.llm"):
        found |= getattr(import_module("ledgerloom.llm.queries"), of)()
        if find_spec("corpus_pipeline"):
            pipeline = import_module("corpus_pipeline")
            if of == "queries":
                found["pipeline"] = pipeline.run
            elif pipeline.ORACLE_SQL:
                found["pipeline"] = pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Money out per payment channel and merchant, read from the bank descriptions."""
    return reports.spend_by_channel(Fixtures(spark, FLAGSHIP_DIR).table("TRANSACTIONS"))


def queries() -> dict[str, Query]:
    t, r = "TRANSACTIONS", "TRANSACTION_REPORTING"
    c, s = "MCC_CATEGORY", "MCC_SUB_CATEGORY"
    found: dict[str, Query] = {
        "transaction_log": _over(reports.transaction_log, t, "MEMBERS", "BANKS", "CARDS"),
        "spend_by_category": _over(reports.spend_by_category, t, c, s),
        "active_members": _over(reports.active_members, "MEMBERS", "MEMBER_ADDRESS"),
        "monthly_summary": _over(reports.monthly_summary_view, t),
        "monthly_summary_kept": _summary_kept,
        "monthly_summary_crd": _over(reports.monthly_summary, t, income_code="CRD"),
        "spend_by_channel": _over(reports.spend_by_channel, t),
        "monthly_categories": _over(reports.monthly_categories, t, c, s),
        "monthly_categories_short_order": _over(reports.monthly_categories, t, c, s, full_order=False),
        "transactions_per_card": _over(reports.transactions_per_card, t, "CARDS", "BANKS"),
        "reporting_per_card": _over(reports.reporting_per_card, r, "BANKS"),
        "reconciliation": _reconcile,
        "distinct_categories": lambda spark, sf: reports.distinct_values(Fixtures(spark, sf).landing("AMEX"), "CATEGORY"),
        "names_by_collation": _accented,
        "recent_transactions": _over(reports.recent_transactions, t),
        "food_spend_last_month": _over(
            reports.keyword_spend, r, words=reports.FOOD_WORDS, as_of=date(2001, 6, 15)
        ),
        "counterparty_spend": _over(reports.counterparty_spend, r, name="Amazon"),
        "month_spend_by_bank": _over(reports.month_spend_by_bank, r, "BANKS", first_day=date(1998, 3, 1)),
        "refresh_all": lambda spark, sf: Fixtures(spark, sf).reporting(),
        "refresh_changed": _refresh_changed,
        "insert_ignore": _insert_ignore,
        "replace_into": _replace,
        "insert_missing": _insert_missing,
        "insert_row": _insert_row,
        "update_where": _rename,
        "truncate": _truncate,
        "landing_csv": _landing_csv,
        "audit_latest": _over(audit.latest, "ETL_LOG"),
        "cut_to_length": lambda spark, sf: quality.cut_to_length(
            Fixtures(spark, sf).landing("APPLE").select("DESCRIPTION", "CATEGORY"), TRANSACTIONS
        ),
        "profile_database": _profile_database,
        "onboard_rejects": lambda spark, sf: _onboarded(spark, sf).rejects.select("APPLICANT_NO", "REASON"),
        "cascade_delete": _cascade,
        "modify_columns": _modify,
        "onboard_addresses": lambda spark, sf: _onboarded(spark, sf).new_addresses,
        "onboard_banks": lambda spark, sf: _onboarded(spark, sf).new_banks,
        "onboard_members": _members_after,
        "onboard_cards": lambda spark, sf: _opened_secrets(
            _onboarded(spark, sf).new_cards, "CARD_NUMBER", "EXP_DATE", "CVV"
        ),
        "onboarding_results": lambda spark, sf: _onboarded(spark, sf).results,
        "quality_report": lambda spark, sf: quality.quality_report(_stored_tables(spark, sf), TABLES),
        "duplicate_keys": lambda spark, sf: quality.duplicate_keys(Fixtures(spark, sf).landing("AMEX"), ["REFERENCE"]),
        "orphans": _over(lambda facts, subs: quality.orphans(facts, "SUB_CATG_ID", subs, "SUB_CATG_ID"), t, s),
        "too_long": lambda spark, sf: quality.too_long(Fixtures(spark, sf).landing("APPLE"), "DESCRIPTION", 100),
        "column_samples": _over(lambda facts: profile.column_samples(facts, "DESCRIPTION"), t),
        "schema_profile": lambda spark, sf: profile.profile(_stored_tables(spark, sf), TABLES),
        "read_only_query": _read_only,
        "category_split": lambda spark, sf: legacy.category_split(Fixtures(spark, sf).landing("AMEX")),
        "seed_categories": lambda spark, sf: legacy.seed_categories(
            Fixtures(spark, sf).landing("AMEX"), Fixtures(spark, sf).table(c), AS_OF
        ),
        "seed_sub_categories": _seed_subs,
        "legacy_statement_projection": _legacy_projection,
        "text_functions": _text_functions,
        "global_rank": _global_rank,
    }
    for bank in DESCRIPTIONS:
        low = bank.lower()
        found[f"load_{low}"] = lambda spark, sf, b=bank: _load(spark, sf, b).transactions
        found[f"load_rejects_{low}"] = lambda spark, sf, b=bank: _load(spark, sf, b).rejects
        found[f"mine_{low}"] = lambda spark, sf, b=bank: _enriched(Fixtures(spark, sf), b)
        found[f"preview_{low}"] = lambda spark, sf, b=bank: _preview(Fixtures(spark, sf), b)
        found[f"new_categories_{low}"] = lambda spark, sf, b=bank: _load(spark, sf, b).new_categories
        found[f"new_sub_categories_{low}"] = lambda spark, sf, b=bank: _load(spark, sf, b).new_sub_categories
        if bank != "AMEX":
            found[f"load_{low}_occurrence"] = (
                lambda spark, sf, b=bank: _load(spark, sf, b, id_mode="occurrence").transactions
            )
    for bank in POSTED_VARIANTS:
        found[f"load_{bank.lower()}_posted"] = (
            lambda spark, sf, b=bank: _load(spark, sf, b, with_posted_date=True).transactions
        )
    return found | _optional("queries")


def oracle_sql() -> dict[str, str]:
    from oracles import loading, mining as mined, onboarding as boarded, reports as told

    sql = {
        "transaction_log": told.TRANSACTION_LOG,
        "spend_by_category": told.SPEND_BY_CATEGORY,
        "active_members": told.ACTIVE_MEMBERS,
        "monthly_summary": told.monthly("CDT"),
        "monthly_summary_kept": told.monthly("CDT"),
        "monthly_summary_crd": told.monthly("CRD"),
        "spend_by_channel": mined.channel_sql(),
        "monthly_categories": told.MONTHLY_CATEGORIES,
        "monthly_categories_short_order": told.MONTHLY_CATEGORIES,
        "transactions_per_card": told.PER_CARD,
        "reporting_per_card": told.reporting_per_card(),
        "reconciliation": told.reconciliation(),
        "distinct_categories": told.DISTINCT_CATEGORIES,
        "names_by_collation": told.ACCENTED,
        "recent_transactions": told.RECENT,
        "food_spend_last_month": told.food(),
        "counterparty_spend": told.counterparty(),
        "month_spend_by_bank": told.month_by_bank(),
        "refresh_all": mined.reporting_sql(),
        "refresh_changed": told.refreshed_late(LATE_FROM, BANK_NUMBER["APPLE"]),
        "insert_ignore": told.ignored(),
        "replace_into": told.replaced(),
        "insert_missing": told.INSERT_MISSING,
        "insert_row": told.SEEDED_ROW,
        "update_where": told.RENAMED,
        "truncate": told.TRUNCATED,
        "landing_csv": told.LANDING_CSV,
        "audit_latest": told.LATEST_LOG,
        "cut_to_length": told.CUT,
        "profile_database": told.profile(),
        "onboard_rejects": boarded.REJECTS,
        "cascade_delete": told.cascaded(),
        "modify_columns": told.MODIFIED.replace("LAST_4 FROM", "CAST(NULL AS VARCHAR) AS LAST_4 FROM"),
        "onboard_addresses": boarded.ADDRESSES,
        "onboard_banks": boarded.BANKS,
        "onboard_members": boarded.MEMBERS_AFTER,
        "onboard_cards": boarded.CARDS,
        "onboarding_results": boarded.RESULTS,
        "quality_report": told.quality(),
        "duplicate_keys": told.DUPLICATE_REFERENCES,
        "orphans": told.ORPHANS,
        "too_long": told.TOO_LONG,
        "column_samples": told.SAMPLES,
        "schema_profile": told.profile(),
        "read_only_query": told.READ_ONLY,
        "category_split": told.SPLIT,
        "seed_categories": told.SEED_CATEGORIES,
        "seed_sub_categories": told.SEED_SUB_CATEGORIES,
        "legacy_statement_projection": told.legacy(),
        "text_functions": told.text_functions(),
        "global_rank": told.global_rank(),
    }
    for bank in DESCRIPTIONS:
        low = bank.lower()
        owner = loading.owner_sql(BANK_NAMES[bank])
        sql[f"load_{low}"] = loading.load_sql(bank, owner, existing=told.STORED_IDS)
        if bank != "AMEX":
            sql[f"load_{low}_occurrence"] = loading.load_sql(bank, owner, existing=told.STORED_IDS, occurrence=True)
        sql[f"load_rejects_{low}"] = loading.rejects_sql(bank)
        sql[f"mine_{low}"] = mined.enrich_sql(bank)
        sql[f"preview_{low}"] = mined.preview_sql(bank)
        sql[f"new_categories_{low}"] = loading.categories_sql(bank)
        sql[f"new_sub_categories_{low}"] = loading.sub_categories_sql(bank)
    for bank in POSTED_VARIANTS:
        sql[f"load_{bank.lower()}_posted"] = loading.load_sql(
            bank, loading.owner_sql(BANK_NAMES[bank]), posted=True, existing=told.STORED_IDS
        )
    return sql | _optional("oracle_sql")
