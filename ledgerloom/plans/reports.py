"""Report queries over the fact, reporting and dimension tables.

Sums and counts are taken per id before names are joined, so the shuffle
carries one row per id and map task, and a hot id cannot overload a join task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.text import any_of, fold, name_holds
from ledgerloom.operators.mining import report_channel

MONEY = "decimal(38,4)"


def total(column: Column | str = "TRANSACTION_AMOUNT") -> Column:
    return F.sum(column).cast(MONEY)


def month(column: str = "TRANSACTION_DATE", pattern: str = "yyyy-MM") -> Column:
    return F.date_format(column, pattern)


def by_name(rows: DataFrame, names: list[str], *sums: Column, collation: str | None = None) -> DataFrame:
    """Group by names without regard to case, or under a collation; of several spellings the lowest is shown."""
    folded = [f"_K_{n}" for n in names]
    shown = [F.min(n).alias(n) for n in names]
    return rows.groupBy(*[fold(F.col(n), collation).alias(k) for n, k in zip(names, folded)]).agg(*shown, *sums).drop(*folded)


def transaction_log(transactions, members, banks, cards) -> DataFrame:
    """Readable statement, newest first.

    The id is the second sort key: the rows of one day are many, and with it they spread over the sorting tasks.
    """
    return (
        transactions.select(
            "TRANSACTION_ID", "TRANSACTION_DATE", "MEMBER_ID", "BANK_ID", "CARD_ID", "DESCRIPTION", "TRANSACTION_AMOUNT",
            "TRANSACTION_TYPE",
        )
        .join(members.select("MEMBER_ID", "FIRST_NAME", "LAST_NAME"), "MEMBER_ID")
        .join(banks.select("BANK_ID", "BANK_NAME"), "BANK_ID")
        .join(cards.select("CARD_ID", "LAST_4"), "CARD_ID")
        .orderBy(F.desc("TRANSACTION_DATE"), "TRANSACTION_ID")
        .select(
            "TRANSACTION_DATE", "FIRST_NAME", "LAST_NAME", "BANK_NAME", "LAST_4", "DESCRIPTION",
            "TRANSACTION_AMOUNT", "TRANSACTION_TYPE",
        )
    )


def spend_by_category(transactions, categories, sub_categories) -> DataFrame:
    """Money out per category and sub-category, highest first; the sub-category joins on its own id."""
    per_id = (
        transactions.where("TRANSACTION_TYPE = 'DBT'").groupBy("CATG_ID", "SUB_CATG_ID").agg(total().alias("SPENT"))
    )
    named = per_id.join(categories.select("CATG_ID", "CATG_NAME"), "CATG_ID").join(
        sub_categories.select("SUB_CATG_ID", "SUB_CATG_NAME"), "SUB_CATG_ID"
    )
    sums = by_name(named, ["CATG_NAME", "SUB_CATG_NAME"], total("SPENT").alias("TOTAL_SPENT"))
    return sums.orderBy(F.desc("TOTAL_SPENT"))


def active_members(members, addresses) -> DataFrame:
    """Current members with their current address."""
    current = members.where("IS_CURRENT = 1").select("FIRST_NAME", "LAST_NAME", "ADDRESS_ID")
    places = addresses.where("IS_CURRENT = 1").select("ADDRESS_ID", "ADDRESS_1", "CITY", "STATE", "ZIPCODE")
    return current.join(places, "ADDRESS_ID").drop("ADDRESS_ID")


def monthly_summary(transactions, income_code: str = "CDT", threshold: str = "0.8") -> DataFrame:
    """Income, spend, savings and budget state per month.

    ``income_code='CRD'`` gives the form in which no row counts as income, so
    every month with spend is OVERSPENT.
    """
    spent = F.when(F.col("TRANSACTION_TYPE") == "DBT", F.col("TRANSACTION_AMOUNT")).otherwise(0)
    earned = F.when(F.col("TRANSACTION_TYPE") == income_code, F.col("TRANSACTION_AMOUNT")).otherwise(0)
    sums = transactions.groupBy(month().alias("MONTH")).agg(
        total(earned).alias("TOTAL_INCOME"), total(spent).alias("TOTAL_SPEND")
    )
    over = F.col("TOTAL_SPEND") > F.col("TOTAL_INCOME") * F.lit(threshold).cast("decimal(2,1)")
    return sums.withColumn("NET_SAVINGS", (F.col("TOTAL_INCOME") - F.col("TOTAL_SPEND")).cast(MONEY)).withColumn(
        "BUDGET_STATUS", F.when(over, "OVERSPENT").otherwise("WITHIN BUDGET")
    )


def monthly_sums(transactions) -> DataFrame:
    """Amount and number of rows per month and type, from which the summary of any income code can be told."""
    start = F.date_trunc("month", "TRANSACTION_DATE").cast("timestamp_ntz")
    return transactions.groupBy(start.alias("MONTH_START"), "TRANSACTION_TYPE").agg(total().alias("AMOUNT"), F.count(F.lit(1)).alias("CNT"))


def summary_of_sums(sums, **options) -> DataFrame:
    """The monthly summary from stored sums."""
    return monthly_summary(sums.withColumnsRenamed({"MONTH_START": "TRANSACTION_DATE", "AMOUNT": "TRANSACTION_AMOUNT"}), **options)


def monthly_summary_view(transactions, name: str = "VW_MONTHLY_SUMMARY", **options) -> DataFrame:
    view = monthly_summary(transactions, **options)
    view.createOrReplaceTempView(name)
    return view


def spend_by_channel(transactions) -> DataFrame:
    """Money out per parsed channel and merchant, highest first."""
    spent = transactions.where("TRANSACTION_TYPE = 'DBT'").select("DESCRIPTION", "TRANSACTION_AMOUNT")
    return (
        report_channel(spent)
        .groupBy("CHANNEL", "MERCHANT")
        .agg(total().alias("TOTAL_AMOUNT"))
        .orderBy(F.desc("TOTAL_AMOUNT"))
    )


def monthly_categories(transactions, categories, sub_categories, full_order: bool = True) -> DataFrame:
    """Count and amount per month, category and sub-category; unknown names stay as NULL."""
    sums = transactions.groupBy(
        month(pattern="yyyy-MM-01").alias("MONTH_START"), "CATG_ID", "SUB_CATG_ID"
    ).agg(F.count("*").alias("CNT"), total().alias("SPEND"))
    named = sums.join(categories.select("CATG_ID", "CATG_NAME"), "CATG_ID", "left").join(
        sub_categories.select("SUB_CATG_ID", "SUB_CATG_NAME"), "SUB_CATG_ID", "left"
    )
    order = ["MONTH_START", "CATG_ID", "CATG_NAME"] + (["SUB_CATG_ID", "SUB_CATG_NAME"] if full_order else [])
    return named.select(
        "MONTH_START", "CNT", "SPEND", "CATG_ID", "CATG_NAME", "SUB_CATG_ID", "SUB_CATG_NAME"
    ).orderBy(*order)


def transactions_per_card(transactions, cards, banks) -> DataFrame:
    """Transactions per card, with the bank that issued the card."""
    return (
        transactions.groupBy("CARD_ID")
        .agg(F.count("*").alias("CNT"))
        .join(cards.select("CARD_ID", "LAST_4", "BANK_ID"), "CARD_ID")
        .join(banks.select("BANK_ID", "BANK_NAME"), "BANK_ID")
        .select("CNT", "CARD_ID", "LAST_4", "BANK_NAME")
        .orderBy("CARD_ID", "LAST_4", "BANK_NAME")
    )


def reporting_per_card(reporting, banks) -> DataFrame:
    """Reporting rows per card and bank of the row; banks of one name count together."""
    counts = reporting.groupBy("CARD_ID", "BANK_ID").agg(F.count("*").alias("N"))
    named = counts.join(banks.select("BANK_ID", "BANK_NAME"), "BANK_ID")
    sums = named.groupBy("CARD_ID", fold(F.col("BANK_NAME")).alias("_K")).agg(
        F.min("BANK_NAME").alias("BANK_NAME"), F.sum("N").alias("CNT")
    )
    return sums.select("CNT", "CARD_ID", "BANK_NAME").orderBy("CARD_ID", "BANK_NAME")


def reconciliation(transactions, reporting) -> DataFrame:
    """Row counts of both tables and the number of facts that have no reporting row."""
    facts, rows = transactions.select("TRANSACTION_ID"), reporting.select("TRANSACTION_ID")
    sides = facts.select("TRANSACTION_ID", F.lit(1).alias("FACT"), F.lit(0).alias("REPORT")).unionByName(
        rows.select("TRANSACTION_ID", F.lit(0).alias("FACT"), F.lit(1).alias("REPORT"))
    )
    per_id = sides.groupBy("TRANSACTION_ID").agg(F.sum("FACT").alias("FACT"), F.sum("REPORT").alias("REPORT"))
    missing = F.when(F.col("REPORT") == 0, F.col("FACT")).otherwise(0)
    return per_id.agg(
        F.coalesce(F.sum("REPORT"), F.lit(0)).alias("REPORTING_ROWS"),
        F.coalesce(F.sum("FACT"), F.lit(0)).alias("TRANSACTION_ROWS"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("MISSING_ROWS"),
    )


def distinct_values(table: DataFrame, *columns: str, collation: str | None = None) -> DataFrame:
    """Distinct values, texts without regard to case, or under a collation; of several spellings the lowest is shown."""
    kinds = dict(table.dtypes)
    keys = {f"_K_{c}": fold(F.col(c), collation) if kinds[c] == "string" else F.col(c) for c in columns}
    shown = [F.min(c).alias(c) for c in columns]
    return table.groupBy(*[v.alias(k) for k, v in keys.items()]).agg(*shown).select(*columns)


def recent_transactions(transactions) -> DataFrame:
    """Whole fact table, last added first; the id parts the rows of one load, which share their time."""
    return transactions.orderBy(F.desc("ADDED_DATETIME"), "TRANSACTION_ID")


def _contains(column: str, word: str) -> Column:
    return name_holds(F.col(column), word)


def keyword_spend(reporting, words: dict[str, list[str]], as_of: date, months_back: int = 1) -> DataFrame:
    """Money out since ``months_back`` months before ``as_of`` where a column holds one of its words."""
    hit = any_of(_contains(column, w) for column, listed in words.items() for w in listed)
    since = F.add_months(F.lit(as_of), -months_back)
    rows = reporting.where((F.col("TRANSACTION_TYPE") == "DBT") & hit & (F.col("TRANSACTION_DATE") >= since))
    return rows.agg(total().alias("TOTAL_SPENT"))


# The words of the food question.
FOOD_WORDS = {"CATG_NAME": ["food"], "SUB_CATG_NAME": ["restaurant", "dining"]}


def counterparty_spend(reporting, name: str) -> DataFrame:
    """Money sent to a counterparty."""
    rows = reporting.where((F.col("TRANSACTION_TYPE") == "DBT") & _contains("ENTITY_NAME", name))
    return rows.agg(total().alias("TOTAL_SPENT"))


def month_spend_by_bank(reporting, banks, first_day: date) -> DataFrame:
    """Money out per bank in the month that begins on ``first_day``."""
    start = F.lit(first_day)
    in_month = (F.col("TRANSACTION_DATE") >= start) & (F.col("TRANSACTION_DATE") < F.add_months(start, 1))
    sums = reporting.where((F.col("TRANSACTION_TYPE") == "DBT") & in_month).groupBy("BANK_ID").agg(total().alias("SPENT"))
    named = sums.join(banks.select("BANK_ID", "BANK_NAME"), "BANK_ID")
    return by_name(named, ["BANK_NAME"], total("SPENT").alias("TOTAL_SPENT")).orderBy("BANK_NAME")
