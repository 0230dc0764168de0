"""Earlier forms of the load that are still used to look at a statement before loading it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.ids import assign_identity, highest, lookups
from ledgerloom.functions.text import byte_length, date_text, fold, from_position, moment, not_blank, number, same_name
from ledgerloom.operators.loaders import CREDIT, DEBIT, US_DATE
from ledgerloom.schemas import CATEGORY, SUB_CATEGORY

# Fixed value: the category of money paid back to the bank.
CREDIT_TO_BANK = "CREDIT TO BANK"


def _split(side: int) -> Column:
    return F.trim(F.substring_index("CATEGORY", "-", side))


def category_split(landing: DataFrame) -> DataFrame:
    """Category text and the parts before its first and after its last dash."""
    return landing.select("CATEGORY", _split(1).alias("CATG"), _split(-1).alias("SUB_CATG"))


def _seed_rows(landing: DataFrame) -> DataFrame:
    return landing.where(not_blank(F.col("CATEGORY"))).select(_split(1).alias("CATG"), _split(-1).alias("SUB"))


def _stamped(df: DataFrame, as_of: datetime, user: str) -> DataFrame:
    return df.withColumns({"ADDED_USER": F.lit(user), "ADDED_DATETIME": moment(as_of)})


def seed_categories(landing: DataFrame, categories: DataFrame, as_of: datetime, user: str = "LOADER") -> DataFrame:
    """New category rows from a statement, in their own case; names already stored are added again."""
    names = _seed_rows(landing).groupBy(fold(F.col("CATG"))).agg(F.min("CATG").alias("CATG_NAME")).select("CATG_NAME")
    last = lookups(last=highest(categories, "CATG_ID"))["last"]
    numbered = assign_identity(names, [F.col("CATG_NAME")], {"CATG_ID": last}, "seed-categories")
    return _stamped(numbered, as_of, user).select(*CATEGORY.columns)


def seed_sub_categories(
    landing: DataFrame, categories: DataFrame, sub_categories: DataFrame, as_of: datetime, user: str = "LOADER"
) -> DataFrame:
    """New sub-category rows under every category of the same name."""
    pairs = _seed_rows(landing).groupBy(fold(F.col("CATG")).alias("CATG_KEY"), fold(F.col("SUB")).alias("SUB_KEY")).agg(
        F.min("SUB").alias("SUB_CATG_NAME")
    )
    parents = categories.select(fold(F.col("CATG_NAME")).alias("CATG_KEY"), "CATG_ID")
    rows = pairs.join(parents, "CATG_KEY").select("SUB_CATG_NAME", "CATG_ID")
    last = lookups(last=highest(sub_categories, "SUB_CATG_ID"))["last"]
    order = [F.col("CATG_ID"), F.col("SUB_CATG_NAME")]
    numbered = assign_identity(rows, order, {"SUB_CATG_ID": last}, "seed-sub-categories")
    return _stamped(numbered, as_of, user).select(*SUB_CATEGORY.columns)


def legacy_statement_projection(
    landing: DataFrame, categories: DataFrame, sub_categories: DataFrame, members: DataFrame, banks: DataFrame,
    cards: DataFrame, user_name: str, bank_name: str, card_last4: str, as_of: datetime, added_user: str = "LOADER",
) -> DataFrame:
    """The first load as a plain projection: text as it is, amount with its sign, sign tested on whole units.

    Owner ids come from name lookups that ignore whether a version is current;
    a missing one gives NULL, and of several the lowest id is taken instead of
    one copy of the statement for each.  A sub-category is found by its name
    alone, so one name under several categories gives a row for each.
    """
    def lowest(df, key, column, value):
        return df.where(same_name(F.col(column), value)).agg(F.min(key))

    ids = lookups(
        MEMBER_ID=lowest(members, "MEMBER_ID", "FIRST_NAME", user_name),
        BANK_ID=lowest(banks, "BANK_ID", "BANK_NAME", bank_name),
        CARD_ID=lowest(cards, "CARD_ID", "LAST_4", card_last4),
    )
    spent = number(F.col("AMOUNT"), 30, 0) >= 0
    place, size = F.col("CITY_STATE"), byte_length(F.col("CITY_STATE"))
    details, statement = (F.coalesce(F.col(n), F.lit("")) for n in ("EXT_DETAILS", "STATEMENT_DESC"))
    rows = landing.select(
        number(F.substring(F.col("REFERENCE"), 2, 2**31 - 1), 30, 0).alias("TRANSACTION_ID"),
        date_text(F.col("TRANSACTION_DATE"), US_DATE).alias("DT"),
        F.when(spent, DEBIT).otherwise(CREDIT).alias("TRANSACTION_TYPE"),
        number(F.col("AMOUNT"), 19, 4).alias("AMOUNT"),
        "DESCRIPTION",
        F.concat_ws(" ", details, F.lit("statement:"), statement).alias("EXT_DESCRIPTION"),
        "ADDRESS",
        F.trim(F.substring(place, F.lit(1), size - 3)).alias("CITY"),
        F.trim(from_position(place, size - 1)).alias("STATE"),
        "COUNTRY", "ZIPCODE",
        fold(F.when(spent, _split(1)).otherwise(CREDIT_TO_BANK)).alias("CATG_KEY"),
        fold(F.when(spent, _split(-1)).otherwise(CREDIT_TO_BANK)).alias("SUB_KEY"),
    )
    named = rows.join(
        categories.select(fold(F.col("CATG_NAME")).alias("CATG_KEY"), "CATG_ID"), "CATG_KEY", "left"
    ).join(
        sub_categories.select(fold(F.col("SUB_CATG_NAME")).alias("SUB_KEY"), "SUB_CATG_ID"), "SUB_KEY", "left"
    ).drop("CATG_KEY", "SUB_KEY")
    return _stamped(named.withColumns({n: F.lit(v).cast("int") for n, v in ids.items()}), as_of, added_user)
