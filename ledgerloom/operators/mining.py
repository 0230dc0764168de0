"""Description mining: free bank text to channel, entity, place, memo and reference.

Each bank is a set of rule tables (``bank_rules``) plus the named text parts
below.  All of it is one projection over the fact table, so the bank filter and
the column list reach the parquet scan and no row is shuffled for the parsing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.rules import Ladder, conditions_of, first_match
from ledgerloom.functions.text import (
    after_last, any_of, before, between, clean_upper, drop_all, from_position, moment, nth_field, regex_drop,
    regex_first, tail_field,
)
from ledgerloom.operators import bank_rules as fixed
from ledgerloom.operators.bank_rules import BANKS, BankRules
from ledgerloom.schemas import REPORTING

_TRIMMED = {"ENTITY_NAME", "GEOGRAPHY", "DETAILED_CATEGORY", "ASSOCIATED_BANK"}
_TRIMMED_IN_PREVIEW = _TRIMMED | {"TRANSACTION_MEMO", "TRACE_ID"}


def _slash_parts(d: Column) -> dict[str, Column]:
    return {f"slash_{n}": nth_field(d, "/", n) for n in (2, 3, 4)}


def _axis(d: Column) -> dict[str, Column]:
    stripped = F.btrim(d, F.lit("/"))
    last = after_last(stripped, "/")
    filler = F.upper(last).isin(fixed.AXIS_FILLERS)
    return {
        **_slash_parts(d),
        "slash_last": last,
        "slash_last_named": F.when(filler, tail_field(stripped, "/", 2)).otherwise(last),
    }


def _wellsfargo(d: Column) -> dict[str, Column]:
    reference = after_last(d, " REF # ")
    space = F.locate(" ", reference)
    return {
        "zelle_from": between(d, " FROM ", " ON "),
        "zelle_to": between(d, " TO ", " ON "),
        "purchase_word": before(F.trim(F.substring(d, fixed.WELLSFARGO_PURCHASE_AT, 2**31 - 1)), " "),
        "two_words": before(d, " ", 2),
        "ref_word": before(reference, " "),
        "memo": F.when(space > 0, from_position(reference, space + 1)),
        "city_state": tail_field(d, " ", 4, 2),
        "third_last_word": tail_field(d, " ", 3),
        "atm_place": F.substring_index(before(d, " ATM ID "), " ", -3),
    }


def _amex(d: Column) -> dict[str, Column]:
    extended = F.col("EXT_DESCRIPTION")
    return {
        "merchant": F.trim(regex_drop(drop_all(d, fixed.AMEX_PREFIXES), fixed.AMEX_NOISE)),
        "place": F.concat(
            F.trim(tail_field(d, fixed.AMEX_GAP, 2)), F.lit(" "), F.trim(after_last(d, fixed.AMEX_GAP))
        ),
        "item": between(extended, "DESCRIPTION : ", " PRICE"),
        "passenger": between(extended, "PASSENGER NAME : ", " TICKET"),
    }


def _discover(d: Column) -> dict[str, Column]:
    return {
        "merchant": regex_drop(regex_drop(d, fixed.DISCOVER_AMAZON, "AMAZON"), fixed.DISCOVER_NOISE),
        "place": F.col("_PLACE"),
        "ext_upper": clean_upper(F.col("EXT_DESCRIPTION")),
        "long_number": regex_first(d, fixed.LONG_NUMBER),
    }


def _capitalone(d: Column) -> dict[str, Column]:
    return {
        "merchant": regex_drop(drop_all(d, fixed.CAPITALONE_PREFIXES), fixed.CAPITALONE_NOISE),
        "sub_upper": clean_upper(F.col("SUB_CATG_NAME")),
        "long_number": regex_first(d, fixed.LONG_NUMBER),
    }


def _apple(d: Column) -> dict[str, Column]:
    return {
        "merchant": regex_drop(drop_all(d, fixed.APPLE_PREFIXES), fixed.APPLE_NOISE),
        "place": regex_drop(F.col("_PLACE"), fixed.APPLE_PLACE_NOISE),
        "sub_upper": clean_upper(F.col("SUB_CATG_NAME")),
        "plan": regex_first(d, fixed.APPLE_PLAN),
    }


def _citi(d: Column) -> dict[str, Column]:
    return {
        "merchant": regex_drop(drop_all(d, fixed.CITI_PREFIXES), fixed.CITI_NOISE),
        "place": F.col("_PLACE"),
    }


# The place is both tested for and cut out, so its search runs once, as a column of its own.
_PLACES = {"DISCOVER": fixed.DISCOVER_PLACE, "APPLE": fixed.APPLE_PLACE, "CITI": fixed.CITI_PLACE}

_PARTS = {
    "AXIS": _axis, "WELLSFARGO": _wellsfargo, "AMEX": _amex, "DISCOVER": _discover,
    "CAPITALONE": _capitalone, "APPLE": _apple, "CITI": _citi,
}


def _ladder_inputs(ladders: dict[str, Ladder]) -> list[str]:
    """Columns whose upper-cased text the rules look at."""
    wanted = {"DESCRIPTION"}
    for ladder in ladders.values():
        for rule in ladder.rules:
            wanted |= {m.column for m in conditions_of(rule)}
    return sorted(wanted)


def mine(
    df: DataFrame, ladders: dict[str, Ladder], parts: dict[str, Column], trimmed: set[str], place: str | None = None
) -> DataFrame:
    """Add one column per ladder.  Folded texts and the place are columns first, so each is made once per row."""
    made = [F.upper(F.col(c)).alias("_FOLDED_" + c) for c in _ladder_inputs(ladders)]
    found = {}
    if place is not None:
        made.append(regex_first(F.col("DESCRIPTION"), place).alias("_PLACE"))
        found[place] = F.col("_PLACE")
    prepared = df.select("*", *made)
    values = []
    for name, ladder in ladders.items():
        value = first_match(ladder, parts, found)
        values.append((F.trim(value) if name in trimmed else value).alias(name))
    return prepared.select(*[F.col(c) for c in df.columns], *values)


def bank_id_of(banks: DataFrame, rules: BankRules, names: tuple[str, ...] | None = None) -> int:
    """Lowest id of a bank found by name pattern; raises where there is none.

    The lookup of one bank ignores whether the version is current, as the data
    was always refreshed that way.
    """
    found = banks.where(any_of(F.col("BANK_NAME").ilike(p) for p in names or rules.names))
    if rules.current_only:
        found = found.where("IS_CURRENT = 1")
    row = found.agg(F.min("BANK_ID")).first()
    if row[0] is None:
        raise ValueError(f"{rules.bank}: no bank found by name")
    return row[0]


def with_names(facts: DataFrame, categories: DataFrame, sub_categories: DataFrame) -> DataFrame:
    """Left-join the category names; the sub-category must belong to the row's category."""
    return facts.join(categories.select("CATG_ID", "CATG_NAME"), "CATG_ID", "left").join(
        sub_categories.select("SUB_CATG_ID", "CATG_ID", "SUB_CATG_NAME"), ["SUB_CATG_ID", "CATG_ID"], "left"
    )


def enrich(
    bank: str, transactions: DataFrame, categories: DataFrame, sub_categories: DataFrame,
    bank_id: int, as_of: datetime,
) -> DataFrame:
    """Reporting rows of one bank."""
    rules = BANKS[bank]
    facts = transactions.where(F.col("BANK_ID") == bank_id)
    named = with_names(facts, categories, sub_categories)
    mined = mine(named, rules.fields, _PARTS[bank](F.col("DESCRIPTION")), _TRIMMED, _PLACES.get(bank))
    return mined.select(
        *[_reporting_column(f.name, f.dataType, mined.columns, as_of) for f in REPORTING.schema]
    )


def _reporting_column(name, kind, available, as_of):
    if name == "LAST_REFRESHED":
        return moment(as_of).alias(name)
    if name in available:
        return F.col(name)
    return F.lit(None).cast(kind).alias(name)


def preview(bank: str, transactions: DataFrame, sub_categories: DataFrame, bank_id: int) -> DataFrame:
    """The exploratory form of the parse: raw text next to what the rules make of it."""
    rules = BANKS[bank]
    rows = transactions.where(F.col("BANK_ID") == bank_id)
    if "SUB_CATG_NAME" in rules.preview_columns:
        names = sub_categories.select("SUB_CATG_ID", "SUB_CATG_NAME")
        rows = rows.join(names, "SUB_CATG_ID", "left")
    rows = rows.select("TRANSACTION_ID", *rules.preview_columns)
    parts = _PARTS[bank](F.col("DESCRIPTION"))
    mined = mine(rows, rules.preview, parts, _TRIMMED_IN_PREVIEW, _PLACES.get(bank))
    raw = {"DESCRIPTION": "RAW_DESC", "EXT_DESCRIPTION": "RAW_EXT_DESC", "SUB_CATG_NAME": "RAW_SUB_CATG"}
    return mined.withColumnsRenamed({c: raw[c] for c in rules.preview_columns})


def report_channel(df: DataFrame) -> DataFrame:
    """CHANNEL and MERCHANT of the spend report."""
    ladders = {"CHANNEL": fixed.REPORT_CHANNEL, "MERCHANT": fixed.REPORT_MERCHANT}
    return mine(df, ladders, _slash_parts(F.col("DESCRIPTION")), {"MERCHANT"})
