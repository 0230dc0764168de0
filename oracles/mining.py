"""Checking SQL for the description miners."""

from __future__ import annotations

from ledgerloom.fixtures import BANK_NUMBER
from ledgerloom.operators import bank_rules as fixed
from ledgerloom.schemas import REPORTING
from oracles.sqltext import field, find_pattern, head, ladder, quote, strip_pattern, table, tail, without

D, E, S = "DESCRIPTION", "EXT_DESCRIPTION", "SUB_CATG_NAME"
_BARE = f"trim({D}, '/')"
_LAST = f"string_split({_BARE}, '/')[-1]"
_REF = f"string_split({D}, ' REF # ')[-1]"

PARTS = {
    "AXIS": {
        **{f"slash_{n}": field(D, "/", n) for n in (2, 3, 4)},
        "slash_last": _LAST,
        "slash_last_named": f"CASE WHEN upper({_LAST}) IN ({', '.join(map(quote, fixed.AXIS_FILLERS))}) "
                            f"THEN string_split({_BARE}, '/')[greatest(len(string_split({_BARE}, '/')) - 1, 1)] "
                            f"ELSE {_LAST} END",
    },
    "WELLSFARGO": {
        "zelle_from": head(tail(D, " FROM "), " ON "),
        "zelle_to": head(tail(D, " TO "), " ON "),
        "purchase_word": head(f"trim(substr({D}, {fixed.WELLSFARGO_PURCHASE_AT}))", " "),
        "two_words": head(D, " ", 2),
        "ref_word": head(_REF, " "),
        "memo": f"CASE WHEN strpos({_REF}, ' ') > 0 THEN substr({_REF}, strpos({_REF}, ' ') + 1) END",
        "city_state": head(tail(D, " ", 4), " ", 2),
        "third_last_word": head(tail(D, " ", 3), " "),
        "atm_place": tail(head(D, " ATM ID "), " ", 3),
    },
    "AMEX": {
        "merchant": f"trim({strip_pattern(without(D, fixed.AMEX_PREFIXES), fixed.AMEX_NOISE)})",
        "place": f"trim({head(tail(D, fixed.AMEX_GAP, 2), fixed.AMEX_GAP)}) || ' ' || trim({tail(D, fixed.AMEX_GAP)})",
        "item": head(tail(E, "DESCRIPTION : "), " PRICE"),
        "passenger": head(tail(E, "PASSENGER NAME : "), " TICKET"),
    },
    "DISCOVER": {
        "merchant": strip_pattern(strip_pattern(D, fixed.DISCOVER_AMAZON, "AMAZON"), fixed.DISCOVER_NOISE),
        "place": find_pattern(D, fixed.DISCOVER_PLACE),
        "ext_upper": f"upper(trim({E}))",
        "long_number": find_pattern(D, fixed.LONG_NUMBER),
    },
    "CAPITALONE": {
        "merchant": strip_pattern(without(D, fixed.CAPITALONE_PREFIXES), fixed.CAPITALONE_NOISE),
        "sub_upper": f"upper(trim({S}))",
        "long_number": find_pattern(D, fixed.LONG_NUMBER),
    },
    "APPLE": {
        "merchant": strip_pattern(without(D, fixed.APPLE_PREFIXES), fixed.APPLE_NOISE),
        "place": strip_pattern(find_pattern(D, fixed.APPLE_PLACE), fixed.APPLE_PLACE_NOISE),
        "sub_upper": f"upper(trim({S}))",
        "plan": find_pattern(D, fixed.APPLE_PLAN),
    },
    "CITI": {
        "merchant": strip_pattern(without(D, fixed.CITI_PREFIXES), fixed.CITI_NOISE),
        "place": find_pattern(D, fixed.CITI_PLACE),
    },
}

_TRIM = {"ENTITY_NAME", "GEOGRAPHY", "DETAILED_CATEGORY", "ASSOCIATED_BANK"}


def _mined(ladders, parts, trimmed):
    return {n: f"trim({ladder(r, parts)})" if n in trimmed else ladder(r, parts) for n, r in ladders.items()}


def enrich_sql(bank: str) -> str:
    mined = _mined(fixed.BANKS[bank].fields, PARTS[bank], _TRIM)
    columns = []
    for name in REPORTING.columns:
        if name == "LAST_REFRESHED":
            value = "CAST('2025-01-01 00:00:00' AS TIMESTAMP)"
        elif name in mined:
            value = mined[name]
        elif name == "TRANSACTION_TYPE" or name in ("CATG_NAME", S) or not _is_text(name):
            value = {"CATG_NAME": "c.CATG_NAME", S: "s.SUB_CATG_NAME"}.get(name, "t." + name)
        else:
            value = "CAST(NULL AS VARCHAR)"
        columns.append(f"{value} AS {name}")
    return (
        f"SELECT {', '.join(columns)} FROM {table('TRANSACTIONS')} t "
        f"LEFT JOIN {table('MCC_CATEGORY')} c ON t.CATG_ID = c.CATG_ID "
        f"LEFT JOIN {table('MCC_SUB_CATEGORY')} s ON t.SUB_CATG_ID = s.SUB_CATG_ID AND t.CATG_ID = s.CATG_ID "
        f"WHERE t.BANK_ID = {BANK_NUMBER[bank]}"
    )


def _is_text(name: str) -> bool:
    return name in REPORTING.lengths


def reporting_sql(skip: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(enrich_sql(b) for b in fixed.BANKS if b not in skip)


_RAW = {D: "RAW_DESC", E: "RAW_EXT_DESC", S: "RAW_SUB_CATG"}


def preview_sql(bank: str) -> str:
    rules = fixed.BANKS[bank]
    mined = _mined(rules.preview, PARTS[bank], _TRIM | {"TRANSACTION_MEMO", "TRACE_ID"})
    columns = [f"{c} AS {_RAW[c]}" for c in rules.preview_columns] + [f"{v} AS {n}" for n, v in mined.items()]
    return (
        f"SELECT TRANSACTION_ID, {', '.join(columns)} FROM {table('TRANSACTIONS')} t "
        f"LEFT JOIN (SELECT SUB_CATG_ID, SUB_CATG_NAME FROM {table('MCC_SUB_CATEGORY')}) s USING (SUB_CATG_ID) "
        f"WHERE BANK_ID = {BANK_NUMBER[bank]}"
    )


def channel_sql() -> str:
    parts = PARTS["AXIS"]
    return (
        f"SELECT {ladder(fixed.REPORT_CHANNEL, parts)} AS CHANNEL, trim({ladder(fixed.REPORT_MERCHANT, parts)}) AS MERCHANT, "
        f"CAST(sum(TRANSACTION_AMOUNT) AS DECIMAL(38,4)) AS TOTAL_AMOUNT FROM {table('TRANSACTIONS')} t "
        "WHERE TRANSACTION_TYPE = 'DBT' GROUP BY ALL"
    )
