"""Golden rows: one description per rule branch, with the parse read off the rule by hand."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from ledgerloom.operators.mining import bank_id_of, enrich, preview, report_channel
from ledgerloom.operators.bank_rules import BANKS
from ledgerloom.schemas import CATEGORY, SUB_CATEGORY, TRANSACTIONS

NOW = datetime(2025, 1, 1)


def facts(spark, rows):
    """(description, ext description, sub-category id) rows of bank 1."""
    made = []
    for i, row in enumerate(rows, start=1):
        description, extended, sub = (list(row) + [None, 0])[:3] if isinstance(row, tuple) else (row, None, 0)
        made.append(
            (i, NOW, None, "DBT", Decimal("1.0000"), description, extended, None, None, None, None, None, None,
             1, sub or 1, 1, 1, 1, "T", NOW)
        )
    return spark.createDataFrame(made, TRANSACTIONS.schema)


def dims(spark):
    categories = spark.createDataFrame([(1, "Travel", "T", NOW)], CATEGORY.schema)
    subs = spark.createDataFrame(
        [(1, " other ", 1, "T", NOW), (2, "Airfare", 1, "T", NOW), (3, "GAS/AUTOMOTIVE", 1, "T", NOW),
         (4, "elsewhere", 2, "T", NOW)],
        SUB_CATEGORY.schema,
    )
    return categories, subs


def mined(spark, bank, rows, *columns):
    out = enrich(bank, facts(spark, rows), *dims(spark), 1, NOW).orderBy("TRANSACTION_ID").collect()
    return [tuple(r[c] for c in columns) for r in out]


def previewed(spark, bank, rows, *columns):
    out = preview(bank, facts(spark, rows), dims(spark)[1], 1).orderBy("TRANSACTION_ID").collect()
    return [tuple(r[c] for c in columns) for r in out]


def test_axis(spark):
    rows = {
        "POS/SHOP/PUNE/X": ("DEBIT CARD", "SHOP", "PUNE", None),
        "ECOM PUR/SHOP/PUNE": ("ONLINE PURCHASE", "SHOP", "PUNE", None),
        "UPI/P2M/1/ ANN /PAYMENT/": ("UPI", "ANN", "ONLINE/TRANSFER", "PAYMENT"),
        "IMPS/P2A/1/ANN/SOME BANK": ("IMPS", "ANN", "ONLINE/TRANSFER", "SOME BANK"),
        "ATM-CASH/1/PUNE": ("CASH WITHDRAWAL", "SELF", "PUNE", None),
        "MOB/TPFT/ANN/1": ("MOBILE BANKING", "ANN", "ONLINE/TRANSFER", None),
        "ECS/1/LOAN": ("AUTOPAY/ECS", "LOAN", "ONLINE/TRANSFER", None),
        "NBSM/1/SHOP": ("NET BANKING", "SHOP", "ONLINE/TRANSFER", None),
        "PUR-REV/1/SHOP": ("REVERSAL", "REVERSAL", "ONLINE/TRANSFER", None),
        "INT ON SB 1": ("BANK INTEREST/TAX", "BANK SYSTEM", "ONLINE/TRANSFER", None),
        "SB:1": ("BANK INTEREST/TAX", "BANK SYSTEM", "ONLINE/TRANSFER", None),
        "X INT.PD:1": ("BANK INTEREST/TAX", "BANK SYSTEM", "ONLINE/TRANSFER", None),
        "SOMETHING": ("OTHERS", "UNKNOWN", "ONLINE/TRANSFER", None),
        "UPI": ("OTHERS", "UNKNOWN", "ONLINE/TRANSFER", None),
        "upi/a/b": ("UPI", "b", "ONLINE/TRANSFER", "b"),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY", "ASSOCIATED_BANK")
    assert mined(spark, "AXIS", list(rows), *columns) == list(rows.values())


def test_axis_preview_falls_back_one_field(spark):
    rows = {
        "UPI/P2M/1/ANN/PAYMENT/": ("UPI", "ANN"),
        "UPI/P2M/1/ANN/AXIS": ("UPI", "AXIS"),
        "ZELLE FROM X": ("ZELLE", None),
        "X PAYROLL": ("PAYROLL", None),
        "AUTO DRAFT": ("TRANSFER", None),
        "A PREM B": ("BILL PAY/ACH", None),
        "PURCHASE AUTHORIZED ON 1": ("DEBIT CARD", None),
        "ATM CASH 1": ("CASH WITHDRAWAL", None),
    }
    assert previewed(spark, "AXIS", list(rows), "PAYMENT_CHANNEL", "ASSOCIATED_BANK") == list(rows.values())


def test_wellsfargo(spark):
    rows = {
        "PURCHASE AUTHORIZED ON 01/02 SHOP MCKINNEY TX S1 CARD 1":
            ("DEBIT CARD", "/02", "MCKINNEY TX", None, "PURCHASE", None),
        "ZELLE FROM ANN LEE ON 01/02 REF # AB1 RENT FOR MAY": ("ZELLE", "ANN LEE", "ONLINE", "RENT FOR MAY", "AB1", None),
        "ZELLE TO BOB ON 01/02 REF # JPM1": ("ZELLE", "BOB", "ONLINE", None, "JPM1", "CHASE"),
        "ATM CASH WDL": ("CASH", "ATM CASH", "ONLINE", None, "ATM", None),
        "ONLINE TRANSFER REF # 9 BAC": ("ACH/TRANSFER", "ONLINE TRANSFER", "ONLINE", None, "9", "BOFA"),
        "FEE": ("ACH/TRANSFER", "FEE", "ONLINE", None, "FEE", None),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY", "TRANSACTION_MEMO", "TRACE_ID", "ASSOCIATED_BANK")
    assert mined(spark, "WELLSFARGO", list(rows), *columns) == list(rows.values())


def test_wellsfargo_preview(spark):
    rows = {
        "PURCHASE AUTHORIZED ON 01/02 SHOP DALLAS TX S1 CARD": ("DEBIT CARD", "DALLAS TX", "TX", None),
        "ATM CASH 12 MAIN ST ATM ID 7": ("CASH WITHDRAWAL", "12 MAIN ST", None, None),
        "CITI CARD ONLINE PAYMENT": ("BILL PAY/ACH", "ONLINE/TRANSFER", None, "CITI"),
        "IRS USATAXPYMT 1": ("TAX PAYMENT", "ONLINE/TRANSFER", None, None),
        "MO DEPT REVENUE MOSTTAXRFD": ("INCOME/REFUND", "ONLINE/TRANSFER", None, None),
        "SCHWAB MONEYLINK": ("TRANSFER", "ONLINE/TRANSFER", None, None),
        "X REF # 55 Y": ("OTHERS", "ONLINE/TRANSFER", "55", None),
    }
    columns = ("PAYMENT_CHANNEL", "GEOGRAPHY", "TRACE_ID", "ASSOCIATED_BANK")
    assert previewed(spark, "WELLSFARGO", list(rows), *columns) == list(rows.values())


def test_wellsfargo_preview_names_every_counterparty(spark):
    """One row for each arm of the name rules, read off the rules of the earlier system."""
    rows = {
        "ZELLE FROM ANN LEE ON 01/02 REF # AB1": "ANN LEE", "ZELLE TO BOB ON 01/02 REF # JPM1": "BOB",
        "PURCHASE AUTHORIZED ON 01/02 SHOP DALLAS TX S1 CARD": "/02", "ATM CASH 12 MAIN ST ATM ID 7": "SELF",
        "AMERENMO WEB PMT 1": "AMERENMO", "CITI CARD ONLINE PAYMENT": "CITI", "CAPITAL ONE MOBILE PMT": "CAPITAL ONE",
        "AMERICAN EXPRESS ACH PMT": "AMERICAN EXPRESS", "APPLECARD GSBANK PAYMENT": "APPLE", "DISCOVER E-PAYMENT": "DISCOVER",
        "LIBERTY MUTUAL PREM": "LIBERTY MUTUAL", "PROG COUNTY MUT INS PREM": "PROGRESSIVE", "IRS USATAXPYMT": "IRS",
        "MO DEPT REVENUE MOSTTAXRFD": "MO DEPT REVENUE", "RELIABLE SOFTWAR PAYROLL": "RELIABLE SOFTWARE",
        "SCHWAB BROKERAGE MONEYLINK": "SCHWAB", "WELLS FARGO AUTO DRAFT": "WELLS FARGO", "PF MCKINNEY CLUB FEES": "PLANET FITNESS",
        "SOMETHING ELSE": "UNKNOWN",
    }
    assert previewed(spark, "WELLSFARGO", list(rows), "ENTITY_NAME") == [(n,) for n in rows.values()]
    assert len(rows) == len(BANKS["WELLSFARGO"].preview["ENTITY_NAME"].rules) + 1


def test_axis_preview_transfers(spark):
    rows = {"ZELLE FROM X": "ZELLE", "SCHWAB MONEYLINK": "TRANSFER", "CAR AUTO DRAFT": "TRANSFER", "ATM CASH 1": "CASH WITHDRAWAL"}
    assert previewed(spark, "AXIS", list(rows), "PAYMENT_CHANNEL") == [(c,) for c in rows.values()]


def test_amex(spark):
    rows = {
        ("MOBILE PAYMENT - THANK YOU", None): ("PAYMENT", "AMERICAN EXPRESS", "ONLINE", "RETAIL"),
        ("APLPAY CAFE  AUSTIN  TX", "FAST FOOD RESTAURANT"): ("APPLE PAY", "CAFE", "AUSTIN TX", "DINING"),
        ("TST* CAFE 12345  AUSTIN  TX", "GROCERY STORE"): ("CREDIT CARD", "CAFE", "AUSTIN TX", "GROCERIES"),
        ("SHOP.COM  SEATTLE  WA", None): ("ONLINE PURCHASE", "SHOP.COM", "SEATTLE WA", "RETAIL"),
        ("SHOP", "WWW.SHOP.COM DISCOUNT STORE"): ("ONLINE PURCHASE", "SHOP", "SHOP SHOP", "SHOPPING"),
        ("HOTEL", "LODGING"): ("CREDIT CARD", "HOTEL", "HOTEL HOTEL", "TRAVEL"),
        ("AIR", "PASSENGER TICKET"): ("CREDIT CARD", "AIR", "AIR AIR", "AIRLINE"),
        ("SHOP", "X DESCRIPTION : TWO MUGS PRICE : 1"): ("CREDIT CARD", "SHOP", "SHOP SHOP", "TWO MUGS"),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY", "DETAILED_CATEGORY")
    assert mined(spark, "AMEX", list(rows), *columns) == list(rows.values())
    assert previewed(spark, "AMEX", [("AIR", "PASSENGER NAME : ANN TICKET 1"), ("AIR", None)], "FLIGHT_PASSENGER") == [
        ("ANN",), (None,)
    ]


def test_discover(spark):
    rows = {
        ("INTERNET PAYMENT - THANK YOU", None): ("PAYMENT", "INTERNET PAYMENT - THANK YOU", "ONLINE", None, None),
        ("X", "PAYMENTS AND CREDITS"): ("PAYMENT", "X", "UNKNOWN", "PAYMENTS AND CREDITS", None),
        ("AMAZON MKTPL*1A2 SEATTLE WA", " books "): ("ONLINE PURCHASE", "AMAZON", "SEATTLE WA", "BOOKS", None),
        ("SHELL OIL 123456 HOUSTON TX", "GASOLINE"): ("GAS STATION", "SHELL OIL", "HOUSTON TX", "GASOLINE", None),
        ("SHOP 1234567890", None): ("CREDIT CARD", "SHOP", "UNKNOWN", None, "1234567890"),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY", "DETAILED_CATEGORY", "TRACE_ID")
    assert mined(spark, "DISCOVER", list(rows), *columns) == list(rows.values())


def test_capitalone(spark):
    rows = {
        ("CAPITAL ONE MOBILE PYMT", None): ("PAYMENT", "CAPITAL ONE MOBILE PYMT", "OTHER", None),
        ("SOUTHWES 5261234567890", None, 2): ("AIRLINE", "SOUTHWEST AIRLINES", "AIRFARE", "5261234567890"),
        ("AMERICAN 1", None): ("CREDIT CARD", "AMERICAN AIRLINES", "OTHER", None),
        ("QATAR AIRW", None): ("AIRLINE", "QATAR AIRWAYS", "OTHER", None),
        ("NTTA AUTOCHARGE", None): ("TRANSPORT/GAS", "NTTA AUTOCHARGE", "OTHER", None),
        ("FUEL", None, 3): ("TRANSPORT/GAS", "FUEL", "GAS/AUTOMOTIVE", None),
        ("COT*HTL", None): ("TRAVEL PORTAL", "CAPITAL ONE TRAVEL - HOTEL", "OTHER", None),
        ("COT*FLT", None): ("TRAVEL PORTAL", "CAPITAL ONE TRAVEL - FLIGHT", "OTHER", None),
        ("TST* CAFE  AUSTIN", None): ("CREDIT CARD", "CAFE", "OTHER", None),
        ("ETIHAD 1", None): ("CREDIT CARD", "ETIHAD AIRWAYS", "OTHER", None),
        ("UNITED 1", None): ("CREDIT CARD", "UNITED AIRLINES", "OTHER", None),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "DETAILED_CATEGORY", "TRACE_ID")
    assert mined(spark, "CAPITALONE", list(rows), *columns) == list(rows.values())


def test_apple(spark):
    rows = {
        "ACH DEPOSIT INTERNET TRANSFER": ("PAYMENT", "ACH DEPOSIT INTERNET TRANSFER", "ONLINE", None),
        "MONTHLY INSTALLMENTS (2 OF 12)": ("INSTALLMENT", "MONTHLY INSTALLMENTS", "ONLINE", "2 OF 12"),
        "DAILY CASH ADJUSTMENT": ("REWARDS", "DAILY CASH ADJUSTMENT", "ONLINE", None),
        "SHOP (RETURN)": ("RETURN", "SHOP", "ONLINE", None),
        "APPLE.COM/BILL ONE APPLE PARK WAY": ("DIGITAL SERVICES", "APPLE.COM/BILL", "CUPERTINO CA", None),
        "SHOP 100 MAIN STREET DALLAS 75001 TX USA": ("CREDIT CARD", "SHOP", "MAIN STREET DALLAS TX", None),
        "TST* CAFE #12": ("CREDIT CARD", "CAFE", "ONLINE", None),
    }
    columns = ("PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY", "INSTALLMENT_PLAN")
    assert mined(spark, "APPLE", list(rows), *columns) == list(rows.values())


def test_citi(spark):
    rows = {
        "ONLINE PAYMENT, THANK YOU": ("PAYMENT", "CITI BANK", "ONLINE"),
        "WWW COSTCO COM": ("ONLINE PURCHASE", "COSTCO ONLINE", "ONLINE/TRANSFER"),
        "COSTCO GAS #0123 PLANO TX": ("GAS STATION", "COSTCO GAS", "PLANO TX"),
        "COSTCO WHSE #01": ("CREDIT CARD", "COSTCO", "ONLINE/TRANSFER"),
        "SHELL 1234 DALLAS TX": ("GAS STATION", "SHELL", "DALLAS TX"),
        "LOVE'S #1 PLANO TX": ("GAS STATION", "LOVE'S", "PLANO TX"),
        "SQ * CAFE 800-555-0000": ("CREDIT CARD", "CAFE", "ONLINE/TRANSFER"),
        "USPS.COM CLICK 1": ("ONLINE PURCHASE", "USPS ONLINE", "ONLINE/TRANSFER"),
        "PROGRESSIVE *INSURANCE 1": ("CREDIT CARD", "PROGRESSIVE", "ONLINE/TRANSFER"),
    }
    assert mined(spark, "CITI", list(rows), "PAYMENT_CHANNEL", "ENTITY_NAME", "GEOGRAPHY") == list(rows.values())
    assert mined(spark, "CITI", ["X"], "DETAILED_CATEGORY") == [("MERCHANDISE",)]


def test_names_need_the_sub_category_of_the_same_category(spark):
    assert mined(spark, "CITI", [("X", None, 4)], "CATG_NAME", "SUB_CATG_NAME") == [("Travel", None)]


def test_report_channel(spark):
    rows = ["POS/SHOP/X", "UPI/A/B/ANN", "ATM-1", "ELSE"]
    df = facts(spark, rows).select("TRANSACTION_ID", "DESCRIPTION")
    got = [(r["CHANNEL"], r["MERCHANT"]) for r in report_channel(df).orderBy("TRANSACTION_ID").collect()]
    assert got == [("DEBIT CARD", "SHOP"), ("UPI", "ANN"), ("CASH", "GENERAL"), ("OTHERS", "GENERAL")]


def test_bank_lookup(spark):
    rows = [(1, "Axis Bank", 0), (2, "axis bank", 1), (3, "AXIS", 1), (4, "Wells Fargo", 0), (5, "American Express", 1)]
    banks = spark.createDataFrame(rows, "BANK_ID int, BANK_NAME string, IS_CURRENT int")
    assert bank_id_of(banks, BANKS["AXIS"]) == 2
    assert bank_id_of(banks, BANKS["WELLSFARGO"]) == 4
    assert bank_id_of(banks, BANKS["AMEX"]) == 5
    with pytest.raises(ValueError):
        bank_id_of(banks, BANKS["CITI"])
