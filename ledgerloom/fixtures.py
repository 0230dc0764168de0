"""Bank-shaped inputs derived from the order tables.

No bank data ships with the project, so statements, facts and dimensions are
derived from ``orders``, ``customer``, ``nation`` and ``region`` by plain SQL.
The same text runs on Spark and on the checking engine.  Every order gives one
statement row at each of the seven banks, so each derived table grows with
``orders`` or ``customer``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.pipeline import refreshed_by_bank
from ledgerloom.schemas import LANDING, TABLES
from ledgerloom.session import stage, stage_parts, weighed

AS_OF = datetime(2025, 1, 1)
SOURCES = ("orders", "customer", "nation", "region")

BASE = """
SELECT o.o_orderkey AS k, CAST(o.o_orderkey AS STRING) AS ks, o.o_custkey AS ck, o.o_orderstatus AS st,
       CAST(CAST(o.o_totalprice AS DECIMAL(19,2)) AS STRING) AS amt, o.o_orderdate AS dt,
       lpad(CAST(extract(month FROM o.o_orderdate) AS STRING), 2, '0') AS mm,
       lpad(CAST(extract(day FROM o.o_orderdate) AS STRING), 2, '0') AS dd,
       CAST(extract(year FROM o.o_orderdate) AS STRING) AS yy,
       c.c_name AS nm, c.c_mktsegment AS seg, o.o_orderpriority AS pri, n.n_name AS nat, r.r_name AS reg
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

_US = "mm || '/' || dd || '/' || yy"
_ISO = "yy || '-' || mm || '-' || dd"
_MIXED = "CASE WHEN k % 2 = 1 THEN dd || '-' || mm || '-' || yy ELSE mm || '/' || dd || '/' || yy END"
_BAD = "CASE WHEN k % 97 = 0 THEN '13/45/2025' ELSE mm || '/' || dd || '/' || yy END"
_SIGNED = "CASE WHEN st = 'P' THEN '-' || amt ELSE amt END"
_DEBIT = "CASE WHEN st <> 'P' THEN amt WHEN k % 2 = 0 THEN NULL ELSE '' END"
_CREDIT = "CASE WHEN st = 'P' THEN amt WHEN k % 2 = 0 THEN NULL ELSE '' END"


def _pick(*templates: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(templates))
    return f"CASE k % {len(templates)} {arms} END"


# One description template per rule branch, some of them in lower or mixed case.
DESCRIPTIONS = {
    "AXIS": _pick(
        "'POS/' || seg || '/' || reg || '/' || ks", "'ECOM PUR/' || seg || '/' || nat || '/X'",
        "'UPI/P2M/' || ks || '/' || nm || '/PAYMENT/'", "'IMPS/P2A/' || ks || '/' || nm || '/NA BANK'",
        "'ATM-CASH/' || ks || '/' || reg", "'MOB/TPFT/' || nm || '/' || ks", "'ECS/' || ks || '/' || seg",
        "'SB:' || ks || ':INT.PD:01'", "'NBSM/' || ks || '/' || seg || '/' || nat",
        "'pur-rev/' || ks || '/' || nm", "'SALARY ' || nm || ' PAYROLL'",
    ),
    "WELLSFARGO": _pick(
        "'PURCHASE AUTHORIZED ON 01/02 ' || seg || ' ' || reg || ' MCKINNEY TX S' || ks || ' CARD 0000'",
        "'Zelle from ' || nm || ' on 01/02 Ref # ' || ks || ' rent'",
        "'Zelle to ' || nm || ' on 01/02 Ref # JPM' || ks", "'ATM CASH WDL ' || reg || ' ATM ID ' || ks",
        "seg || ' PAYROLL ' || ks", "'ONLINE TRANSFER REF # ' || ks || ' BAC'", "'MONTHLY SERVICE CHG'",
        "'\"' || seg || ' COFFEE, ' || reg || '\"'", "'DISCOVER E-PAYMENT ' || ks",
        "'AMERENMO WEB PMT ' || ks", "'Citi Card Online Payment ' || ks", "'CAPITAL ONE MOBILE PMT ' || ks",
        "'AMERICAN EXPRESS ACH PMT ' || ks", "'APPLECARD GSBANK PAYMENT ' || ks", "'LIBERTY MUTUAL PREM ' || ks",
        "'PROG COUNTY MUT INS PREM ' || ks", "'IRS USATAXPYMT ' || ks", "'MO DEPT REVENUE MOSTTAXRFD ' || ks",
        "'RELIABLE SOFTWAR PAYROLL ' || ks", "'SCHWAB BROKERAGE MONEYLINK ' || ks", "'WELLS FARGO AUTO DRAFT ' || ks",
        "'PF MCKINNEY CLUB FEES ' || ks",
    ),
    "AMEX": _pick(
        "'MOBILE PAYMENT - THANK YOU'", "'APLPAY ' || seg || '  ' || reg || '  TX'",
        "'TST* ' || seg || ' 12345  ' || reg || '  TX'", "seg || '.COM  ' || reg || '  WA'", "seg || ' STORE'",
        "'HOTEL ' || nat || '  ' || reg || '  NV'", "'AIRLINE ' || seg", "'aplpay ' || lower(seg)", "seg",
        "'DISCOUNT ' || reg",
    ),
    "DISCOVER": _pick(
        "'INTERNET PAYMENT - THANK YOU'", "'AMAZON MKTPL*' || ks || ' SEATTLE WA'", "'AMZN.COM/BILL WA'",
        "seg || ' STORE 123 DALLAS TX'", "seg || ' ' || ks || '1234567890'", "'amazon.com*' || ks || ' ' || reg",
        "'SHELL OIL ' || ks || '-' || ks || ' HOUSTON TX'", "'TARGET ' || reg || ' TX75001'",
        "'ONLINE PAYMENT ' || seg",
    ),
    "CAPITALONE": _pick(
        "'CAPITAL ONE MOBILE PYMT'", "'SOUTHWES 526' || lpad(ks, 10, '0')", "'NTTA AUTOCHARGE'", "'COT*HTL'",
        "'COT*FLT'", "'TST* ' || seg || '  ' || reg", "'AMERICAN ' || ks",
        "seg || ' AIR ' || lpad(ks, 10, '0') || ' X'", "'Qatar Air ' || nat", "'KRISHNA INSTITUTE ' || reg",
    ),
    "APPLE": _pick(
        "'ACH DEPOSIT INTERNET TRANSFER FROM ACCOUNT ' || ks", "'MONTHLY INSTALLMENTS (2 OF 12)'",
        "'DAILY CASH ADJUSTMENT'", "seg || ' (RETURN)'",
        "'APPLE.COM/BILL ONE APPLE PARK WAY 866-712-7753 CUPERTINO 95014 CA USA'",
        "seg || ' 100 MAIN STREET DALLAS 75001 TX USA ' || nm || ' ' || nm || ' ' || nm",
        "'TST* ' || seg || ' PKWY ' || reg", "'GFM*' || seg || ' GOFUNDME.COM'", "'SP AG1 ' || seg || ' #' || ks",
    ),
    "CITI": _pick(
        "'ONLINE PAYMENT, THANK YOU'", "'WWW COSTCO COM'", "'COSTCO GAS #0123 ' || reg || ' TX'",
        "'SHELL ' || ks || ' DALLAS TX'", "'LOVE' || chr(39) || 'S #1 ' || reg || ' TX'",
        "'SQ * ' || seg || ' 800-555-0000'", "'COSTCO WHSE #0' || ks", "'USPS.COM CLICK ' || ks",
        "'PROGRESSIVE *INSURANCE 888-' || ks", "'PY * ' || seg || ' ' || reg || ' CA'",
    ),
}

_AMEX_EXT = (
    "CASE k % 10 WHEN 4 THEN 'Fast Food Restaurant' WHEN 5 THEN 'LODGING' WHEN 6 THEN 'PASSENGER NAME : ' || nm"
    " || ' TICKET NUMBER : ' || ks || ' PASSENGER TICKET' WHEN 7 THEN 'DESCRIPTION : ' || seg || ' PRICE : 1.00'"
    " WHEN 8 THEN 'GROCERY STORE' WHEN 9 THEN 'DISCOUNT STORE' END"
)
_DISCOVER_CATEGORY = (
    "CASE k % 5 WHEN 0 THEN 'Gasoline' WHEN 1 THEN 'Payments and Credits' WHEN 2 THEN seg WHEN 3 THEN 'Restaurants' END"
)
_DASHED = "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN 'Uncategorised' ELSE seg || '-' || pri END"
_PLAIN = "CASE WHEN k % 11 = 0 THEN NULL ELSE ' ' || lower(seg) END"

LANDING_COLUMNS = {
    "AXIS": {
        "TRANSACTION_DATE": _MIXED, "POSTED_DATE": _US, "STATEMENT_DESC": DESCRIPTIONS["AXIS"],
        "CATEGORY": _PLAIN, "DEBIT": f"CASE WHEN k % 89 = 0 THEN 'n/a' ELSE {_DEBIT} END", "CREDIT": _CREDIT,
    },
    "WELLSFARGO": {
        "TRANSACTION_DATE": "'\"' || " + _MIXED + " || '\"'", "POSTED_DATE": _US,
        "DESCRIPTION": DESCRIPTIONS["WELLSFARGO"],
        "AMOUNT": "CASE WHEN k % 83 = 0 THEN '?' ELSE '\"' || CASE WHEN st = 'P' THEN '-' ELSE '' END || CASE WHEN k % 2 = 0 THEN amt ELSE "
                  "substr(amt, 1, length(amt) - 6) || ',' || substr(amt, length(amt) - 5) END || '\"' END",
    },
    "AMEX": {
        "TRANSACTION_DATE": _BAD, "DESCRIPTION": DESCRIPTIONS["AMEX"], "AMOUNT": _SIGNED,
        "EXT_DETAILS": _AMEX_EXT, "STATEMENT_DESC": "seg", "ADDRESS": "nat || ' street'",
        "CITY_STATE": "reg || chr(10) || 'tx'", "ZIPCODE": "lpad(ks, 5, '0')", "COUNTRY": "'United States'",
        "REFERENCE": "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN chr(39) || CAST(k - 1 AS STRING) "
                     "ELSE chr(39) || ks END",
        "CATEGORY": _DASHED,
    },
    "DISCOVER": {
        "TRANSACTION_DATE": _US, "POSTED_DATE": _US, "DESCRIPTION": DESCRIPTIONS["DISCOVER"], "AMOUNT": _SIGNED,
        "CATEGORY": _DISCOVER_CATEGORY,
    },
    "CAPITALONE": {
        "TRANSACTION_DATE": _ISO, "POSTED_DATE": _ISO, "DESCRIPTION": DESCRIPTIONS["CAPITALONE"],
        "CATEGORY": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 4 = 0 THEN 'Airfare' WHEN k % 4 = 1 "
                    "THEN 'Gas/Automotive' WHEN k % 4 = 2 THEN seg ELSE 'Dining' END",
        "DEBIT": _DEBIT, "CREDIT": "CASE WHEN st = 'P' OR k % 10 = 0 THEN amt WHEN k % 2 = 0 THEN NULL ELSE '' END",
    },
    "APPLE": {
        "TRANSACTION_DATE": _BAD, "POSTED_DATE": _US, "DESCRIPTION": DESCRIPTIONS["APPLE"], "AMOUNT": _SIGNED,
        "STATEMENT_DESC": "CASE k % 3 WHEN 0 THEN 'Payment' WHEN 1 THEN 'Credit' ELSE 'Purchase' END",
        "CATEGORY": _PLAIN,
    },
    "CITI": {
        "TRANSACTION_DATE": _BAD, "POSTED_DATE": _US, "DESCRIPTION": DESCRIPTIONS["CITI"], "CATEGORY": _PLAIN,
        "DEBIT": _DEBIT, "CREDIT": "CASE WHEN st = 'P' THEN '-' || amt WHEN k % 2 = 0 THEN NULL ELSE '' END",
    },
}

BANK_NUMBER = {b: i for i, b in enumerate(DESCRIPTIONS, start=1)}


def landing_sql(bank: str) -> str:
    given = LANDING_COLUMNS[bank]
    columns = ", ".join(f"CAST({given.get(c, 'NULL')} AS STRING) AS {c}" for c in LANDING.columns)
    return f"SELECT {columns} FROM ({BASE}) b"


def _facts_of(bank: str) -> str:
    number = BANK_NUMBER[bank]
    extended = {
        "AMEX": f"upper(coalesce({_AMEX_EXT}, '') || ' STATEMENT: ' || seg)",
        "DISCOVER": f"upper({_DISCOVER_CATEGORY})",
    }.get(bank, "CAST(NULL AS STRING)")
    description = f"upper(substr(replace({DESCRIPTIONS[bank]}, '\"', ''), 1, 100))"
    return f"""
SELECT k * 14 + {number * 2} AS TRANSACTION_ID, dt AS TRANSACTION_DATE, CASE WHEN k % 2 = 0 THEN dt END AS POSTED_DATE,
       CASE WHEN st = 'P' THEN 'CDT' ELSE 'DBT' END AS TRANSACTION_TYPE,
       CAST(amt AS DECIMAL(19,4)) AS TRANSACTION_AMOUNT, {description} AS DESCRIPTION,
       {extended} AS EXT_DESCRIPTION, CAST(NULL AS STRING) AS ADDRESS_1, CAST(NULL AS STRING) AS ADDRESS_2,
       reg AS CITY, CAST(NULL AS STRING) AS STATE, 'US' AS COUNTRY, lpad(ks, 5, '0') AS ZIPCODE,
       CAST(substr(pri, 1, 1) AS INT) AS CATG_ID,
       CASE WHEN k % 19 = 0 THEN 999 ELSE CAST(substr(pri, 1, 1) AS INT) * 10 + ({_SEGMENT_NO}) END AS SUB_CATG_ID,
       {number} AS BANK_ID, CAST(ck AS INT) AS CARD_ID, CAST(ck * 2 + 1 AS INT) AS MEMBER_ID,
       'LOADER' AS ADDED_USER, CAST('202{number}-01-01 00:00:00' AS TIMESTAMP) AS ADDED_DATETIME
FROM ({BASE}) b"""


_SEGMENT_NO = (
    "CASE seg WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END"
)
_SEGMENT_NAME = (
    "CASE seg WHEN 'AUTOMOBILE' THEN 'Gas/Automotive' WHEN 'BUILDING' THEN 'Airfare' WHEN 'FURNITURE' THEN 'Dining'"
    " WHEN 'HOUSEHOLD' THEN 'RESTAURANTS' ELSE 'MERCHANT REFUND' END"
)
_PRIORITY_NAME = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Food' WHEN '2' THEN 'TRAVEL' WHEN '3' THEN 'APPLE CARD EXPENDITURE'"
    " WHEN '4' THEN 'MERCHANT REFUND' ELSE 'Merchant Refund' END"
)
_VERSION = (
    "CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS EFF_START_DATE, "
    "CAST(CASE WHEN {current} = 1 THEN '9999-12-31 23:59:59' ELSE '2021-01-01 00:00:00' END AS TIMESTAMP) "
    "AS EFF_END_DATE, {current} AS IS_CURRENT, 'SEED' AS ADDED_USER"
)
_AUDIT = "'SEED' AS ADDED_USER, CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS ADDED_DATETIME"


def _member_version(current: int) -> str:
    return f"""
SELECT CAST(c_custkey * 2 + {current} AS INT) AS MEMBER_ID, CAST(5001 + c_custkey AS INT) AS MEMBER_KEY,
       c_name AS FIRST_NAME, CAST(NULL AS STRING) AS MIDDLE_NAME, c_mktsegment AS LAST_NAME, 'X' AS GENDER,
       CAST(NULL AS {{blob}}) AS DATE_OF_BIRTH, (c_nationkey + {1 - current}) % 25 + 1 AS ADDRESS_ID,
       {_VERSION.format(current=current)} FROM {{customer}}"""


_BANK_NAMES = (
    "Axis Bank", "WellsFargo Bank", "American Express", "Discover Bank", "CapitalOne Bank", "Apple Bank", "Citi Bank",
)

_LOG = "'load_' || lower(seg) AS PROC_NAME, CAST(k % 7 + 1 AS INT) AS BANK_ID, CAST(dt AS TIMESTAMP) AS START_TIME"

TABLE_SQL = {
    "MCC_CATEGORY": f"SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS CATG_ID, "
                    f"{_PRIORITY_NAME} AS CATG_NAME, {_AUDIT} FROM {{orders}}",
    "MCC_SUB_CATEGORY": f"SELECT DISTINCT CAST(substr(pri, 1, 1) AS INT) * 10 + ({_SEGMENT_NO}) AS SUB_CATG_ID, "
                        f"{_SEGMENT_NAME} AS SUB_CATG_NAME, CAST(substr(pri, 1, 1) AS INT) AS CATG_ID, {_AUDIT} "
                        f"FROM ({BASE}) b",
    "BANKS": "SELECT BANK_ID, BANK_KEY, BANK_NAME, ACCOUNT_TYPE, " + _VERSION.format(current="CUR").replace(
                 "CUR AS IS_CURRENT", "CAST(CUR AS INT) AS IS_CURRENT") + " FROM (VALUES "
             + ", ".join(f"({i}, {2000 + i}, '{n}', 'CREDIT', 1)" for i, n in enumerate(_BANK_NAMES, start=1))
             + ", (8, 2003, 'Amex', 'CREDIT', 0), (9, 2001, 'Axis Bank', 'SAVINGS', 1)) "
             "AS t(BANK_ID, BANK_KEY, BANK_NAME, ACCOUNT_TYPE, CUR)",
    "MEMBER_ADDRESS": "SELECT n_nationkey + 1 AS ADDRESS_ID, 1001 + n_nationkey AS ADDRESS_KEY, "
                      "CAST(n_nationkey AS STRING) || ' ' || n_name || ' street' AS ADDRESS_1, "
                      "CAST(NULL AS STRING) AS ADDRESS_2, n_name AS CITY, r_name AS STATE, "
                      "lpad(CAST(n_nationkey AS STRING), 5, '0') AS ZIPCODE, " + _VERSION.format(current="1")
                      + " FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
    "MEMBERS": _member_version(0) + " UNION ALL " + _member_version(1),
    "CARDS": "SELECT CAST(c_custkey AS INT) AS CARD_ID, CAST(8001 + c_custkey AS INT) AS CARD_KEY, "
             "'CREDIT' AS CARD_TYPE, CAST(NULL AS {blob}) AS CARD_NUMBER, right(c_name, 4) AS LAST_4, "
             "CAST(NULL AS {blob}) AS EXP_DATE, CAST(NULL AS {blob}) AS CVV, "
             "CAST(c_custkey % 7 + 1 AS INT) AS BANK_ID, CAST(c_custkey * 2 + 1 AS INT) AS MEMBER_ID, "
             + _VERSION.format(current="1") + " FROM {customer}",
    "TRANSACTIONS": " UNION ALL ".join(_facts_of(b) for b in DESCRIPTIONS),
    "EXCHANGE_RATES": "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS STRING) AS RATE_DATE, 'USD' AS FROM_CURRENCY, "
                      "upper(substr(o_orderpriority, 3, 3)) AS TO_CURRENCY, CAST(1.5 AS DECIMAL(18,6)) AS CONVERSION_RATE FROM {orders}",
    "ETL_LOG": f"SELECT k AS LOG_ID, {_LOG}, CAST(NULL AS TIMESTAMP) AS END_TIME, CAST(0 AS BIGINT) AS ROWS_PROCESSED, "
               f"'STARTED' AS STATUS, CAST(NULL AS STRING) AS ERROR_MSG FROM ({BASE}) b UNION ALL "
               f"SELECT k AS LOG_ID, {_LOG}, CAST(dt AS TIMESTAMP) + INTERVAL '1' HOUR AS END_TIME, CAST(k % 1000 AS BIGINT) AS ROWS_PROCESSED, "
               "CASE WHEN k % 13 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS STATUS, CASE WHEN k % 13 = 0 THEN 'bad row' END AS ERROR_MSG "
               f"FROM ({BASE}) b WHERE k % 5 <> 0",
    "APPLICANTS": """
SELECT c_custkey AS APPLICANT_NO,
       CASE WHEN c_custkey % 3 = 0 THEN 'New ' || CAST(c_custkey - c_custkey % 12 AS STRING) ELSE c_name END AS FIRST_NAME,
       CASE WHEN c_custkey % 3 = 0 THEN 'Comer' ELSE lower(c_mktsegment) END AS LAST_NAME, CASE WHEN c_custkey % 61 = 9 THEN NULL ELSE 'X' END AS GENDER, '1990-01-02' AS DATE_OF_BIRTH,
       CASE WHEN c_custkey % 53 = 2 THEN repeat('Very long road ', 12) || CAST(c_custkey % 5 AS STRING)
            WHEN c_custkey % 3 = 2 THEN CAST(c_custkey % 1000 AS STRING) || ' Moved Road'
            ELSE CAST(c_nationkey AS STRING) || ' ' || n_name || ' STREET' END AS ADDRESS_1,
       CAST(NULL AS STRING) AS ADDRESS_2, n_name AS CITY, r_name AS STATE,
       CASE WHEN c_custkey % 47 = 5 THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 5, '0') END AS ZIPCODE, 'US' AS COUNTRY,
       CASE WHEN c_custkey % 5 = 0 THEN 'New Bank ' || r_name ELSE 'Apple Bank' END AS BANK_NAME,
       'CREDIT' AS ACCOUNT_TYPE, 'CREDIT' AS CARD_TYPE, '4000' || lpad(CAST(c_custkey AS STRING), 12, '0') AS CARD_NUMBER,
       '01/30' AS EXP_DATE, '000' AS CVV
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
}


_STORED: dict[tuple[str, str, str], DataFrame] = {}
ROWS_PER_FILE = 500_000  # rows of a file of the base view, so that its sort by date stays in memory at any size


class Fixtures:
    """The derived tables over one scale-factor folder.

    Each is written once per application, facts by bank, so that the operators
    read stored tables as they would in use.  The base view, from which most are
    derived row by row, is stored first and is all that is shuffled: in files of
    a bounded number of rows, more of them for more orders, each a range of dates.
    The tables derived from it are written where its rows lie and keep that order.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _derive(self, text: str, **given: DataFrame) -> DataFrame:
        text = text.replace(f"({BASE})", "{base}")
        used = {n: given[n] if n in given else self._source(n) for n in SOURCES if "{" + n + "}" in text}
        if "{base}" in text:
            used["base"] = self._kept("base", self._base)
        return self.spark.sql(text.replace("{blob}", "BINARY").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)"), **used)

    def _kept(self, name: str, made: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STORED:
            _STORED[key] = made()
        return _STORED[key]

    def _base(self) -> DataFrame:
        """The base view in as many files as there are cores, as a large table would have at least, and as its rows need."""
        rows = self._derive(BASE.strip(), customer=weighed(self._source("customer")))
        orders = self._source("orders").count()
        files = max(self.spark.sparkContext.defaultParallelism, -(-orders // ROWS_PER_FILE))
        return stage(rows.repartitionByRange(files, "dt", "k").sortWithinPartitions("dt", "k"), "input-base")

    def table(self, name: str) -> DataFrame:
        if name == "TRANSACTIONS":
            return self._kept(name, lambda: stage_parts(self._facts(), "input-transactions", "BANK_ID"))
        return self._kept(name, lambda: stage(self._derive(TABLE_SQL[name]), f"input-{name.lower()}"))

    def _facts(self) -> list[tuple[int, DataFrame]]:
        return [(BANK_NUMBER[b], self._derive(_facts_of(b))) for b in DESCRIPTIONS]

    def landing(self, bank: str) -> DataFrame:
        return self._kept(f"landing-{bank}", lambda: stage(self._derive(landing_sql(bank)), f"input-landing-{bank}"))

    def reporting(self) -> DataFrame:
        """The reporting table of all facts."""
        def made():
            named = [self.table(n) for n in ("TRANSACTIONS", "MCC_CATEGORY", "MCC_SUB_CATEGORY", "BANKS")]
            return stage_parts(refreshed_by_bank(*named, AS_OF), "input-reporting", "BANK_ID")

        return self._kept("TRANSACTION_REPORTING", made)


def check_sql(text: str) -> str:
    """The same text for the checking engine, with the tables under their own names."""
    for name in SOURCES:
        text = text.replace("{" + name + "}", name)
    return text.replace("{blob}", "BLOB")
