"""Table definitions: Spark schemas, primary keys, foreign keys and text lengths.

Text lengths live next to the type so that the insert sink can cut and the
quality checks can measure without a second list.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "flag": T.IntegerType(),
    "money": T.DecimalType(19, 4),
    "total": T.DecimalType(38, 4),
    "rate": T.DecimalType(10, 6),
    "datetime": T.TimestampNTZType(),
    "secret": T.BinaryType(),
    "text": T.StringType(),
}


#: Stored beside the declared columns of a table with dates: year * 100 + month, the last partition level.
MONTH = "TXN_MONTH"


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    month_of: str | None = None

    @property
    def stored_by(self) -> tuple[str, ...]:
        """Partition levels of the stored table."""
        return (*self.partition_by, MONTH) if self.month_of else self.partition_by

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _table(name, columns, key=(), foreign=None, partition_by=(), month_of=None):
    """``columns`` lines read ``NAME kind`` with ``!`` for NOT NULL and ``text(n)`` for lengths."""
    fields, lengths = [], {}
    for line in columns.split(","):
        column, kind = line.split()
        nullable = not kind.endswith("!")
        kind = kind.rstrip("!")
        if kind.startswith("text("):
            lengths[column] = int(kind[5:-1])
            kind = "text"
        fields.append(T.StructField(column, _TYPES[kind], nullable))
    return Table(name, T.StructType(fields), tuple(key), lengths, foreign or {}, tuple(partition_by), month_of)


_VERSION = "EFF_START_DATE datetime!, EFF_END_DATE datetime!, IS_CURRENT flag!, ADDED_USER text(20)!"

LANDING = _table(
    "LND_TRANSACTIONS",
    "TRANSACTION_DATE text(30), POSTED_DATE text(20), DESCRIPTION text(1000), AMOUNT text(30),"
    "EXT_DETAILS text(1000), STATEMENT_DESC text(1000), ADDRESS text(1000), CITY_STATE text(1000),"
    "ZIPCODE text(50), COUNTRY text(50), REFERENCE text(100), CATEGORY text(1000), DEBIT text(30),"
    "CREDIT text(30)",
)

TRANSACTIONS = _table(
    "TRANSACTIONS",
    "TRANSACTION_ID long!, TRANSACTION_DATE datetime!, POSTED_DATE datetime, TRANSACTION_TYPE text(10)!,"
    "TRANSACTION_AMOUNT money!, DESCRIPTION text(100)!, EXT_DESCRIPTION text(500), ADDRESS_1 text(150),"
    "ADDRESS_2 text(50), CITY text(50), STATE text(50), COUNTRY text(50), ZIPCODE text(20), CATG_ID int!,"
    "SUB_CATG_ID int!, BANK_ID int!, CARD_ID int!, MEMBER_ID int!, ADDED_USER text(20)!, ADDED_DATETIME datetime!",
    key=["TRANSACTION_ID"],
    foreign={
        "CATG_ID": ("MCC_CATEGORY", "CATG_ID"),
        "SUB_CATG_ID": ("MCC_SUB_CATEGORY", "SUB_CATG_ID"),
        "BANK_ID": ("BANKS", "BANK_ID"),
        "CARD_ID": ("CARDS", "CARD_ID"),
        "MEMBER_ID": ("MEMBERS", "MEMBER_ID"),
    },
    partition_by=["BANK_ID"],
    month_of="TRANSACTION_DATE",
)

REPORTING = _table(
    "TRANSACTION_REPORTING",
    "TRANSACTION_ID long!, BANK_ID int!, CARD_ID int!, MEMBER_ID int!, TRANSACTION_DATE datetime!,"
    "POSTED_DATE datetime, TRANSACTION_AMOUNT money!, TRANSACTION_TYPE text(10)!, PAYMENT_CHANNEL text(50),"
    "ENTITY_NAME text(150), GEOGRAPHY text(150), CATG_NAME text(150), SUB_CATG_NAME text(150),"
    "DETAILED_CATEGORY text(100), ASSOCIATED_BANK text(100), TRACE_ID text(100), TRANSACTION_MEMO text(500),"
    "INSTALLMENT_PLAN text(50), LAST_REFRESHED datetime",
    key=["TRANSACTION_ID"],
    foreign={"TRANSACTION_ID": ("TRANSACTIONS", "TRANSACTION_ID")},
    partition_by=["BANK_ID"],
    month_of="TRANSACTION_DATE",
)

CATEGORY = _table(
    "MCC_CATEGORY",
    "CATG_ID int!, CATG_NAME text(150)!, ADDED_USER text(50)!, ADDED_DATETIME datetime!",
    key=["CATG_ID"],
)

SUB_CATEGORY = _table(
    "MCC_SUB_CATEGORY",
    "SUB_CATG_ID int!, SUB_CATG_NAME text(150)!, CATG_ID int!, ADDED_USER text(50)!, ADDED_DATETIME datetime!",
    key=["SUB_CATG_ID"],
    foreign={"CATG_ID": ("MCC_CATEGORY", "CATG_ID")},
)

BANKS = _table(
    "BANKS",
    f"BANK_ID int!, BANK_KEY int!, BANK_NAME text(50)!, ACCOUNT_TYPE text(50)!, {_VERSION}",
    key=["BANK_ID"],
)

MEMBER_ADDRESS = _table(
    "MEMBER_ADDRESS",
    "ADDRESS_ID int!, ADDRESS_KEY int!, ADDRESS_1 text(150)!, ADDRESS_2 text(50), CITY text(50)!,"
    f"STATE text(50)!, ZIPCODE text(10)!, {_VERSION}",
    key=["ADDRESS_ID"],
)

MEMBERS = _table(
    "MEMBERS",
    "MEMBER_ID int!, MEMBER_KEY int!, FIRST_NAME text(50)!, MIDDLE_NAME text(20), LAST_NAME text(50)!,"
    f"GENDER text(10)!, DATE_OF_BIRTH secret, ADDRESS_ID int!, {_VERSION}",
    key=["MEMBER_ID"],
    foreign={"ADDRESS_ID": ("MEMBER_ADDRESS", "ADDRESS_ID")},
)

CARDS = _table(
    "CARDS",
    "CARD_ID int!, CARD_KEY int!, CARD_TYPE text(20)!, CARD_NUMBER secret, LAST_4 text(4), EXP_DATE secret,"
    f"CVV secret, BANK_ID int!, MEMBER_ID int!, {_VERSION}",
    key=["CARD_ID"],
    foreign={"BANK_ID": ("BANKS", "BANK_ID"), "MEMBER_ID": ("MEMBERS", "MEMBER_ID")},
)

EXCHANGE_RATES = _table(
    "EXCHANGE_RATES",
    "RATE_DATE text(20)!, FROM_CURRENCY text(3)!, TO_CURRENCY text(3)!, CONVERSION_RATE rate!",
    key=["RATE_DATE", "FROM_CURRENCY", "TO_CURRENCY"],
)

ETL_LOG = _table(
    "ETL_LOG",
    "LOG_ID long!, PROC_NAME text(100)!, BANK_ID int, START_TIME datetime, END_TIME datetime,"
    "ROWS_PROCESSED long, STATUS text(20), ERROR_MSG text",
    key=["LOG_ID"],
)

# One row of onboarding parameters; APPLICANT_NO gives the order the rows would have been entered in.
APPLICANTS = _table(
    "APPLICANTS",
    "APPLICANT_NO long!, FIRST_NAME text(50)!, LAST_NAME text(50)!, GENDER text(10)!, DATE_OF_BIRTH text,"
    "ADDRESS_1 text(150)!, ADDRESS_2 text(150), CITY text(50)!, STATE text(50)!, ZIPCODE text(10)!,"
    "COUNTRY text(50), BANK_NAME text(50)!, ACCOUNT_TYPE text(20)!, CARD_TYPE text(20)!,"
    "CARD_NUMBER text(20)!, EXP_DATE text(5), CVV text(4)",
    key=["APPLICANT_NO"],
)

TABLES = {
    t.name: t
    for t in (
        LANDING, TRANSACTIONS, REPORTING, CATEGORY, SUB_CATEGORY, BANKS, MEMBER_ADDRESS,
        MEMBERS, CARDS, EXCHANGE_RATES, ETL_LOG,
    )
}

# Sums worked out from the facts, month by month; no table of its own right, so it is not among TABLES.
MONTHLY_SUMS = _table(
    "MONTHLY_SUMS",
    "MONTH_START datetime!, TRANSACTION_TYPE text(10)!, AMOUNT total, CNT long!",
    key=["MONTH_START", "TRANSACTION_TYPE"],
    month_of="MONTH_START",
)

# What a job did to its table, beside the log row of the same id; a figure the job does not work out is null.
RUN_COUNTS = _table("RUN_COUNTS", "LOG_ID long!, INSERTED long, REPLACED long, REJECTED long", key=["LOG_ID"])


def table_of(name: str) -> Table:
    return {MONTHLY_SUMS.name: MONTHLY_SUMS, RUN_COUNTS.name: RUN_COUNTS}.get(name) or TABLES[name]


OPEN_END = "9999-12-31 23:59:59"
