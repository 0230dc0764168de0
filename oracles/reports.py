"""Checking SQL for the reports, sinks, checks and profiles."""

from __future__ import annotations

from ledgerloom.operators.profile import SAMPLE_SIZE, SAMPLED_NAMES
from ledgerloom.schemas import REPORTING, TABLES, TRANSACTIONS
from oracles.mining import enrich_sql, reporting_sql
from oracles.sqltext import landing, quote, table

T, C, S = table("TRANSACTIONS"), table("MCC_CATEGORY"), table("MCC_SUB_CATEGORY")
B, M, K, A = table("BANKS"), table("MEMBERS"), table("CARDS"), table("MEMBER_ADDRESS")
_SUM = "CAST(sum({}) AS DECIMAL(38,4))"
_AMOUNT = _SUM.format("TRANSACTION_AMOUNT")

TRANSACTION_LOG = (
    "SELECT TRANSACTION_DATE, FIRST_NAME, LAST_NAME, BANK_NAME, LAST_4, DESCRIPTION, TRANSACTION_AMOUNT, TRANSACTION_TYPE "
    f"FROM {T} t JOIN {M} m ON t.MEMBER_ID = m.MEMBER_ID JOIN {B} b ON t.BANK_ID = b.BANK_ID "
    f"JOIN {K} k ON t.CARD_ID = k.CARD_ID ORDER BY TRANSACTION_DATE DESC"
)
SPEND_BY_CATEGORY = (
    f"SELECT min(CATG_NAME) AS CATG_NAME, min(SUB_CATG_NAME) AS SUB_CATG_NAME, {_AMOUNT} AS TOTAL_SPENT FROM {T} t JOIN {C} c ON t.CATG_ID = c.CATG_ID "
    f"JOIN {S} s ON t.SUB_CATG_ID = s.SUB_CATG_ID WHERE TRANSACTION_TYPE = 'DBT' "
    "GROUP BY upper(CATG_NAME), upper(SUB_CATG_NAME) ORDER BY TOTAL_SPENT DESC"
)
ACTIVE_MEMBERS = (
    f"SELECT FIRST_NAME, LAST_NAME, ADDRESS_1, CITY, STATE, ZIPCODE FROM {M} m JOIN {A} a ON m.ADDRESS_ID = a.ADDRESS_ID "
    "WHERE m.IS_CURRENT = 1 AND a.IS_CURRENT = 1"
)


def monthly(code):
    return (
        "SELECT *, CAST(TOTAL_INCOME - TOTAL_SPEND AS DECIMAL(38,4)) AS NET_SAVINGS, CASE WHEN TOTAL_SPEND > "
        "TOTAL_INCOME * 0.8 THEN 'OVERSPENT' ELSE 'WITHIN BUDGET' END AS BUDGET_STATUS FROM (SELECT "
        "strftime(TRANSACTION_DATE, '%Y-%m') AS MONTH, "
        f"CAST(coalesce(sum(TRANSACTION_AMOUNT) FILTER (TRANSACTION_TYPE = '{code}'), 0) AS DECIMAL(38,4)) AS TOTAL_INCOME, "
        "CAST(coalesce(sum(TRANSACTION_AMOUNT) FILTER (TRANSACTION_TYPE = 'DBT'), 0) AS DECIMAL(38,4)) AS TOTAL_SPEND "
        f"FROM {T} t GROUP BY 1)"
    )


MONTHLY_CATEGORIES = (
    f"SELECT strftime(TRANSACTION_DATE, '%Y-%m-01') AS MONTH_START, count(*) AS CNT, {_AMOUNT} AS SPEND, t.CATG_ID, "
    f"CATG_NAME, t.SUB_CATG_ID, SUB_CATG_NAME FROM {T} t LEFT JOIN {C} c ON t.CATG_ID = c.CATG_ID "
    f"LEFT JOIN {S} s ON t.SUB_CATG_ID = s.SUB_CATG_ID GROUP BY ALL ORDER BY 1, 4, 5, 6, 7"
)
PER_CARD = (
    f"SELECT count(*) AS CNT, t.CARD_ID, LAST_4, BANK_NAME FROM {T} t JOIN {K} k ON k.CARD_ID = t.CARD_ID "
    f"JOIN {B} b ON b.BANK_ID = k.BANK_ID GROUP BY ALL ORDER BY 2, 3, 4"
)


def reporting_per_card():
    return (
        f"SELECT count(*) AS CNT, CARD_ID, min(BANK_NAME) AS BANK_NAME FROM ({reporting_sql()}) r JOIN {B} b ON b.BANK_ID = r.BANK_ID "
        "GROUP BY CARD_ID, upper(BANK_NAME) ORDER BY 2, 3"
    )


def reconciliation():
    rows = reporting_sql(skip=("CITI",))
    return (
        f"WITH r AS ({rows}), t AS (SELECT TRANSACTION_ID FROM {T} t) SELECT (SELECT count(*) FROM r) AS REPORTING_ROWS, "
        "(SELECT count(*) FROM t) AS TRANSACTION_ROWS, (SELECT count(*) FROM t WHERE TRANSACTION_ID NOT IN "
        "(SELECT TRANSACTION_ID FROM r)) AS MISSING_ROWS"
    )


RECENT = f"SELECT * FROM {T} t ORDER BY ADDED_DATETIME DESC, TRANSACTION_ID"
DISTINCT_CATEGORIES = f"SELECT min(CATEGORY) AS CATEGORY FROM {landing('AMEX')} l GROUP BY upper(CATEGORY)"


ACCENTED = (
    "SELECT min(CATEGORY) AS CATEGORY, count(*) AS CNT, CAST(sum(length(DESCRIPTION)) AS BIGINT) AS N_CHARS FROM ("
    "SELECT DESCRIPTION, CASE WHEN length(DESCRIPTION) % 2 = 1 THEN translate(CATEGORY, 'AEIOUaeiou', 'ÁÈÎÕÜáèîõü') ELSE CATEGORY END AS CATEGORY "
    f"FROM {landing('AMEX')} l) x GROUP BY strip_accents(upper(CATEGORY))"
)


def food():
    return (
        f"SELECT {_AMOUNT} AS TOTAL_SPENT FROM ({reporting_sql()}) r WHERE TRANSACTION_TYPE = 'DBT' AND "
        "(lower(CATG_NAME) LIKE '%food%' OR lower(SUB_CATG_NAME) LIKE '%restaurant%' OR lower(SUB_CATG_NAME) LIKE '%dining%') "
        "AND TRANSACTION_DATE >= DATE '2001-06-15' - INTERVAL 1 MONTH"
    )


def counterparty():
    return (
        f"SELECT {_AMOUNT} AS TOTAL_SPENT FROM ({reporting_sql()}) r WHERE TRANSACTION_TYPE = 'DBT' "
        "AND lower(ENTITY_NAME) LIKE '%amazon%'"
    )


def month_by_bank():
    return (
        f"SELECT min(BANK_NAME) AS BANK_NAME, {_AMOUNT} AS TOTAL_SPENT FROM ({reporting_sql()}) r JOIN {B} b USING (BANK_ID) "
        "WHERE TRANSACTION_TYPE = 'DBT' AND strftime(TRANSACTION_DATE, '%Y-%m') = '1998-03' GROUP BY upper(BANK_NAME) ORDER BY 1"
    )


def replaced():
    columns = ", ".join(REPORTING.columns)
    later = columns.replace("LAST_REFRESHED", "CAST('2025-02-01 00:00:00' AS TIMESTAMP) AS LAST_REFRESHED").replace(
        "GEOGRAPHY", "CAST(NULL AS VARCHAR) AS GEOGRAPHY"
    )
    return (
        f"WITH r AS ({reporting_sql()}), n AS (SELECT {later} FROM ({enrich_sql('APPLE')})) SELECT {columns} FROM n "
        f"UNION ALL SELECT {columns} FROM r WHERE TRANSACTION_ID NOT IN (SELECT TRANSACTION_ID FROM n)"
    )


def refreshed_late(late_from, bank_id):
    """All reporting rows; those of the bank's months that have a fact from ``late_from`` on bear the later time."""
    month = "year(TRANSACTION_DATE) * 100 + month(TRANSACTION_DATE)"
    columns = ", ".join(REPORTING.columns).replace(
        "LAST_REFRESHED", f"CASE WHEN BANK_ID = {bank_id} AND {month} IN (SELECT {month} FROM r WHERE BANK_ID = {bank_id} AND "
        f"TRANSACTION_DATE >= TIMESTAMP '{late_from}') THEN CAST('2026-02-01 00:00:00' AS TIMESTAMP) ELSE LAST_REFRESHED END AS LAST_REFRESHED"
    )
    return f"WITH r AS ({reporting_sql()}) SELECT {columns} FROM r"


def ignored():
    columns = ", ".join(REPORTING.columns)
    later = columns.replace("TRANSACTION_ID", "TRANSACTION_ID * 2 AS TRANSACTION_ID", 1)
    return (
        f"WITH r AS ({reporting_sql()}) SELECT {columns} FROM (SELECT {later} FROM ({enrich_sql('APPLE')})) "
        "WHERE TRANSACTION_ID NOT IN (SELECT TRANSACTION_ID FROM r)"
    )


STORED_IDS = f"SELECT TRANSACTION_ID FROM {T} x"


def cascaded():
    return f"SELECT * FROM ({reporting_sql()}) r WHERE TRANSACTION_TYPE = 'DBT'"


INSERT_MISSING = (
    "SELECT DISTINCT upper(trim(string_split(CATEGORY, '-')[1])) AS CATG_NAME FROM " + landing("AMEX")
    + f" l WHERE CATEGORY IS NOT NULL AND upper(trim(string_split(CATEGORY, '-')[1])) NOT IN (SELECT upper(CATG_NAME) FROM {C} c)"
)
RENAMED = (
    f"SELECT SUB_CATG_ID, CASE WHEN SUB_CATG_ID = 32 THEN 'CREDIT TO BANK' ELSE SUB_CATG_NAME END AS SUB_CATG_NAME, CATG_ID, "
    f"ADDED_USER, ADDED_DATETIME FROM {S} s"
)
SEEDED_ROW = (
    f"SELECT * FROM {C} c UNION ALL SELECT 0, 'CREDIT TO BANK', 'LOADER', CAST('2025-01-01 00:00:00' AS TIMESTAMP)"
)
TRUNCATED = f"SELECT 'before' AS STATE, count(*) AS N FROM {T} t UNION ALL SELECT 'after', 0"
MODIFIED = (
    "SELECT CARD_ID, CARD_TYPE, CAST(CAST(CARD_ID AS VARCHAR) AS VARCHAR) AS CARD_TEXT, LAST_4 FROM " + K + " k"
)
SPLIT = (
    "SELECT CATEGORY, trim(string_split(CATEGORY, '-')[1]) AS CATG, trim(string_split(CATEGORY, '-')[-1]) AS SUB_CATG FROM "
    + landing("AMEX") + " l"
)
_SEED = (
    "SELECT trim(string_split(CATEGORY, '-')[1]) AS CATG, trim(string_split(CATEGORY, '-')[-1]) AS SUB FROM "
    + landing("AMEX") + " l WHERE trim(coalesce(CATEGORY, '')) <> ''"
)
_STAMP = "'LOADER' AS ADDED_USER, CAST('2025-01-01 00:00:00' AS TIMESTAMP) AS ADDED_DATETIME"
SEED_CATEGORIES = (
    f"SELECT CAST((SELECT max(CATG_ID) FROM {C} c) + row_number() OVER (ORDER BY CATG_NAME) AS INTEGER) AS CATG_ID, CATG_NAME, "
    f"{_STAMP} FROM (SELECT min(CATG) AS CATG_NAME FROM ({_SEED}) GROUP BY upper(CATG))"
)
SEED_SUB_CATEGORIES = (
    f"SELECT CAST((SELECT max(SUB_CATG_ID) FROM {S} s) + row_number() OVER (ORDER BY CATG_ID, SUB_CATG_NAME) AS INTEGER) "
    f"AS SUB_CATG_ID, SUB_CATG_NAME, CATG_ID, {_STAMP} FROM (SELECT min(SUB) AS SUB_CATG_NAME, CATG_ID "
    f"FROM ({_SEED}) JOIN (SELECT CATG_ID, CASE WHEN CATG_ID = 1 THEN 'AUTOMOBILE' ELSE CATG_NAME END AS CATG_NAME FROM {C} c) "
    "c ON upper(CATG_NAME) = upper(CATG) GROUP BY upper(CATG), upper(SUB), CATG_ID)"
)


def legacy():
    spent = "TRY_CAST(AMOUNT AS DECIMAL(30,0)) >= 0"
    first = f"upper(CASE WHEN {spent} THEN trim(string_split(CATEGORY, '-')[1]) ELSE 'CREDIT TO BANK' END)"
    last = f"upper(CASE WHEN {spent} THEN trim(string_split(CATEGORY, '-')[-1]) ELSE 'CREDIT TO BANK' END)"
    return (
        "SELECT TRY_CAST(substr(REFERENCE, 2) AS DECIMAL(30,0)) AS TRANSACTION_ID, try_strptime(TRANSACTION_DATE, '%m/%d/%Y') AS DT, "
        f"CASE WHEN {spent} THEN 'DBT' ELSE 'CDT' END AS TRANSACTION_TYPE, TRY_CAST(AMOUNT AS DECIMAL(19,4)) AS AMOUNT, DESCRIPTION, "
        "coalesce(EXT_DETAILS, '') || ' statement: ' || coalesce(STATEMENT_DESC, '') AS EXT_DESCRIPTION, ADDRESS, "
        "trim(left(CITY_STATE, length(CITY_STATE) - 3)) AS CITY, right(CITY_STATE, 2) AS STATE, COUNTRY, ZIPCODE, CATG_ID, "
        f"SUB_CATG_ID, (SELECT min(MEMBER_ID) FROM {M} m WHERE FIRST_NAME = 'Customer#000000001') AS MEMBER_ID, "
        f"(SELECT min(BANK_ID) FROM {B} b WHERE BANK_NAME = 'American Express') AS BANK_ID, "
        f"(SELECT min(CARD_ID) FROM {K} k WHERE LAST_4 = '0001') AS CARD_ID, {_STAMP} FROM {landing('AMEX')} l "
        f"LEFT JOIN {C} c ON upper(CATG_NAME) = {first} LEFT JOIN (SELECT SUB_CATG_ID, SUB_CATG_NAME FROM {S} s) s "
        f"ON upper(SUB_CATG_NAME) = {last}"
    )


QUALITY_TABLES = list(TABLES)


def _rows(name):
    if name == "TRANSACTION_REPORTING":
        return f"({reporting_sql()})"
    return landing("AMEX") if name == "LND_TRANSACTIONS" else table(name)


def quality():
    lines = []

    def line(name, check, detail, expression):
        lines.append(
            f"SELECT {quote(name)} AS TABLE_NAME, {quote(check)} AS CHECK_NAME, {quote(detail)} AS DETAIL, "
            f"CAST({expression} AS BIGINT) AS BAD_ROWS"
        )

    for name in QUALITY_TABLES:
        t = TABLES[name]
        for c in t.required:
            line(name, "not null", c, f"(SELECT count(*) FROM {name}_ x WHERE {c} IS NULL)")
        for c, n in t.lengths.items():
            line(name, "length", c, f"(SELECT count(*) FROM {name}_ x WHERE length({c}) > {n})")
        key = ", ".join(t.key)
        if key:
            line(name, "key", ",".join(t.key),
                 f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {name}_)) FROM {name}_)")
        for c, (parent, pc) in t.foreign.items():
            line(name, "reference", f"{c} -> {parent}",
                 f"(SELECT count(*) FROM {name}_ x WHERE {c} NOT IN (SELECT {pc} FROM {parent}_))")
    ctes = ", ".join(f"{n}_ AS (SELECT * FROM {_rows(n)} x)" for n in QUALITY_TABLES)
    return f"WITH {ctes} " + " UNION ALL ".join(lines)


DUPLICATE_REFERENCES = (
    f"SELECT REFERENCE, count(*) AS CNT FROM {landing('AMEX')} l GROUP BY 1 HAVING count(*) > 1"
)
ORPHANS = (
    f"SELECT SUB_CATG_ID, count(*) AS CNT FROM {T} t WHERE SUB_CATG_ID NOT IN (SELECT SUB_CATG_ID FROM {S} s) GROUP BY 1"
)
TOO_LONG = f"SELECT * FROM {landing('APPLE')} l WHERE length(DESCRIPTION) > 100"
CUT = "SELECT left(DESCRIPTION, 100) AS DESCRIPTION, left(CATEGORY, 150) AS CATEGORY FROM " + landing("APPLE") + " l"
SAMPLES = (
    f"SELECT min(DESCRIPTION) AS VALUE FROM {T} t WHERE DESCRIPTION IS NOT NULL GROUP BY upper(DESCRIPTION) "
    f"ORDER BY upper(DESCRIPTION) LIMIT {SAMPLE_SIZE}"
)
LATEST_LOG = (
    f"SELECT * FROM {table('ETL_LOG')} l QUALIFY row_number() OVER (PARTITION BY LOG_ID ORDER BY END_TIME DESC NULLS LAST) = 1"
)
LANDING_CSV = f"SELECT * REPLACE (nullif(DEBIT, '') AS DEBIT, nullif(CREDIT, '') AS CREDIT) FROM {landing('CITI')} l"


def profile():
    parts, ctes = [], []
    for name in QUALITY_TABLES:
        t = TABLES[name]
        ctes.append(f"{name}_ AS (SELECT * FROM {_rows(name)} x)")
        for i, f in enumerate(t.schema, start=1):
            samples = "CAST(NULL AS VARCHAR)"
            if any(p in f.name for p in SAMPLED_NAMES):
                samples = (
                    f"(SELECT string_agg(v, ', ' ORDER BY upper(v)) FROM (SELECT min(CAST({f.name} AS VARCHAR)) AS v FROM {name}_ "
                    f"WHERE {f.name} IS NOT NULL GROUP BY upper(CAST({f.name} AS VARCHAR)) ORDER BY upper(v) LIMIT {SAMPLE_SIZE}))"
                )
            parts.append(
                f"SELECT {quote(name)} AS TABLE_NAME, CAST({i} AS INTEGER) AS POSITION, {quote(f.name)} AS FIELD, "
                f"{quote(f.dataType.simpleString())} AS TYPE, {quote('YES' if f.nullable else 'NO')} AS NULLABLE, "
                f"{quote('PRI' if f.name in t.key else '')} AS COLUMN_KEY, {samples} AS SAMPLES"
            )
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)


READ_ONLY = f"SELECT BANK_ID, count(*) AS CNT, {_AMOUNT} AS TOTAL FROM {T} t GROUP BY BANK_ID"


def text_functions():
    d = "DESCRIPTION"
    return (
        f"SELECT TRANSACTION_ID, string_split({d}, '/')[least(2, len(string_split({d}, '/')))] AS second_field, "
        f"string_split({d}, ' ')[-1] AS last_word, CAST(strlen({d}) AS INTEGER) AS byte_size, "
        f"CAST(strpos({d}, ' ') AS INTEGER) AS space_at, right({d}, 4) AS last_four, trim({d}, '/') AS no_slashes, "
        f"replace(replace({d}, 'A', 'E'), 'TST* ', '') AS replaced, concat_ws(' ', EXT_DESCRIPTION, ZIPCODE) AS joined, "
        f"EXT_DESCRIPTION || ZIPCODE AS strict_joined, regexp_replace({d}, '[0-9]+', '#', 'g') AS masked, "
        f"nullif(regexp_extract({d}, '[0-9]{{10,}}', 0), '') AS long_number, "
        f"CAST(TRANSACTION_AMOUNT AS DECIMAL(30,0)) AS whole, "
        "regexp_replace(regexp_replace(CAST(TRANSACTION_AMOUNT AS VARCHAR), '0+$', ''), '\\.$', '') AS plain_amount, "
        "strftime(TRANSACTION_DATE, '%Y-%m') AS month, strftime(TRANSACTION_DATE, '%Y-%m-01') AS month_start, "
        "coalesce(EXT_DESCRIPTION, 'none') AS filled, nullif(TRANSACTION_TYPE, 'CDT') AS debit_only, "
        "CAST(CASE WHEN h > 9223372036854775807 THEN 18446744073709551616 - h ELSE h END AS BIGINT) AS hashed "
        f"FROM (SELECT *, CAST(CAST('0x' || substr(md5({d} || ZIPCODE), 1, 16) AS UBIGINT) AS HUGEINT) AS h FROM {T} t)"
    )


def global_rank():
    return (
        f"SELECT TRANSACTION_ID, row_number() OVER (ORDER BY TRANSACTION_DATE, DESCRIPTION, TRANSACTION_ID) AS RANK FROM {T} t"
    )
