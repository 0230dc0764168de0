"""Checking SQL for member onboarding; secrets are compared as plain text."""

from __future__ import annotations

from oracles.sqltext import table

_NOW = "CAST('2025-01-01 00:00:00' AS TIMESTAMP)"
_OPEN = (
    f"{_NOW} AS EFF_START_DATE, CAST('9999-12-31 23:59:59' AS TIMESTAMP) AS EFF_END_DATE, "
    "CAST(1 AS INTEGER) AS IS_CURRENT, 'ONBOARDING' AS ADDED_USER"
)


def _next(dim, column, order):
    return f"CAST((SELECT max({column}) FROM {dim}) + row_number() OVER (ORDER BY {order}) AS INTEGER) AS {column}"


CTES = f"""
WITH given AS (SELECT * REPLACE (left(ADDRESS_1, 150) AS ADDRESS_1) FROM {table('APPLICANTS')}),
app AS (SELECT * FROM given WHERE GENDER IS NOT NULL AND ZIPCODE IS NOT NULL), adr AS (SELECT * FROM {table('MEMBER_ADDRESS')}),
mem AS (SELECT * FROM {table('MEMBERS')}), bnk AS (SELECT * FROM {table('BANKS')}), crd AS (SELECT * FROM {table('CARDS')}),
adr_now AS (SELECT upper(ADDRESS_1) AS ak, upper(ZIPCODE) AS zk, min(ADDRESS_ID) AS ADDRESS_ID FROM adr
            WHERE IS_CURRENT = 1 GROUP BY 1, 2),
adr_new AS (SELECT *, {_next('adr', 'ADDRESS_ID', 'APPLICANT_NO')}, {_next('adr', 'ADDRESS_KEY', 'APPLICANT_NO')}
            FROM (SELECT *, upper(ADDRESS_1) AS ak, upper(ZIPCODE) AS zk FROM app
                  QUALIFY row_number() OVER (PARTITION BY upper(ADDRESS_1), upper(ZIPCODE) ORDER BY APPLICANT_NO) = 1) a
            WHERE NOT EXISTS (SELECT 1 FROM adr_now n WHERE n.ak = a.ak AND n.zk = a.zk)),
adr_all AS (SELECT ak, zk, ADDRESS_ID FROM adr_now UNION ALL SELECT ak, zk, ADDRESS_ID FROM adr_new),
bnk_now AS (SELECT upper(BANK_NAME) AS bk, upper(ACCOUNT_TYPE) AS tk, min(BANK_ID) AS BANK_ID FROM bnk
            WHERE IS_CURRENT = 1 GROUP BY 1, 2),
bnk_new AS (SELECT *, {_next('bnk', 'BANK_ID', 'APPLICANT_NO')}, {_next('bnk', 'BANK_KEY', 'APPLICANT_NO')}
            FROM (SELECT *, upper(BANK_NAME) AS bk, upper(ACCOUNT_TYPE) AS tk FROM app
                  QUALIFY row_number() OVER (PARTITION BY upper(BANK_NAME), upper(ACCOUNT_TYPE) ORDER BY APPLICANT_NO) = 1) a
            WHERE NOT EXISTS (SELECT 1 FROM bnk_now n WHERE n.bk = a.bk AND n.tk = a.tk)),
bnk_all AS (SELECT bk, tk, BANK_ID FROM bnk_now UNION ALL SELECT bk, tk, BANK_ID FROM bnk_new),
known AS (SELECT upper(FIRST_NAME) AS fk, upper(LAST_NAME) AS lk, min(MEMBER_ID) AS kid, arg_min(MEMBER_KEY, MEMBER_ID) AS kkey,
                 arg_min(ADDRESS_ID, MEMBER_ID) AS kadr FROM mem WHERE IS_CURRENT = 1 GROUP BY 1, 2),
visit AS (SELECT app.*, upper(FIRST_NAME) AS fk, upper(LAST_NAME) AS lk, a.ADDRESS_ID, b.BANK_ID, kid, kkey, kadr
          FROM app JOIN adr_all a ON a.ak = upper(ADDRESS_1) AND a.zk = upper(app.ZIPCODE)
          JOIN bnk_all b ON b.bk = upper(app.BANK_NAME) AND b.tk = upper(app.ACCOUNT_TYPE)
          LEFT JOIN known ON known.fk = upper(FIRST_NAME) AND known.lk = upper(LAST_NAME)),
walk AS (SELECT *, row_number() OVER w AS rn,
                ADDRESS_ID IS DISTINCT FROM (CASE WHEN row_number() OVER w = 1 THEN kadr ELSE lag(ADDRESS_ID) OVER w END) AS starts
         FROM visit WINDOW w AS (PARTITION BY fk, lk ORDER BY APPLICANT_NO)),
fresh_key AS (SELECT fk, lk, {_next('mem', 'MEMBER_KEY', 'APPLICANT_NO')} FROM walk WHERE rn = 1 AND kid IS NULL),
version AS (SELECT w.*, coalesce(f.MEMBER_KEY, kkey) AS MEMBER_KEY, {_next('mem', 'MEMBER_ID', 'APPLICANT_NO')},
                   lead(APPLICANT_NO) OVER (PARTITION BY w.fk, w.lk ORDER BY APPLICANT_NO) IS NOT NULL AS closed
            FROM walk w LEFT JOIN fresh_key f ON f.fk = w.fk AND f.lk = w.lk WHERE starts),
active AS (SELECT walk.*, coalesce(last_value(v.MEMBER_ID IGNORE NULLS) OVER (
                      PARTITION BY walk.fk, walk.lk ORDER BY walk.APPLICANT_NO), kid) AS MEMBER_ID, right(walk.CARD_NUMBER, 4) AS LAST_4
           FROM walk LEFT JOIN (SELECT APPLICANT_NO, MEMBER_ID FROM version) v ON v.APPLICANT_NO = walk.APPLICANT_NO),
card_new AS (SELECT *, {_next('crd', 'CARD_ID', 'APPLICANT_NO')}, {_next('crd', 'CARD_KEY', 'APPLICANT_NO')}
             FROM (SELECT * FROM active
                   QUALIFY row_number() OVER (PARTITION BY LAST_4, MEMBER_ID ORDER BY APPLICANT_NO) = 1) a
             WHERE NOT EXISTS (SELECT 1 FROM crd WHERE crd.IS_CURRENT = 1 AND crd.LAST_4 = a.LAST_4
                               AND crd.MEMBER_ID = a.MEMBER_ID))
"""

ADDRESSES = CTES + (
    f"SELECT ADDRESS_ID, ADDRESS_KEY, ADDRESS_1, ADDRESS_2, CITY, STATE, ZIPCODE, {_OPEN} FROM adr_new"
)
BANKS = CTES + f"SELECT BANK_ID, BANK_KEY, BANK_NAME, ACCOUNT_TYPE, {_OPEN} FROM bnk_new"
_NEW_MEMBERS = f"""
SELECT MEMBER_ID, MEMBER_KEY, FIRST_NAME, CAST(NULL AS VARCHAR) AS MIDDLE_NAME, LAST_NAME, GENDER, DATE_OF_BIRTH,
       ADDRESS_ID, {_NOW} AS EFF_START_DATE,
       CASE WHEN closed THEN {_NOW} ELSE CAST('9999-12-31 23:59:59' AS TIMESTAMP) END AS EFF_END_DATE,
       CAST(CASE WHEN closed THEN 0 ELSE 1 END AS INTEGER) AS IS_CURRENT, 'ONBOARDING' AS ADDED_USER FROM version"""
MEMBERS_AFTER = CTES + f"""
SELECT MEMBER_ID, MEMBER_KEY, FIRST_NAME, MIDDLE_NAME, LAST_NAME, GENDER, CAST(NULL AS VARCHAR) AS DATE_OF_BIRTH, ADDRESS_ID,
       EFF_START_DATE, CASE WHEN ends THEN {_NOW} ELSE EFF_END_DATE END AS EFF_END_DATE,
       CAST(CASE WHEN ends THEN 0 ELSE IS_CURRENT END AS INTEGER) AS IS_CURRENT, ADDED_USER
FROM (SELECT mem.*, mem.MEMBER_ID IN (SELECT kid FROM version WHERE kid IS NOT NULL) AS ends FROM mem) m
UNION ALL {_NEW_MEMBERS}"""
CARDS = CTES + (
    "SELECT CARD_ID, CARD_KEY, CARD_TYPE, CARD_NUMBER, LAST_4, EXP_DATE, CVV, BANK_ID, MEMBER_ID, "
    f"{_OPEN} FROM card_new"
)
RESULTS = CTES + (
    "SELECT APPLICANT_NO, 'SUCCESS' AS STATUS, MEMBER_ID AS ACTIVE_MEMBER_ID, LAST_4 AS CARD_STORED FROM active "
    "UNION ALL SELECT APPLICANT_NO, 'FAILED', NULL, NULL FROM given WHERE GENDER IS NULL OR ZIPCODE IS NULL"
)
REJECTS = CTES + (
    "SELECT APPLICANT_NO, CASE WHEN GENDER IS NULL THEN 'no GENDER' ELSE 'no ZIPCODE' END AS REASON FROM given "
    "WHERE GENDER IS NULL OR ZIPCODE IS NULL"
)
