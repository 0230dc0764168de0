"""Checking SQL for the statement loads."""

from __future__ import annotations

from ledgerloom.operators import loaders as fixed
from ledgerloom.schemas import LANDING, TRANSACTIONS
from oracles.sqltext import landing, quote, table

_NUM = "TRY_CAST({} AS DECIMAL({},{}))"


def num(col, p=19, s=4):
    return _NUM.format(col, p, s)


def up(col):
    return f"upper({col})"


def has(col, *words):
    return "(" + " OR ".join(f"coalesce(contains(upper({col}), {quote(w)}), false)" for w in words) + ")"


def us(col):
    return f"try_strptime({col}, '%m/%d/%Y')"


def either(col):
    return f"CASE WHEN contains({col}, '-') THEN try_strptime({col}, '%d-%m-%Y') ELSE {us(col)} END"


def card(payment, refund, name, sub):
    first = f"WHEN {payment} THEN {quote(fixed.PAYMENT_NAME)} WHEN {refund} THEN {quote(fixed.REFUND_NAME)}"
    return f"CASE {first} ELSE {name} END", f"CASE {first} ELSE {sub} END"


_BLANK_DEBIT = "coalesce(trim(DEBIT), '') = ''"
_WF_AMOUNT = num("replace(replace(AMOUNT, '\"', ''), ',', '')")
_WF_TEXT = "replace(DESCRIPTION, '\"', '')"
_WF_TYPE = f"CASE WHEN {_WF_AMOUNT} > 0 THEN 'CDT' ELSE 'DBT' END"
_PLAIN = f"regexp_replace(regexp_replace(CAST(abs({_WF_AMOUNT}) AS VARCHAR), '0+$', ''), '\\.$', '')"


def _words(rules, ends):
    arms = "".join(f" WHEN {has('DESCRIPTION', *w)} THEN {quote(n)}" for w, n in rules)
    return f"CASE{arms} WHEN {_WF_AMOUNT} > 0 THEN {quote(ends[0])} ELSE {quote(ends[1])} END"


def _below():
    return f"NOT coalesce({num('AMOUNT', 30, 2)} >= 0, false)"


def _spec(bank):
    catg_upper = "upper(trim(CATEGORY))"
    name = quote(fixed.PURCHASE_NAMES.get(bank, ""))
    if bank == "AMEX":
        catg, sub = card(
            f"{_below()} AND {has('DESCRIPTION', 'PAYMENT')}", _below(),
            "upper(trim(string_split(CATEGORY, '-')[1]))", "upper(trim(string_split(CATEGORY, '-')[-1]))",
        )
        return {
            "ref": "TRY_CAST(substr(REFERENCE, 2) AS BIGINT)", "date": us("TRANSACTION_DATE"),
            "type": f"CASE WHEN {num('AMOUNT', 30, 2)} >= 0 THEN 'DBT' ELSE 'CDT' END",
            "amount": f"abs({num('AMOUNT')})", "text": "DESCRIPTION", "catg": catg, "sub": sub,
            "flag_c": "CATEGORY IS NOT NULL", "flag_s": "CATEGORY IS NOT NULL",
            "EXT_DESCRIPTION": "upper(coalesce(EXT_DETAILS, '') || ' STATEMENT: ' || coalesce(STATEMENT_DESC, ''))",
            "ADDRESS_1": "upper(ADDRESS)", "CITY": "upper(trim(left(CITY_STATE, length(CITY_STATE) - 3)))",
            "STATE": "upper(right(CITY_STATE, 2))", "COUNTRY": "upper(COUNTRY)", "ZIPCODE": "ZIPCODE",
        }
    if bank in ("APPLE", "DISCOVER"):
        if bank == "APPLE":
            is_pay, is_ref = (f"upper(STATEMENT_DESC) = '{w}'" for w in ("PAYMENT", "CREDIT"))
            catg, sub = card(is_pay, is_ref, name, catg_upper)
            rest = {"type": f"CASE WHEN {is_pay} OR {is_ref} THEN 'CDT' ELSE 'DBT' END",
                    "flag_s": f"CATEGORY IS NOT NULL OR {is_pay} OR {is_ref}"}
        else:
            catg, sub = card(f"{_below()} AND {has('DESCRIPTION', 'PAYMENT')}", _below(), name, catg_upper)
            rest = {"type": f"CASE WHEN {num('AMOUNT', 30, 2)} > 0 THEN 'DBT' ELSE 'CDT' END",
                    "flag_s": f"CATEGORY IS NOT NULL OR {has('DESCRIPTION', 'PAYMENT')}",
                    "EXT_DESCRIPTION": "upper(CATEGORY)", "COUNTRY": "'US'"}
        parts = ["TRANSACTION_DATE", "AMOUNT", "DESCRIPTION"]
        return {"order": parts, "parts": parts, "date": us("TRANSACTION_DATE"), "posted": us("POSTED_DATE"),
                "amount": f"abs({num('AMOUNT')})", "text": "DESCRIPTION", "catg": catg, "sub": sub, **rest}
    if bank == "AXIS":
        kind = f"CASE WHEN {_BLANK_DEBIT} THEN 'CDT' ELSE 'DBT' END"
        return {
            "order": ["TRANSACTION_DATE", "DEBIT", "CREDIT", "STATEMENT_DESC"],
            "parts": ["trim(TRANSACTION_DATE)", kind, "coalesce(trim(DEBIT), '')", "coalesce(trim(CREDIT), '')",
                      "coalesce(STATEMENT_DESC, '')"],
            "date": either("TRANSACTION_DATE"), "variant": either("POSTED_DATE"), "type": kind,
            "amount": f"CASE WHEN {_BLANK_DEBIT} THEN {num('CREDIT')} ELSE {num('DEBIT')} END",
            "text": "STATEMENT_DESC",
            "catg": f"CASE WHEN {_BLANK_DEBIT} THEN {quote(fixed.AXIS_NAMES['credit'])} "
                    f"ELSE {quote(fixed.AXIS_NAMES['debit'])} END",
            "sub": f"CASE WHEN {_BLANK_DEBIT} THEN {quote(fixed.AXIS_NAMES['credit_sub'])} "
                   f"ELSE coalesce({catg_upper}, {quote(fixed.NO_CATEGORY)}) END",
        }
    if bank == "CAPITALONE":
        pay, refund = has("DESCRIPTION", "PYMT"), "(coalesce(DEBIT, '') = '' AND coalesce(CREDIT, '') <> '')"
        catg, sub = card(pay, refund, name, catg_upper)
        parts = ["TRANSACTION_DATE", "coalesce(DEBIT, '')", "coalesce(CREDIT, '')", "DESCRIPTION"]
        return {
            "order": parts, "parts": parts, "date": "try_strptime(TRANSACTION_DATE, '%Y-%m-%d')",
            "posted": "try_strptime(POSTED_DATE, '%Y-%m-%d')",
            "type": f"CASE WHEN {pay} OR {refund} THEN 'CDT' ELSE 'DBT' END",
            "amount": f"CASE WHEN {pay} OR {refund} THEN {num('CREDIT')} ELSE {num('DEBIT')} END",
            "text": "DESCRIPTION", "catg": catg, "sub": sub, "flag_s": f"CATEGORY IS NOT NULL OR {pay}",
        }
    if bank == "CITI":
        paid = has("DESCRIPTION", "PAYMENT")
        catg, sub = card(
            f"CREDIT IS NOT NULL AND {paid}", f"CREDIT IS NOT NULL AND DESCRIPTION IS NOT NULL AND NOT {paid}", name,
            f"coalesce({catg_upper}, {quote(fixed.NO_CATEGORY)})",
        )
        parts = ["TRANSACTION_DATE", "coalesce(DEBIT, '0')", "coalesce(CREDIT, '0')", "DESCRIPTION"]
        full = "coalesce(CREDIT, '') <> ''"
        return {
            "order": parts, "parts": parts, "date": us("TRANSACTION_DATE"), "variant": us("POSTED_DATE"),
            "type": f"CASE WHEN {full} THEN 'CDT' ELSE 'DBT' END",
            "amount": f"abs(CASE WHEN {full} THEN {num('CREDIT')} ELSE {num('DEBIT')} END)",
            "text": "DESCRIPTION", "catg": catg, "sub": sub,
        }
    return {
        "order": ["TRANSACTION_DATE", "AMOUNT", "DESCRIPTION"],
        "parts": ["trim(replace(TRANSACTION_DATE, '\"', ''))", _WF_TYPE, _PLAIN, f"trim({_WF_TEXT})"],
        "date": either("replace(TRANSACTION_DATE, '\"', '')"), "variant": either("replace(POSTED_DATE, '\"', '')"),
        "type": _WF_TYPE, "amount": f"abs({_WF_AMOUNT})", "text": _WF_TEXT,
        "catg": _words(fixed.WELLSFARGO_CATEGORIES, fixed.WELLSFARGO_CATEGORY_ENDS),
        "sub": _words(fixed.WELLSFARGO_SUB_CATEGORIES, fixed.WELLSFARGO_SUB_ENDS),
    }


def _id(parts):
    text = " || ".join(parts)
    number = f"CAST(CAST('0x' || substr(md5({text} || CAST(rk AS VARCHAR)), 1, 16) AS UBIGINT) AS HUGEINT)"
    return f"CAST(CASE WHEN {number} > 9223372036854775807 THEN 18446744073709551616 - {number} ELSE {number} END AS BIGINT)"


def _ctes(bank, posted=False, occurrence=False):
    spec = _spec(bank)
    content = "md5(concat_ws(chr(1), " + ", ".join(f"coalesce({c}, chr(2))" for c in LANDING.columns) + "))"
    rank = "0"
    if "order" in spec:
        rank = "row_number() OVER (ORDER BY " + ", ".join(f"{o} NULLS FIRST" for o in [*spec["order"], content]) + ")"
        if occurrence:
            rank = f"row_number() OVER (PARTITION BY {' || '.join(spec['parts'])} ORDER BY {content})"
    made = _id(spec["parts"]) if "parts" in spec else spec["ref"]
    posted_date = spec.get("posted") or (spec.get("variant") if posted else None) or "CAST(NULL AS TIMESTAMP)"
    return f"""
WITH cat AS (SELECT * FROM {table('MCC_CATEGORY')}), sub AS (SELECT * FROM {table('MCC_SUB_CATEGORY')}),
numbered AS (SELECT *, {rank} AS rk FROM {landing(bank)} l),
typed AS (SELECT *, {made} AS id, {spec['date']} AS dt, {posted_date} AS pd, {spec['type']} AS ty, {spec['amount']} AS am,
          {spec['catg']} AS cn, {spec['sub']} AS sn, {spec.get('flag_c', 'true')} AS fc, {spec.get('flag_s', 'true')} AS fs
          FROM numbered),
newc AS (SELECT cn AS CATG_NAME, CAST((SELECT max(CATG_ID) FROM cat) + row_number() OVER (ORDER BY cn) AS INTEGER) AS CATG_ID
         FROM (SELECT DISTINCT cn FROM typed WHERE fc AND cn IS NOT NULL
               AND upper(cn) NOT IN (SELECT upper(CATG_NAME) FROM cat))),
ci AS (SELECT upper(CATG_NAME) AS ck, min(CATG_ID) AS CATG_ID
       FROM (SELECT CATG_NAME, CATG_ID FROM cat UNION ALL SELECT CATG_NAME, CATG_ID FROM newc) GROUP BY 1),
wanted AS (SELECT DISTINCT sn, CATG_ID FROM typed JOIN ci ON ck = upper(cn) WHERE fs AND sn IS NOT NULL),
news AS (SELECT sn AS SUB_CATG_NAME, CATG_ID,
                CAST((SELECT max(SUB_CATG_ID) FROM sub) + row_number() OVER (ORDER BY CATG_ID, sn) AS INTEGER) AS SUB_CATG_ID
         FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM sub WHERE upper(sub.SUB_CATG_NAME) = upper(w.sn)
                                         AND sub.CATG_ID = w.CATG_ID)),
si AS (SELECT upper(SUB_CATG_NAME) AS sk, CATG_ID, min(SUB_CATG_ID) AS SUB_CATG_ID FROM
       (SELECT SUB_CATG_NAME, CATG_ID, SUB_CATG_ID FROM sub UNION ALL SELECT SUB_CATG_NAME, CATG_ID, SUB_CATG_ID FROM news)
       GROUP BY 1, 2),
judged AS (SELECT typed.*, ci.CATG_ID, si.SUB_CATG_ID FROM typed LEFT JOIN ci ON ck = upper(cn)
           LEFT JOIN si ON sk = upper(sn) AND si.CATG_ID = ci.CATG_ID)
""", spec


_AUDIT = "'SYSTEM_AUTO' AS ADDED_USER, CAST('2025-01-01 00:00:00' AS TIMESTAMP) AS ADDED_DATETIME"


def categories_sql(bank):
    return _ctes(bank)[0] + f"SELECT CATG_ID, CATG_NAME, {_AUDIT} FROM newc"


def sub_categories_sql(bank):
    return _ctes(bank)[0] + f"SELECT SUB_CATG_ID, SUB_CATG_NAME, CATG_ID, {_AUDIT} FROM news"


_BAD = {
    "no usable id": "id IS NULL", "no usable date": "dt IS NULL", "no usable amount": "am IS NULL",
    "no category": "CATG_ID IS NULL", "no sub-category": "SUB_CATG_ID IS NULL",
}


def rejects_sql(bank):
    arms = "WHEN REFERENCE IS NULL THEN 'no reference' " if bank == "AMEX" else ""
    arms += " ".join(f"WHEN {t} THEN {quote(r)}" for r, t in _BAD.items())
    columns = ", ".join(LANDING.columns)
    return _ctes(bank)[0] + f"SELECT * FROM (SELECT {columns}, CASE {arms} END AS REASON FROM judged) WHERE REASON IS NOT NULL"


def load_sql(bank, owner, posted=False, existing=None, occurrence=False):
    """``owner`` holds the ids of member, bank and card; ``existing`` a query with the ids already stored."""
    ctes, spec = _ctes(bank, posted, occurrence)
    given = {
        "TRANSACTION_ID": "id", "TRANSACTION_DATE": "dt", "POSTED_DATE": "pd", "TRANSACTION_TYPE": "ty",
        "TRANSACTION_AMOUNT": "am", "DESCRIPTION": f"coalesce(upper({spec['text']}), '')", "CATG_ID": "CATG_ID",
        "SUB_CATG_ID": "SUB_CATG_ID", "ADDED_USER": "'LOADER'",
        "ADDED_DATETIME": "CAST('2025-01-01 00:00:00' AS TIMESTAMP)",
        **{k: f"({v})" for k, v in owner.items()}, **{k: v for k, v in spec.items() if k.isupper()},
    }
    columns = []
    for f in TRANSACTIONS.schema:
        value = given.get(f.name, "CAST(NULL AS VARCHAR)")
        if f.name in TRANSACTIONS.lengths and f.name in given:
            value = f"left({value}, {TRANSACTIONS.lengths[f.name]})"
        columns.append(f"{value} AS {f.name}")
    bad = " OR ".join(_BAD.values())
    known = f" AND id NOT IN ({existing})" if existing else ""
    return ctes + f"""
SELECT {', '.join(columns)} FROM judged WHERE NOT ({bad}){known}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY dt, am, upper({spec['text']}), pd NULLS FIRST, ty, ZIPCODE) = 1"""


def owner_sql(bank_name, user="Customer#000000001", last4="0001"):
    def low(name, key, column, value):
        return f"SELECT min({key}) FROM {table(name)} WHERE upper({column}) = {quote(value.upper())} AND IS_CURRENT = 1"

    return {
        "MEMBER_ID": low("MEMBERS", "MEMBER_ID", "FIRST_NAME", user),
        "BANK_ID": low("BANKS", "BANK_ID", "BANK_NAME", bank_name),
        "CARD_ID": low("CARDS", "CARD_ID", "LAST_4", last4),
    }
