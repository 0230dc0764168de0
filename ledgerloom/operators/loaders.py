"""Statement loads: all-text landing rows to typed facts, with categories made on the way.

A bank is a ``Statement``: how its id, dates, type, amount and category names
follow from the landing columns.  One engine runs them all.  Reading rules:

* Hashed ids hold the row's rank in the whole statement, so the same purchase in
  a second, overlapping statement may get another id and load twice (kept: ids
  must equal those already stored).
* Axis and Capital One keep the sign of the amount, the others drop it.
* Discover calls a zero amount an expenditure but types it as money in.
* Citi takes any CREDIT that is not NULL as a credit for the category, but only
  a non-empty one for the type.
* Wells Fargo keywords match inside words (FEE in COFFEE, ATM in TREATMENT).
* Some banks leave rows without CATEGORY out of the category onboarding, so a
  payment can end without a category id; it is then rejected with that reason.
* A row the target could not hold (no id, date, amount or category) is not
  coerced to zeros but goes to ``rejects`` with a reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.ids import assign_identity, content_key, global_rank, hash_id, highest, lookups, occurrence
from ledgerloom.functions.text import (
    any_of, byte_length, clean_upper, date_text, filled, fold, from_position, moment, not_blank, number, same_name,
    plain_number_text,
)
from ledgerloom.operators.sinks import insert_ignore, insert_missing
from ledgerloom.schemas import CATEGORY, LANDING, SUB_CATEGORY, TRANSACTIONS
from ledgerloom.session import stage

# Type codes, category texts, date formats and key words.
DEBIT, CREDIT = "DBT", "CDT"
PAYMENT_NAME, REFUND_NAME = "CREDIT CARD PAYMENT", "MERCHANT REFUND"
NO_CATEGORY = "UNCATEGORIZED"
AUTO_USER = "SYSTEM_AUTO"
US_DATE, ISO_DATE, DAY_FIRST_DATE = "M/d/yyyy", "yyyy-M-d", "d-M-yyyy"
AXIS_NAMES = {"debit": "AXIS DEBIT", "credit": "AXIS CREDIT", "credit_sub": "CREDIT / REFUND"}
PURCHASE_NAMES = {
    "DISCOVER": "DISCOVER EXPENDITURE",
    "APPLE": "APPLE CARD EXPENDITURE",
    "CAPITALONE": "CAPITAL ONE EXPENDITURE",
    "CITI": "CITI EXPENDITURE",
}
WELLSFARGO_CATEGORIES = [
    (["ATM", "CASH WDL"], "CASH & ATM"),
    (["TRANSFER", "XFER"], "TRANSFERS"),
    (["SERVICE CHG", "FEE"], "BANK FEES"),
]
WELLSFARGO_CATEGORY_ENDS = ("INCOME & DEPOSITS", "DEBIT CARD PURCHASE")
WELLSFARGO_SUB_CATEGORIES = [
    (["ATM"], "ATM WITHDRAWAL"),
    (["CASH WDL"], "TELLER WITHDRAWAL"),
    (["TRANSFER", "XFER"], "ACCOUNT TRANSFER"),
    (["SERVICE CHG", "FEE"], "MONTHLY SERVICE FEE"),
]
WELLSFARGO_SUB_ENDS = ("DIRECT DEPOSIT / CREDIT", "GENERAL MERCHANDISE")


def c(name: str) -> Column:
    return F.col(name)


def _text(value: str) -> Column:
    return F.lit(value)


@dataclass(frozen=True)
class Statement:
    """What a bank's landing rows mean; every entry is a column expression.

    ``catg_key``/``sub_key`` name the category a fact belongs to; ``catg`` is
    the name used for onboarding where it differs.  ``onboard`` limits the rows
    that may add sub-categories, ``onboard_catg`` those that may add categories.
    """

    bank: str
    date: Column
    type: Column
    amount: Column
    description: Column
    catg_key: Column
    sub_key: Column
    rank_order: list[Column] = field(default_factory=list)
    id_parts: list[Column] = field(default_factory=list)
    reference: Column | None = None
    wanted: Column | None = None
    posted: Column | None = None
    variant_posted: Column | None = None
    catg: Column | None = None
    onboard_catg: Column | None = None
    onboard: Column | None = None
    extra: dict[str, Column] = field(default_factory=dict)


# Parsed once per row, as columns of their own; the statements below refer to them by name.
PARSED = {
    "_AMOUNT": lambda: number(c("AMOUNT"), 19, 4),
    "_AMOUNT_2": lambda: number(c("AMOUNT"), 30, 2),
    "_DEBIT": lambda: number(c("DEBIT"), 19, 4),
    "_CREDIT": lambda: number(c("CREDIT"), 19, 4),
    "_BARE_AMOUNT": lambda: number(F.replace(_unquoted(F.trim("AMOUNT")), _text(","), _text("")), 19, 4),
    "_FOLDED": lambda: F.upper("DESCRIPTION"),
    "_FOLDED_BARE": lambda: F.upper(_unquoted(c("DESCRIPTION"))),
}


def _unquoted(col: Column) -> Column:
    return F.replace(col, _text('"'), _text(""))


def holds(name: str, *words: str) -> Column:
    return any_of(c(name).contains(w) for w in words)


def _card_names(payment: Column, refund: Column, purchase: Column, purchase_sub: Column):
    """Category and sub-category of a card row: a payment, a refund, or a purchase."""
    kind = F.when(payment, PAYMENT_NAME).when(refund, REFUND_NAME)
    return F.coalesce(kind, purchase), F.coalesce(kind, purchase_sub)


def _signed_card(purchase, purchase_sub):
    """Names for statements that carry one signed amount: zero and above is a purchase."""
    below = ~F.coalesce(c("_AMOUNT_2") >= 0, F.lit(False))
    paid = F.coalesce(holds("_FOLDED", "PAYMENT"), F.lit(False))
    return _card_names(below & paid, below, purchase, purchase_sub)


def _either_date(col: Column) -> Column:
    """Day first where the text holds a dash, else month first."""
    text = F.trim(col)
    return F.when(col.contains("-"), date_text(text, DAY_FIRST_DATE)).otherwise(date_text(text, US_DATE))


def _amex() -> Statement:
    first, last = (clean_upper(F.substring_index(c("CATEGORY"), "-", n)) for n in (1, -1))
    catg, sub = _signed_card(first, last)
    place, size = c("CITY_STATE"), byte_length(c("CITY_STATE"))
    details, statement = (F.coalesce(c(n), _text("")) for n in ("EXT_DETAILS", "STATEMENT_DESC"))
    return Statement(
        "AMEX",
        reference=number(F.substring(c("REFERENCE"), 2, 2**31 - 1), 30, 0).try_cast("long"),
        wanted=c("REFERENCE").isNotNull(),
        date=date_text(c("TRANSACTION_DATE"), US_DATE),
        type=F.when(c("_AMOUNT_2") >= 0, DEBIT).otherwise(CREDIT),
        amount=F.abs(c("_AMOUNT")),
        description=c("DESCRIPTION"),
        catg_key=catg, sub_key=sub,
        onboard_catg=c("CATEGORY").isNotNull(), onboard=c("CATEGORY").isNotNull(),
        extra={
            "EXT_DESCRIPTION": F.upper(F.concat_ws(" ", details, _text("STATEMENT:"), statement)),
            "ADDRESS_1": F.upper("ADDRESS"),
            "CITY": clean_upper(F.substring(place, F.lit(1), size - 3)),
            "STATE": clean_upper(from_position(place, size - 1)),
            "COUNTRY": F.upper("COUNTRY"),
            "ZIPCODE": c("ZIPCODE"),
        },
    )


def _apple() -> Statement:
    said = F.upper("STATEMENT_DESC")
    catg, sub = _card_names(
        said == "PAYMENT", said == "CREDIT", _text(PURCHASE_NAMES["APPLE"]), clean_upper(c("CATEGORY"))
    )
    credit = F.coalesce(said.isin("PAYMENT", "CREDIT"), F.lit(False))
    order = [c("TRANSACTION_DATE"), c("AMOUNT"), c("DESCRIPTION")]
    return Statement(
        "APPLE",
        rank_order=order, id_parts=order,
        date=date_text(c("TRANSACTION_DATE"), US_DATE), posted=date_text(c("POSTED_DATE"), US_DATE),
        type=F.when(credit, CREDIT).otherwise(DEBIT),
        amount=F.abs(c("_AMOUNT")),
        description=c("DESCRIPTION"),
        catg_key=catg, sub_key=sub,
        onboard=c("CATEGORY").isNotNull() | credit,
    )


def _axis() -> Statement:
    spent = not_blank(c("DEBIT"))
    kind = F.when(spent, DEBIT).otherwise(CREDIT)
    blank = _text("")
    return Statement(
        "AXIS",
        rank_order=[c("TRANSACTION_DATE"), c("DEBIT"), c("CREDIT"), c("STATEMENT_DESC")],
        id_parts=[
            F.trim("TRANSACTION_DATE"), kind, F.coalesce(F.trim("DEBIT"), blank),
            F.coalesce(F.trim("CREDIT"), blank), F.coalesce(c("STATEMENT_DESC"), blank),
        ],
        date=_either_date(c("TRANSACTION_DATE")), variant_posted=_either_date(c("POSTED_DATE")),
        type=kind,
        amount=F.when(spent, c("_DEBIT")).otherwise(c("_CREDIT")),
        description=c("STATEMENT_DESC"),
        catg_key=F.when(spent, AXIS_NAMES["debit"]).otherwise(AXIS_NAMES["credit"]),
        sub_key=F.when(spent, clean_upper(F.coalesce(c("CATEGORY"), _text(NO_CATEGORY)))).otherwise(
            AXIS_NAMES["credit_sub"]
        ),
    )


def _capitalone() -> Statement:
    payment = F.coalesce(holds("_FOLDED", "PYMT"), F.lit(False))
    refund = ~filled(c("DEBIT")) & filled(c("CREDIT"))
    catg, sub = _card_names(payment, refund, _text(PURCHASE_NAMES["CAPITALONE"]), clean_upper(c("CATEGORY")))
    parts = [
        c("TRANSACTION_DATE"), F.coalesce(c("DEBIT"), _text("")), F.coalesce(c("CREDIT"), _text("")), c("DESCRIPTION"),
    ]
    return Statement(
        "CAPITALONE",
        rank_order=parts, id_parts=parts,
        date=date_text(c("TRANSACTION_DATE"), ISO_DATE), posted=date_text(c("POSTED_DATE"), ISO_DATE),
        type=F.when(payment | refund, CREDIT).otherwise(DEBIT),
        amount=F.when(payment | refund, c("_CREDIT")).otherwise(c("_DEBIT")),
        description=c("DESCRIPTION"),
        catg_key=catg, sub_key=sub,
        onboard=c("CATEGORY").isNotNull() | payment,
    )


def _citi() -> Statement:
    credited = filled(c("CREDIT"))
    paid = holds("_FOLDED", "PAYMENT")
    given = c("CREDIT").isNotNull()
    catg, sub = _card_names(
        given & F.coalesce(paid, F.lit(False)), given & F.coalesce(~paid, F.lit(False)),
        _text(PURCHASE_NAMES["CITI"]), clean_upper(F.coalesce(c("CATEGORY"), _text(NO_CATEGORY))),
    )
    parts = [
        c("TRANSACTION_DATE"), F.coalesce(c("DEBIT"), _text("0")), F.coalesce(c("CREDIT"), _text("0")), c("DESCRIPTION"),
    ]
    return Statement(
        "CITI",
        rank_order=parts, id_parts=parts,
        date=date_text(c("TRANSACTION_DATE"), US_DATE), variant_posted=date_text(c("POSTED_DATE"), US_DATE),
        type=F.when(credited, CREDIT).otherwise(DEBIT),
        amount=F.abs(F.when(credited, c("_CREDIT")).otherwise(c("_DEBIT"))),
        description=c("DESCRIPTION"),
        catg_key=catg, sub_key=sub,
    )


def _discover() -> Statement:
    catg, sub = _signed_card(_text(PURCHASE_NAMES["DISCOVER"]), clean_upper(c("CATEGORY")))
    order = [c("TRANSACTION_DATE"), c("AMOUNT"), c("DESCRIPTION")]
    return Statement(
        "DISCOVER",
        rank_order=order, id_parts=order,
        date=date_text(c("TRANSACTION_DATE"), US_DATE), posted=date_text(c("POSTED_DATE"), US_DATE),
        type=F.when(c("_AMOUNT_2") > 0, DEBIT).otherwise(CREDIT),
        amount=F.abs(c("_AMOUNT")),
        description=c("DESCRIPTION"),
        catg_key=catg, sub_key=sub,
        onboard=c("CATEGORY").isNotNull() | F.coalesce(holds("_FOLDED", "PAYMENT"), F.lit(False)),
        extra={"EXT_DESCRIPTION": F.upper("CATEGORY"), "COUNTRY": _text("US")},
    )


def _keyword_name(rules, ends, deposit: Column, test: Callable[[list[str]], Column]) -> Column:
    chain = F
    for words, name in rules:
        chain = chain.when(test(words), name)
    return chain.when(deposit, ends[0]).otherwise(ends[1])


def _wellsfargo() -> Statement:
    deposit = c("_BARE_AMOUNT") > 0
    kind = F.when(deposit, CREDIT).otherwise(DEBIT)
    clean = _unquoted(c("DESCRIPTION"))
    day = F.trim(_unquoted(c("TRANSACTION_DATE")))

    def in_raw(words):
        return holds("_FOLDED", *words)

    def in_clean_first(words):
        # A fact looks its category up by the unquoted text for the first word only.
        return any_of([holds("_FOLDED_BARE", words[0]), *[holds("_FOLDED", w) for w in words[1:]]])

    return Statement(
        "WELLSFARGO",
        rank_order=[c("TRANSACTION_DATE"), c("AMOUNT"), c("DESCRIPTION")],
        id_parts=[day, kind, plain_number_text(F.abs(c("_BARE_AMOUNT"))), F.trim(clean)],
        date=_either_date(_unquoted(c("TRANSACTION_DATE"))), variant_posted=_either_date(_unquoted(c("POSTED_DATE"))),
        type=kind,
        amount=F.abs(c("_BARE_AMOUNT")),
        description=clean,
        catg=_keyword_name(WELLSFARGO_CATEGORIES, WELLSFARGO_CATEGORY_ENDS, deposit, in_raw),
        catg_key=_keyword_name(WELLSFARGO_CATEGORIES, WELLSFARGO_CATEGORY_ENDS, deposit, in_clean_first),
        sub_key=_keyword_name(WELLSFARGO_SUB_CATEGORIES, WELLSFARGO_SUB_ENDS, deposit, in_raw),
    )


STATEMENTS: dict[str, Callable[[], Statement]] = {
    "AMEX": _amex, "APPLE": _apple, "AXIS": _axis, "CAPITALONE": _capitalone, "CITI": _citi,
    "DISCOVER": _discover, "WELLSFARGO": _wellsfargo,
}


@dataclass(frozen=True)
class Dimensions:
    categories: DataFrame
    sub_categories: DataFrame
    banks: DataFrame
    members: DataFrame
    cards: DataFrame


@dataclass(frozen=True)
class LoadResult:
    bank_id: int
    new_categories: DataFrame
    new_sub_categories: DataFrame
    transactions: DataFrame
    rejects: DataFrame


def _lowest(df: DataFrame, key: str, column: str, value: str) -> DataFrame:
    return df.where(same_name(F.col(column), value) & (F.col("IS_CURRENT") == 1)).agg(F.min(key))


def resolve(dims: Dimensions, user_name: str, bank_name: str, card_last4: str) -> dict[str, int]:
    """Ids of the current member, bank and card (the lowest where several match), and the last ids of the
    category tables."""
    found = lookups(
        member=_lowest(dims.members, "MEMBER_ID", "FIRST_NAME", user_name),
        bank=_lowest(dims.banks, "BANK_ID", "BANK_NAME", bank_name),
        card=_lowest(dims.cards, "CARD_ID", "LAST_4", card_last4),
        last_category=highest(dims.categories, "CATG_ID"),
        last_sub_category=highest(dims.sub_categories, "SUB_CATG_ID"),
    )
    if None in found.values():
        raise ValueError("validation failed: no active member, bank or card found")
    return found


def statement_names(rows: DataFrame, spec: Statement) -> DataFrame:
    """Distinct category pairs of the statement and what each may onboard, found in one pass and staged."""
    always = F.lit(True)
    pairs = rows.select(
        (spec.catg if spec.catg is not None else spec.catg_key).alias("CATG_NAME"),
        spec.sub_key.alias("SUB_CATG_NAME"),
        (spec.onboard_catg if spec.onboard_catg is not None else always).alias("_CATG"),
        (spec.onboard if spec.onboard is not None else always).alias("_SUB"),
    )
    return stage(pairs.where("_CATG OR _SUB").distinct(), f"names-{spec.bank.lower()}")


def onboard_categories(
    names: DataFrame, categories: DataFrame, last_id: int, as_of: datetime
) -> DataFrame:
    """New category rows for the CATG_NAMEs that do not exist yet; over-long names are left out."""
    fits = F.length("CATG_NAME") <= CATEGORY.lengths["CATG_NAME"]
    fresh = insert_missing(names.where(fits).select("CATG_NAME"), categories, ["CATG_NAME"])
    rows = _audited(fresh, as_of)
    numbered = assign_identity(rows, [F.col("CATG_NAME")], {"CATG_ID": last_id}, "new-categories")
    return numbered.select(*CATEGORY.columns)


def onboard_sub_categories(
    names: DataFrame, index: DataFrame, sub_categories: DataFrame, last_id: int, as_of: datetime
) -> DataFrame:
    """New sub-category rows for (CATG_NAME, SUB_CATG_NAME) pairs; a NULL or over-long name cannot be stored."""
    fits = F.length("SUB_CATG_NAME") <= SUB_CATEGORY.lengths["SUB_CATG_NAME"]
    parented = names.where(fits).join(index, fold(F.col("CATG_NAME")) == F.col("CATG_KEY"))
    candidates = parented.select("SUB_CATG_NAME", "CATG_ID")
    rows = _audited(insert_missing(candidates, sub_categories, ["SUB_CATG_NAME", "CATG_ID"]), as_of)
    order = [F.col("CATG_ID"), F.col("SUB_CATG_NAME")]
    numbered = assign_identity(rows, order, {"SUB_CATG_ID": last_id}, "new-sub-categories")
    return numbered.select(*SUB_CATEGORY.columns)


def _audited(df: DataFrame, as_of: datetime, user: str = AUTO_USER) -> DataFrame:
    return df.withColumns(
        {"ADDED_USER": F.lit(user), "ADDED_DATETIME": moment(as_of)}
    )


def category_index(categories: DataFrame) -> DataFrame:
    """One row per name, the lowest id wins.  Its inputs are stored tables, so their size decides the join."""
    return categories.groupBy(fold(F.col("CATG_NAME")).alias("CATG_KEY")).agg(F.min("CATG_ID").alias("CATG_ID"))


def sub_category_index(sub_categories: DataFrame) -> DataFrame:
    return sub_categories.groupBy(fold(F.col("SUB_CATG_NAME")).alias("SUB_KEY"), "CATG_ID").agg(
        F.min("SUB_CATG_ID").alias("SUB_CATG_ID")
    )


def load_statement(
    bank: str, landing: DataFrame, dims: Dimensions, target: DataFrame, user_name: str, bank_name: str,
    card_last4: str, as_of: datetime, added_user: str = "LOADER", with_posted_date: bool = False,
    id_mode: str = "rank", owner: dict[str, int] | None = None,
) -> LoadResult:
    """Run one bank's load; nothing is written to the target tables here.

    ``with_posted_date`` also fills POSTED_DATE for the banks that leave it out.
    ``id_mode`` "rank" hashes a row's place in the whole statement into its id, so
    one more row before it changes the id; "occurrence" hashes its number among
    the rows with equal id parts, so a row keeps its id in a later statement that
    overlaps this one.  ``owner`` takes ids that ``resolve`` gave before.
    """
    if id_mode not in ("rank", "occurrence"):
        raise ValueError(f"unknown id mode {id_mode}")
    spec = STATEMENTS[bank]()
    ids = owner or resolve(dims, user_name, bank_name, card_last4)
    rows = landing.select(*LANDING.columns)
    parsed = _parsed(rows)
    names = statement_names(parsed, spec)  # from the landing rows, whose ids they do not need
    row_id = spec.reference
    if row_id is None:
        tie, label = content_key(LANDING.columns), f"landing-{bank.lower()}"
        if id_mode == "rank":
            ranked = global_rank(rows, spec.rank_order, "_RANK", label, tie)
        else:
            ranked = occurrence(parsed, F.concat(*spec.id_parts), [tie], "_RANK", label, list(LANDING.columns))
        parsed = _parsed(ranked)
        row_id = hash_id(F.concat(*spec.id_parts, c("_RANK").cast("string")))

    new_categories = onboard_categories(names.where("_CATG"), dims.categories, ids["last_category"], as_of)
    catg_index = category_index(dims.categories.unionByName(new_categories))
    new_subs = onboard_sub_categories(names.where("_SUB"), catg_index, dims.sub_categories, ids["last_sub_category"], as_of)
    sub_index = sub_category_index(dims.sub_categories.unionByName(new_subs))

    typed = _typed(parsed, row_id, spec, with_posted_date).join(catg_index, "CATG_KEY", "left").join(
        sub_index, ["SUB_KEY", "CATG_ID"], "left"
    )
    judged = typed.withColumn("REASON", _reason(spec))
    owner = {"BANK_ID": ids["bank"], "CARD_ID": ids["card"], "MEMBER_ID": ids["member"]}
    good = judged.where("REASON IS NULL").withColumns({n: F.lit(v).cast("int") for n, v in owner.items()})
    good = _audited(good, as_of, added_user).select(*TRANSACTIONS.columns)
    order = ["TRANSACTION_DATE", "TRANSACTION_AMOUNT", "DESCRIPTION"]
    return LoadResult(
        ids["bank"], new_categories, new_subs,
        insert_ignore(good, target, list(TRANSACTIONS.key), order),
        judged.where("REASON IS NOT NULL").select("_RAW.*", "REASON"),
    )


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: parse() for name, parse in PARSED.items()})


def _typed(rows: DataFrame, row_id: Column, spec: Statement, with_posted_date: bool) -> DataFrame:
    """Fact columns under their own names, cut to length, next to the landing columns they come from."""
    posted = spec.posted
    if posted is None and with_posted_date:
        posted = spec.variant_posted
    values = {
        "TRANSACTION_ID": row_id, "TRANSACTION_DATE": spec.date, "POSTED_DATE": posted,
        "TRANSACTION_TYPE": spec.type, "TRANSACTION_AMOUNT": spec.amount,
        "DESCRIPTION": F.coalesce(F.upper(spec.description), _text("")), **spec.extra,
    }
    built = []
    for f in TRANSACTIONS.schema:
        if f.name in ("CATG_ID", "SUB_CATG_ID", "BANK_ID", "CARD_ID", "MEMBER_ID", "ADDED_USER", "ADDED_DATETIME"):
            continue
        value = values.get(f.name)
        value = F.lit(None).cast(f.dataType) if value is None else value
        if f.name in TRANSACTIONS.lengths:
            value = F.left(value, F.lit(TRANSACTIONS.lengths[f.name]))
        built.append(value.alias(f.name))
    raw = F.struct(*[c(n) for n in LANDING.columns]).alias("_RAW")
    return rows.select(raw, *built, fold(spec.catg_key).alias("CATG_KEY"), fold(spec.sub_key).alias("SUB_KEY"))


def _reason(spec: Statement) -> Column:
    """Why a row cannot be stored, NULL for a good one."""
    checks = [
        ("TRANSACTION_ID", "no usable id"), ("TRANSACTION_DATE", "no usable date"),
        ("TRANSACTION_AMOUNT", "no usable amount"), ("CATG_ID", "no category"), ("SUB_CATG_ID", "no sub-category"),
    ]
    chain = F
    if spec.wanted is not None:
        chain = chain.when(F.col("_RAW.REFERENCE").isNull(), "no reference")
    for column, text in checks:
        chain = chain.when(F.col(column).isNull(), text)
    return chain
