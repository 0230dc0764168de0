"""Member onboarding: address, member, bank and card, with versions for a changed address.

A whole frame of applicants is taken at once.  The result is what entering them
one by one in APPLICANT_NO order would give: the first applicant with a new
address, bank or card creates it, and each change of a member's address closes
one version and opens the next.  Members are walked by a global rank rather
than a window per member, so one member with most of the rows stays split.

Kept as it always was: addresses and banks are never closed, the country is
taken and dropped, and a member who moved gets a second current card with the
same last four digits, since cards belong to a member version.

Texts are cut to their declared length before any key is taken from them, so
what is stored is what a later run finds.  An applicant without a required
text creates nothing and is answered with FAILED.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.ids import assign_identity, global_rank, highest, lookups, running_total
from ledgerloom.functions.secrets import GCM, encrypt
from ledgerloom.functions.text import fold, moment
from ledgerloom.operators.sinks import first_per_key
from ledgerloom.schemas import APPLICANTS, BANKS, CARDS, MEMBER_ADDRESS, MEMBERS, OPEN_END
from ledgerloom.session import stage

# The number before the first key of each dimension.
KEY_BASE = {"ADDRESS_KEY": 1000, "MEMBER_KEY": 5000, "BANK_KEY": 2000, "CARD_KEY": 8000}


@dataclass(frozen=True)
class Onboarded:
    new_addresses: DataFrame
    new_members: DataFrame
    closed_members: DataFrame     # MEMBER_ID of stored versions that end now
    new_banks: DataFrame
    new_cards: DataFrame
    results: DataFrame            # one row per applicant
    rejects: DataFrame            # applicants that miss a required text, with the reason


def _current(dim: DataFrame, key: dict, id_column: str) -> DataFrame:
    """Lowest current id per folded natural key."""
    return (
        dim.where("IS_CURRENT = 1")
        .groupBy(*[fold(F.col(c)).alias(k) for k, c in key.items()])
        .agg(F.min(id_column).alias(id_column))
    )


def _opened(df: DataFrame, as_of: datetime, user: str) -> DataFrame:
    return df.withColumns(
        {
            "EFF_START_DATE": moment(as_of),
            "EFF_END_DATE": F.lit(OPEN_END).cast("timestamp_ntz"),
            "IS_CURRENT": F.lit(1),
            "ADDED_USER": F.lit(user),
        }
    )


def _add_missing(applicants, dim, table, key, starts, as_of, user):
    """New rows of a dimension for natural keys without a current row, and the index of all keys."""
    id_column = table.key[0]
    known = _current(dim, key, id_column)
    given = [c for c in applicants.columns if c in table.columns]
    keyed = applicants.select("APPLICANT_NO", *given, *[fold(F.col(c)).alias(k) for k, c in key.items()])
    fresh = first_per_key(keyed, list(key), ["APPLICANT_NO"]).join(known, list(key), "left_anti")
    new = assign_identity(fresh, [F.col("APPLICANT_NO")], starts, f"new-{table.name.lower()}")
    index = known.unionByName(new.select(*known.columns))
    return _opened(new, as_of, user).select(*table.columns), index


def _cut(applicants: DataFrame) -> DataFrame:
    """Texts at the shortest length that any table they go to declares; dates of birth as text."""
    lengths = dict(APPLICANTS.lengths)
    for table in (MEMBER_ADDRESS, MEMBERS, BANKS, CARDS):
        for c, n in table.lengths.items():
            if c in lengths:
                lengths[c] = min(lengths[c], n)
    rows = applicants.withColumns({c: F.col(c).cast("string") for c in applicants.columns if c != "APPLICANT_NO"})
    # A card number keeps its last digits, which name the card.
    lengths.pop("CARD_NUMBER", None)
    return rows.withColumns({c: F.left(F.col(c), F.lit(n)) for c, n in lengths.items() if c in rows.columns})


def judged(applicants: DataFrame) -> DataFrame:
    """Cut applicants with a REASON that is NULL for those that can be entered."""
    rows = _cut(applicants)
    reason = F.lit(None).cast("string")
    for c in reversed([c for c in APPLICANTS.required if c != "APPLICANT_NO"]):
        reason = F.when(F.col(c).isNull(), f"no {c}").otherwise(reason)
    return rows.withColumn("REASON", reason)


def _member_versions(visits, members, last_id, last_key):
    """Mark where a member's address changes and give every version its id.

    Returns the visits with the version in force, and the versions.
    """
    names = ["FIRST_KEY", "LAST_KEY"]
    known = members.where("IS_CURRENT = 1").groupBy(
        fold(F.col("FIRST_NAME")).alias("FIRST_KEY"), fold(F.col("LAST_NAME")).alias("LAST_KEY")
    ).agg(F.min(F.struct("MEMBER_ID", "MEMBER_KEY", "ADDRESS_ID")).alias("KNOWN"))
    ranked = global_rank(stage(visits, "member-visits-in"), [*map(F.col, names), F.col("APPLICANT_NO")], "RANK", "member-visits")
    earlier = ranked.select(
        (F.col("RANK") + 1).alias("RANK"), F.struct(*names).alias("EARLIER"), F.col("ADDRESS_ID").alias("EARLIER_ADDRESS")
    )
    walked = ranked.join(earlier, "RANK", "left").join(known, names, "left")
    same = F.col("EARLIER").eqNullSafe(F.struct(*names))
    held = F.when(same, F.col("EARLIER_ADDRESS")).otherwise(F.col("KNOWN.ADDRESS_ID"))
    walked = walked.withColumns({"FIRST_SEEN": ~same, "STARTS": ~held.eqNullSafe(F.col("ADDRESS_ID"))})
    walked = stage(running_total(walked, "RANK", F.col("STARTS"), "VERSION_NO"), "member-walk")

    starts = walked.where("STARTS")
    newcomers = assign_identity(
        starts.where("FIRST_SEEN AND KNOWN IS NULL").select(*names, "APPLICANT_NO"),
        [F.col("APPLICANT_NO")], {"NEW_KEY": last_key}, "new-member-keys",
    ).select(*names, "NEW_KEY")
    versions = assign_identity(starts, [F.col("APPLICANT_NO")], {"MEMBER_ID": last_id}, "new-members")
    following = versions.select((F.col("VERSION_NO") - 1).alias("VERSION_NO"), F.struct(*names).alias("NEXT"))
    versions = (
        versions.join(newcomers, names, "left")
        .join(following, "VERSION_NO", "left")
        .withColumn("MEMBER_KEY", F.coalesce("NEW_KEY", "KNOWN.MEMBER_KEY"))
        .withColumn("CLOSED", F.col("NEXT").eqNullSafe(F.struct(*names)))
    )
    in_force = versions.select("VERSION_NO", F.struct(*names).alias("OWNER"), F.col("MEMBER_ID").alias("VERSION_ID"))
    visits = walked.join(in_force, "VERSION_NO", "left").withColumn(
        "MEMBER_ID",
        F.when(F.col("OWNER").eqNullSafe(F.struct(*names)), F.col("VERSION_ID")).otherwise(F.col("KNOWN.MEMBER_ID")),
    )
    return visits, versions


def onboard(
    applicants: DataFrame, addresses: DataFrame, members: DataFrame, banks: DataFrame, cards: DataFrame,
    key: str, as_of: datetime, added_user: str = "ONBOARDING", mode: str = GCM,
) -> Onboarded:
    judgement = stage(judged(applicants), "applicants")
    rejects = judgement.where("REASON IS NOT NULL")
    applicants = judgement.where("REASON IS NULL").drop("REASON")
    last = lookups(
        address=highest(addresses, "ADDRESS_ID"),
        address_key=highest(addresses, "ADDRESS_KEY", KEY_BASE["ADDRESS_KEY"]),
        member=highest(members, "MEMBER_ID"),
        member_key=highest(members, "MEMBER_KEY", KEY_BASE["MEMBER_KEY"]),
        bank=highest(banks, "BANK_ID"),
        bank_key=highest(banks, "BANK_KEY", KEY_BASE["BANK_KEY"]),
        card=highest(cards, "CARD_ID"),
        card_key=highest(cards, "CARD_KEY", KEY_BASE["CARD_KEY"]),
    )
    place = {"PLACE_KEY": "ADDRESS_1", "ZIP_KEY": "ZIPCODE"}
    account = {"BANK_NAME_KEY": "BANK_NAME", "ACCOUNT_KEY": "ACCOUNT_TYPE"}
    new_addresses, address_index = _add_missing(
        applicants, addresses, MEMBER_ADDRESS, place,
        {"ADDRESS_ID": last["address"], "ADDRESS_KEY": last["address_key"]}, as_of, added_user,
    )
    new_banks, bank_index = _add_missing(
        applicants, banks, BANKS, account,
        {"BANK_ID": last["bank"], "BANK_KEY": last["bank_key"]}, as_of, added_user,
    )
    keys = {**place, **account, "FIRST_KEY": "FIRST_NAME", "LAST_KEY": "LAST_NAME"}
    keyed = applicants.withColumns({k: fold(F.col(c)) for k, c in keys.items()})
    visits = keyed.join(address_index, list(place)).join(bank_index, list(account)).select(
        "APPLICANT_NO", "FIRST_KEY", "LAST_KEY", "FIRST_NAME", "LAST_NAME", "GENDER", "DATE_OF_BIRTH", "ADDRESS_ID",
        "BANK_ID", "CARD_TYPE", "CARD_NUMBER", "EXP_DATE", "CVV",
    )
    visits, versions = _member_versions(visits, members, last["member"], last["member_key"])
    new_members = _opened(
        versions.withColumns(
            {"MIDDLE_NAME": F.lit(None).cast("string"), "DATE_OF_BIRTH": encrypt(F.col("DATE_OF_BIRTH"), key, mode)}
        ), as_of, added_user,
    ).withColumns(
        {
            "IS_CURRENT": F.when(F.col("CLOSED"), 0).otherwise(1),
            "EFF_END_DATE": F.when(F.col("CLOSED"), F.col("EFF_START_DATE")).otherwise(F.col("EFF_END_DATE")),
        }
    ).select(*MEMBERS.columns)
    closed = versions.where("KNOWN IS NOT NULL").select(F.col("KNOWN.MEMBER_ID").alias("MEMBER_ID")).distinct()

    card_key = ["LAST_4", "MEMBER_ID"]
    wanted = visits.select(
        "APPLICANT_NO", F.right("CARD_NUMBER", F.lit(4)).alias("LAST_4"), "MEMBER_ID", "BANK_ID", "CARD_TYPE",
        "CARD_NUMBER", "EXP_DATE", "CVV",
    )
    held = cards.where("IS_CURRENT = 1").select(*card_key).distinct()
    fresh = first_per_key(wanted, card_key, ["APPLICANT_NO"]).join(held, card_key, "left_anti")
    secret = {c: encrypt(F.col(c), key, mode) for c in ("CARD_NUMBER", "EXP_DATE", "CVV")}
    new_cards = assign_identity(
        _opened(fresh.withColumns(secret), as_of, added_user), [F.col("APPLICANT_NO")],
        {"CARD_ID": last["card"], "CARD_KEY": last["card_key"]}, "new-cards",
    ).select(*CARDS.columns)
    results = wanted.select(
        "APPLICANT_NO", F.lit("SUCCESS").alias("STATUS"), F.col("MEMBER_ID").alias("ACTIVE_MEMBER_ID"),
        F.col("LAST_4").alias("CARD_STORED"),
    )
    failed = rejects.select(
        "APPLICANT_NO", F.lit("FAILED").alias("STATUS"), F.lit(None).cast("int").alias("ACTIVE_MEMBER_ID"),
        F.lit(None).cast("string").alias("CARD_STORED"),
    )
    return Onboarded(new_addresses, new_members, closed, new_banks, new_cards, results.unionByName(failed), rejects)


def close_versions(members: DataFrame, closed: DataFrame, as_of: datetime) -> DataFrame:
    """Stored members with the given versions ended."""
    marked = members.join(closed.select("MEMBER_ID", F.lit(True).alias("_ENDS")), "MEMBER_ID", "left")
    return marked.withColumns(
        {
            "IS_CURRENT": F.when(F.col("_ENDS"), 0).otherwise(F.col("IS_CURRENT")),
            "EFF_END_DATE": F.when(F.col("_ENDS"), moment(as_of)).otherwise(F.col("EFF_END_DATE")),
        }
    ).select(*members.columns)


def members_after(members: DataFrame, result: Onboarded, as_of: datetime) -> DataFrame:
    return close_versions(members, result.closed_members, as_of).unionByName(result.new_members)
