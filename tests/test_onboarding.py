"""Batch onboarding against the same applicants entered one by one."""

from __future__ import annotations

import base64
import hashlib
import random
from datetime import datetime

import pytest

from ledgerloom.functions.secrets import ECB, GCM, decrypt, encrypt, folded_key
from ledgerloom.operators.onboarding import members_after, onboard
from ledgerloom.schemas import APPLICANTS, BANKS, CARDS, MEMBER_ADDRESS, MEMBERS
from pyspark.sql import functions as F

THEN, NOW, END = datetime(2020, 1, 1), datetime(2025, 1, 1), datetime(9999, 12, 31, 23, 59, 59)


class OneByOne:
    """Plain re-statement of the onboarding rules, used as the expected result."""

    def __init__(self, addresses, members, banks, cards):
        self.addresses, self.members, self.banks, self.cards = addresses, members, banks, cards
        self.results = []

    @staticmethod
    def _next(rows, i, base=0):
        return max([r[i] for r in rows], default=base) + 1

    def _find(self, rows, test):
        return min((r for r in rows if r["now"] and test(r)), key=lambda r: r[0], default=None)

    def enter(self, a):
        up = str.upper
        place = self._find(self.addresses, lambda r: (up(r["a"]), r["z"]) == (up(a["ADDRESS_1"]), a["ZIPCODE"]))
        if place is None:
            place = {0: self._next(self.addresses, 0), 1: self._next(self.addresses, 1, 1000), "a": a["ADDRESS_1"],
                     "z": a["ZIPCODE"], "now": 1}
            self.addresses.append(place)
        who = self._find(
            self.members, lambda r: (up(r["f"]), up(r["l"])) == (up(a["FIRST_NAME"]), up(a["LAST_NAME"]))
        )
        if who is None or who["adr"] != place[0]:
            if who is not None:
                who["now"] = 0
            key = self._next(self.members, 1, 5000) if who is None else who[1]
            who = {0: self._next(self.members, 0), 1: key, "f": a["FIRST_NAME"], "l": a["LAST_NAME"],
                   "adr": place[0], "now": 1}
            self.members.append(who)
        bank = self._find(
            self.banks, lambda r: (up(r["n"]), up(r["t"])) == (up(a["BANK_NAME"]), up(a["ACCOUNT_TYPE"]))
        )
        if bank is None:
            bank = {0: self._next(self.banks, 0), 1: self._next(self.banks, 1, 2000), "n": a["BANK_NAME"],
                    "t": a["ACCOUNT_TYPE"], "now": 1}
            self.banks.append(bank)
        last4 = a["CARD_NUMBER"][-4:]
        if self._find(self.cards, lambda r: (r["l4"], r["m"]) == (last4, who[0])) is None:
            self.cards.append({0: self._next(self.cards, 0), 1: self._next(self.cards, 1, 8000), "l4": last4,
                               "m": who[0], "b": bank[0], "now": 1})
        self.results.append((a["APPLICANT_NO"], who[0], last4))


def applicant(no, first, last, address, bank, card):
    return {
        "APPLICANT_NO": no, "FIRST_NAME": first, "LAST_NAME": last, "GENDER": "X", "DATE_OF_BIRTH": "1990-01-02",
        "ADDRESS_1": address, "ADDRESS_2": None, "CITY": "C", "STATE": "S", "ZIPCODE": "00001", "COUNTRY": "US",
        "BANK_NAME": bank, "ACCOUNT_TYPE": "CREDIT", "CARD_TYPE": "CREDIT", "CARD_NUMBER": card, "EXP_DATE": "01/30",
        "CVV": "000",
    }


def stored(spark):
    open_, closed = (THEN, END, 1, "T"), (THEN, NOW, 0, "T")
    return (
        spark.createDataFrame([(1, 1001, "1 Oak", None, "C", "S", "00001", *open_)], MEMBER_ADDRESS.schema),
        spark.createDataFrame(
            [(1, 5001, "Ann", None, "Lee", "X", None, 1, *closed), (2, 5001, "Ann", None, "Lee", "X", None, 1, *open_)],
            MEMBERS.schema,
        ),
        spark.createDataFrame([(1, 2001, "First", "CREDIT", *open_)], BANKS.schema),
        spark.createDataFrame([(1, 8001, "CREDIT", None, "1111", None, None, 1, 2, *open_)], CARDS.schema),
    )


def expected_start():
    return OneByOne(
        [{0: 1, 1: 1001, "a": "1 Oak", "z": "00001", "now": 1}],
        [{0: 1, 1: 5001, "f": "Ann", "l": "Lee", "adr": 1, "now": 0},
         {0: 2, 1: 5001, "f": "Ann", "l": "Lee", "adr": 1, "now": 1}],
        [{0: 1, 1: 2001, "n": "First", "t": "CREDIT", "now": 1}],
        [{0: 1, 1: 8001, "l4": "1111", "m": 2, "b": 1, "now": 1}],
    )


def check(spark, applicants):
    frame = spark.createDataFrame([tuple(a[c] for c in APPLICANTS.columns) for a in applicants], APPLICANTS.schema)
    dims = stored(spark)
    got = onboard(frame.repartition(3), *dims, "key", NOW)
    want = expected_start()
    for a in sorted(applicants, key=lambda a: a["APPLICANT_NO"]):
        want.enter(a)
    results = sorted((r["APPLICANT_NO"], r["ACTIVE_MEMBER_ID"], r["CARD_STORED"]) for r in got.results.collect())
    assert results == want.results
    members = members_after(dims[1], got, NOW).collect()
    assert sorted((r["MEMBER_ID"], r["MEMBER_KEY"], r["ADDRESS_ID"], r["IS_CURRENT"]) for r in members) == [
        (m[0], m[1], m["adr"], m["now"]) for m in want.members
    ]
    current = [r["MEMBER_KEY"] for r in members if r["IS_CURRENT"]]
    assert len(current) == len(set(current))
    assert all((r["EFF_END_DATE"] == END) == bool(r["IS_CURRENT"]) for r in members)
    assert sorted((r["ADDRESS_ID"], r["ADDRESS_KEY"], r["ADDRESS_1"]) for r in got.new_addresses.collect()) == [
        (r[0], r[1], r["a"]) for r in want.addresses[1:]
    ]
    assert sorted((r["BANK_ID"], r["BANK_KEY"], r["BANK_NAME"]) for r in got.new_banks.collect()) == [
        (r[0], r[1], r["n"]) for r in want.banks[1:]
    ]
    assert sorted((r["CARD_ID"], r["CARD_KEY"], r["LAST_4"], r["MEMBER_ID"], r["BANK_ID"]) for r in got.new_cards.collect()) == [
        (r[0], r[1], r["l4"], r["m"], r["b"]) for r in want.cards[1:]
    ]
    return got


def test_unchanged_moved_and_new(spark):
    got = check(spark, [
        applicant(1, "ann", "LEE", "1 OAK", "first", "4000111122221111"),   # nothing new
        applicant(2, "Ann", "Lee", "2 Elm", "First", "4000111122221111"),   # moved: new version, second current card
        applicant(3, "Bob", "Ray", "2 elm", "Second", "4000111122223333"),  # new member at a known new address
        applicant(4, "Ann", "Lee", "1 Oak", "First", "4000111122221111"),   # moved back: a third version
        applicant(5, "BOB", "ray", "2 Elm", "SECOND", "4000111122223333"),  # nothing new
    ])
    card = got.new_cards.orderBy("CARD_ID").first()
    opened = got.new_cards.select(decrypt(F.col("CARD_NUMBER"), "key").alias("n"), decrypt(F.col("CVV"), "key").alias("c"))
    assert card["LAST_4"] == "1111" and opened.first()[:] == ("4000111122221111", "000")
    assert got.new_members.select(decrypt(F.col("DATE_OF_BIRTH"), "key")).first()[0] == "1990-01-02"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_with_one_busy_member(spark, seed):
    rnd = random.Random(seed)
    people = [("Ann", "Lee"), ("Bob", "Ray"), ("Cy", "Poe"), ("Di", "Fox")]
    applicants = []
    for i in range(60):
        first, last = people[0] if i % 3 == 0 else rnd.choice(people)
        applicants.append(applicant(
            i, first, rnd.choice([last, last.upper()]), rnd.choice(["1 Oak", "2 Elm", "3 Fir", "4 Ash"]),
            rnd.choice(["First", "Second"]), "400011112222" + rnd.choice(["1111", "2222"]),
        ))
    rnd.shuffle(applicants)
    check(spark, applicants)


@pytest.mark.parametrize("mode", [ECB, GCM])
def test_secrets_round_trip(spark, mode):
    df = spark.createDataFrame([("4000",), (None,)], "v string")
    got = df.select(decrypt(encrypt(F.col("v"), "a key longer than sixteen bytes", mode), "a key longer than sixteen bytes", mode))
    assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)


def test_long_keys_fold_onto_sixteen_bytes():
    assert folded_key("abc") == b"abc" + bytes(13)
    assert folded_key("0123456789abcdefZ")[0] == ord("0") ^ ord("Z")


def test_applicants_that_cannot_be_entered(spark):
    people = [applicant(i, f"A{i}", "Lee", "1 Oak", "Axis Bank", f"400011112222{i:04d}") for i in range(1, 4)]
    people[1]["ZIPCODE"] = None
    people[2] |= {"GENDER": None, "ADDRESS_1": None}
    loose = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in APPLICANTS.schema)
    given = spark.createDataFrame([tuple(p[c] for c in APPLICANTS.columns) for p in people], loose)
    none = [spark.createDataFrame([], t.schema) for t in (MEMBER_ADDRESS, MEMBERS, BANKS, CARDS)]
    got = onboard(given, *none, "key", NOW)
    assert sorted((r["APPLICANT_NO"], r["STATUS"]) for r in got.results.collect()) == [(1, "SUCCESS"), (2, "FAILED"), (3, "FAILED")]
    assert sorted((r["APPLICANT_NO"], r["REASON"]) for r in got.rejects.collect()) == [(2, "no ZIPCODE"), (3, "no GENDER")]
    assert got.new_addresses.count() == got.new_members.count() == 1


def test_over_long_applicant_is_found_again(spark):
    long = applicant(1, "Ann" * 30, "Lee", "Long Road " * 30, "Axis Bank" * 20, "4000111122221111")
    given = spark.createDataFrame([tuple(long[c] for c in APPLICANTS.columns)], APPLICANTS.schema)
    none = [spark.createDataFrame([], t.schema) for t in (MEMBER_ADDRESS, MEMBERS, BANKS, CARDS)]
    one = onboard(given, *none, "key", NOW)
    two = onboard(given, one.new_addresses, one.new_members, one.new_banks, one.new_cards, "key", NOW)
    assert [df.count() for df in (two.new_addresses, two.new_members, two.new_banks, two.new_cards)] == [0, 0, 0, 0]


@pytest.mark.parametrize("mode", [GCM, ECB])
def test_no_plan_holds_the_key(spark, mode, capsys):
    key = "sixteen letters!"
    held = folded_key(key) if mode == ECB else hashlib.sha256(key.encode()).digest()
    df = spark.createDataFrame([("4000",)], "v string").select(encrypt(F.col("v"), key, mode).alias("v"))
    opened = df.select(decrypt(F.col("v"), key, mode).alias("v"))
    assert opened.collect() == [("4000",)]
    for frame in (df, opened):
        frame.explain(True)
        text = capsys.readouterr().out + frame._jdf.queryExecution().toString()
        spelt = [key, held.hex(), held.hex().upper(), " ".join(f"{b:02X}" for b in held), str(list(held)), base64.b64encode(held).decode()]
        assert text and not any(x in text for x in spelt)
