"""The description patterns of seven banks and what each one means.

Every table below is tried from top to bottom and the first match wins.  The
patterns, the texts they give and their order are the data the results depend
on, so they are stated here as they are and nowhere else.  Known oddities are
kept on purpose: the Wells Fargo place is one town or ONLINE, its trace id
falls back to the first word of the text, and a Wells Fargo purchase starts at
character 26.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerloom.functions.rules import Ladder, Match, Part


def ext(pattern, kind="like"):
    return Match(pattern, "EXT_DESCRIPTION", kind)


def sub(pattern):
    return Match(pattern, "SUB_CATG_NAME", "equals")


def regex(pattern):
    return Match(pattern, "DESCRIPTION", "regex")


@dataclass(frozen=True)
class BankRules:
    bank: str
    names: tuple[str, ...]          # patterns that find the bank in BANKS
    fields: dict[str, Ladder] = field(default_factory=dict)
    preview: dict[str, Ladder] = field(default_factory=dict)
    preview_columns: tuple[str, ...] = ("DESCRIPTION",)
    current_only: bool = True


# Removed prefixes, clean-up patterns and extraction patterns.
AMEX_PREFIXES = ["APLPAY ", "TST* "]
AMEX_NOISE = "[0-9]{4,}.*|[ ]{2,}.*"
AMEX_GAP = "  "
DISCOVER_AMAZON = r"AMAZON MKTPL\*[^ ]+|AMAZON\.COM\*[^ ]+|AMAZON MKTPLACE PMTS"
DISCOVER_NOISE = (
    r"([ ]+([A-Z.]{2,}( [A-Z.]{2,})?) [A-Z]{2}([0-9]+)?$)"
    r"|([ ]+([0-9#]{3,}|[0-9]{2,}-[0-9]+).*)|(AMZN.COM/BILL.*)"
)
DISCOVER_PLACE = r"([A-Z.]{2,}( [A-Z.]{2,})? [A-Z]{2}([0-9]+)?$)"
CAPITALONE_PREFIXES = ["TST* ", "COT*"]
CAPITALONE_NOISE = "[0-9]{10,}.*|[ ]{2,}.*"
LONG_NUMBER = "[0-9]{10,}"
APPLE_PREFIXES = ["TST* ", "GFM*", "ABC*P ", "SP AG1 "]
APPLE_NOISE = (
    r"([ ]+(#|[0-9]{1,}[A-Z]|[0-9]{2,}|AND |LIMITED|PKWY|STREET|WAY|RD|DR|SUITE|BLVD"
    r"|ONE APPLE PARK|GOFUNDME.COM|\().*)"
)
APPLE_PLACE = "[A-Z. ]+ [0-9]{5} [A-Z]{2} USA"
APPLE_PLACE_NOISE = "[0-9]{5} | USA"
APPLE_PLAN = "[0-9]+ OF [0-9]+"
CITI_PREFIXES = ["TST* ", "PY * ", "SQ * ", "SP * "]
CITI_NOISE = r"([ ]+(#|[0-9]{4,}|[0-9]{2,}-[0-9]+|[A-Z. ]+ [A-Z]{2}$|800-|888-|877-).*)"
CITI_PLACE = "[A-Z. ]+ [A-Z]{2}$"
CITI_FUEL = "TEXACO|BUC-EE|EXXON|SHELL|CONOCO|QT|7-ELEVEN|LOVE'S"
AXIS_FILLERS = ["PAYMENT", "PAYMEN", "TRANSFER", "OTHERS", "NULL", "NA", ""]
WELLSFARGO_PURCHASE_AT = 26

# Axis.
_AXIS_INTEREST = ["INT ON SB%", "SB:%", "%INT.PD:%"]
_AXIS_ENTITY = Ladder(
    [
        (["POS/%", "ECOM PUR/%"], Part("slash_2")),
        (["UPI/%", "IMPS/%"], Part("slash_4")),
        ("MOB/%", Part("slash_3")),
        (["ECS/%", "NBSM/%"], Part("slash_3")),
        (_AXIS_INTEREST, "BANK SYSTEM"),
        ("ATM-%", "SELF"),
        ("PUR-REV/%", "REVERSAL"),
    ],
    "UNKNOWN",
)
_AXIS_GEOGRAPHY = Ladder(
    [(["POS/%", "ECOM PUR/%"], Part("slash_3")), ("ATM-%", Part("slash_3"))], "ONLINE/TRANSFER"
)
AXIS = BankRules(
    "AXIS",
    ("%Axis%",),
    fields={
        "PAYMENT_CHANNEL": Ladder(
            [
                ("POS/%", "DEBIT CARD"),
                ("ECOM PUR/%", "ONLINE PURCHASE"),
                ("UPI/%", "UPI"),
                ("IMPS/%", "IMPS"),
                ("ATM-%", "CASH WITHDRAWAL"),
                ("MOB/%", "MOBILE BANKING"),
                ("ECS/%", "AUTOPAY/ECS"),
                ("NBSM/%", "NET BANKING"),
                ("PUR-REV/%", "REVERSAL"),
                (_AXIS_INTEREST, "BANK INTEREST/TAX"),
            ],
            "OTHERS",
        ),
        "ENTITY_NAME": _AXIS_ENTITY,
        "GEOGRAPHY": _AXIS_GEOGRAPHY,
        "ASSOCIATED_BANK": Ladder([(["UPI/%", "IMPS/%"], Part("slash_last"))]),
    },
    preview={
        "PAYMENT_CHANNEL": Ladder(
            [
                ("POS/%", "DEBIT CARD"),
                ("ECOM PUR/%", "ONLINE PURCHASE"),
                ("PURCHASE AUTHORIZED ON %", "DEBIT CARD"),
                ("UPI/%", "UPI"),
                ("IMPS/%", "IMPS"),
                ("ATM-%", "CASH WITHDRAWAL"),
                ("ZELLE %", "ZELLE"),
                (["ATM-%", "ATM CASH %"], "CASH WITHDRAWAL"),
                ("MOB/%", "MOBILE BANKING"),
                ("ECS/%", "AUTOPAY/ECS"),
                ("NBSM/%", "NET BANKING"),
                ("PUR-REV/%", "REVERSAL"),
                (["%PAYMENT%", "% PMT%", "% PAY %", "% PREM %", "% ACH %"], "BILL PAY/ACH"),
                ("%PAYROLL%", "PAYROLL"),
                (["%MONEYLINK%", "%AUTO DRAFT%"], "TRANSFER"),
                (_AXIS_INTEREST, "BANK INTEREST/TAX"),
            ],
            "OTHERS",
        ),
        "ENTITY_NAME": _AXIS_ENTITY,
        "GEOGRAPHY": _AXIS_GEOGRAPHY,
        "ASSOCIATED_BANK": Ladder([(["UPI/%", "IMPS/%"], Part("slash_last_named"))]),
    },
)

# Wells Fargo.
WELLSFARGO = BankRules(
    "WELLSFARGO",
    ("%Wells%",),
    current_only=False,
    fields={
        "PAYMENT_CHANNEL": Ladder(
            [("PURCHASE AUTHORIZED%", "DEBIT CARD"), ("ZELLE%", "ZELLE"), ("ATM CASH%", "CASH")],
            "ACH/TRANSFER",
        ),
        "ENTITY_NAME": Ladder(
            [
                ("ZELLE FROM %", Part("zelle_from")),
                ("ZELLE TO %", Part("zelle_to")),
                ("PURCHASE AUTHORIZED%", Part("purchase_word")),
            ],
            Part("two_words"),
        ),
        "GEOGRAPHY": Ladder([("% MCKINNEY %", "MCKINNEY TX")], "ONLINE"),
        "TRANSACTION_MEMO": Ladder([("ZELLE % REF # %", Part("memo"))]),
        "TRACE_ID": Ladder([], Part("ref_word")),
        "ASSOCIATED_BANK": Ladder([("%JPM%", "CHASE"), ("%BAC%", "BOFA")]),
    },
    preview={
        "PAYMENT_CHANNEL": Ladder(
            [
                ("PURCHASE AUTHORIZED ON %", "DEBIT CARD"),
                ("ZELLE %", "ZELLE"),
                ("ATM CASH %", "CASH WITHDRAWAL"),
                (["%PAYMENT%", "% PMT%", "% PAY %", "% PREM %", "% ACH %"], "BILL PAY/ACH"),
                (["%PAYROLL%", "%MOSTTAXRFD%"], "INCOME/REFUND"),
                ("%USATAXPYMT%", "TAX PAYMENT"),
                (["%MONEYLINK%", "%AUTO DRAFT%"], "TRANSFER"),
            ],
            "OTHERS",
        ),
        "ENTITY_NAME": Ladder(
            [
                ("ZELLE FROM %", Part("zelle_from")),
                ("ZELLE TO %", Part("zelle_to")),
                ("PURCHASE AUTHORIZED ON %", Part("purchase_word")),
                ("ATM CASH %", "SELF"),
                ("AMERENMO %", "AMERENMO"),
                ("CITI CARD %", "CITI"),
                ("CAPITAL ONE %", "CAPITAL ONE"),
                ("AMERICAN EXPRESS %", "AMERICAN EXPRESS"),
                ("APPLECARD %", "APPLE"),
                ("DISCOVER %", "DISCOVER"),
                ("LIBERTY MUTUAL %", "LIBERTY MUTUAL"),
                ("PROG COUNTY %", "PROGRESSIVE"),
                ("IRS %", "IRS"),
                ("MO DEPT REVENUE %", "MO DEPT REVENUE"),
                ("RELIABLE SOFTWAR %", "RELIABLE SOFTWARE"),
                ("SCHWAB %", "SCHWAB"),
                ("WELLS FARGO %", "WELLS FARGO"),
                ("PF MCKINNEY %", "PLANET FITNESS"),
            ],
            "UNKNOWN",
        ),
        "GEOGRAPHY": Ladder(
            [("PURCHASE AUTHORIZED ON %", Part("city_state")), ("ATM CASH %", Part("atm_place"))],
            "ONLINE/TRANSFER",
        ),
        "TRANSACTION_MEMO": Ladder([("ZELLE % REF # %", Part("memo"))]),
        "TRACE_ID": Ladder(
            [("% REF # %", Part("ref_word")), ("PURCHASE AUTHORIZED ON %", Part("third_last_word"))]
        ),
        "ASSOCIATED_BANK": Ladder(
            [
                ("CITI CARD %", "CITI"),
                ("AMERICAN EXPRESS %", "AMEX"),
                ("DISCOVER %", "DISCOVER"),
                ("APPLECARD %", "GSBANK"),
                ("CAPITAL ONE %", "CAPITAL ONE"),
            ]
        ),
    },
)

# American Express.
_AMEX_COMMON = {
    "PAYMENT_CHANNEL": Ladder(
        [
            ("MOBILE PAYMENT%", "PAYMENT"),
            ("APLPAY %", "APPLE PAY"),
            (["%.COM%", ext("%.COM%")], "ONLINE PURCHASE"),
        ],
        "CREDIT CARD",
    ),
    "ENTITY_NAME": Ladder([("MOBILE PAYMENT%", "AMERICAN EXPRESS")], Part("merchant")),
    "GEOGRAPHY": Ladder([("MOBILE PAYMENT%", "ONLINE")], Part("place")),
    "DETAILED_CATEGORY": Ladder(
        [
            (ext("%DESCRIPTION : %"), Part("item")),
            (ext("%FAST FOOD REST%"), "DINING"),
            (ext("%GROCERY STORE%"), "GROCERIES"),
            (ext("%DISCOUNT STORE%"), "SHOPPING"),
            (ext("%LODGING%"), "TRAVEL"),
            (ext("%PASSENGER TICKET%"), "AIRLINE"),
        ],
        "RETAIL",
    ),
}
AMEX = BankRules(
    "AMEX",
    ("%Amex%", "%American Express%"),
    fields=_AMEX_COMMON,
    preview={**_AMEX_COMMON, "FLIGHT_PASSENGER": Ladder([(ext("%PASSENGER NAME : %"), Part("passenger"))])},
    preview_columns=("DESCRIPTION", "EXT_DESCRIPTION"),
)

# Discover.
_DISCOVER = {
    "PAYMENT_CHANNEL": Ladder(
        [
            (["INTERNET PAYMENT%", ext("PAYMENTS AND CREDITS", "equals")], "PAYMENT"),
            (["AMAZON%", "AMZN%"], "ONLINE PURCHASE"),
            (ext("GASOLINE", "equals"), "GAS STATION"),
        ],
        "CREDIT CARD",
    ),
    "ENTITY_NAME": Ladder([], Part("merchant")),
    "GEOGRAPHY": Ladder([("% PAYMENT %", "ONLINE"), (regex(DISCOVER_PLACE), Part("place"))], "UNKNOWN"),
    "DETAILED_CATEGORY": Ladder([], Part("ext_upper")),
    "TRACE_ID": Ladder([], Part("long_number")),
}
DISCOVER = BankRules(
    "DISCOVER", ("%Discover%",), fields=_DISCOVER, preview=_DISCOVER,
    preview_columns=("DESCRIPTION", "EXT_DESCRIPTION"),
)

# Capital One.
_CAPITALONE = {
    "PAYMENT_CHANNEL": Ladder(
        [
            ("CAPITAL ONE MOBILE PYMT%", "PAYMENT"),
            ([sub("AIRFARE"), "%AIR%"], "AIRLINE"),
            ([sub("GAS/AUTOMOTIVE"), "NTTA%"], "TRANSPORT/GAS"),
            ("COT*%", "TRAVEL PORTAL"),
        ],
        "CREDIT CARD",
    ),
    "ENTITY_NAME": Ladder(
        [
            ("SOUTHWES%", "SOUTHWEST AIRLINES"),
            ("AMERICAN %", "AMERICAN AIRLINES"),
            ("UNITED %", "UNITED AIRLINES"),
            ("ETIHAD %", "ETIHAD AIRWAYS"),
            ("QATAR AIR%", "QATAR AIRWAYS"),
            ("KRISHNA INSTITUTE%", "KRISHNA INSTITUTE OF MEDICAL SCIENCES"),
            (Match("COT*HTL", kind="equals"), "CAPITAL ONE TRAVEL - HOTEL"),
            (Match("COT*FLT", kind="equals"), "CAPITAL ONE TRAVEL - FLIGHT"),
        ],
        Part("merchant"),
    ),
    "DETAILED_CATEGORY": Ladder([], Part("sub_upper")),
    "TRACE_ID": Ladder([], Part("long_number")),
}
CAPITALONE = BankRules(
    "CAPITALONE", ("%CapitalOne%",), fields=_CAPITALONE, preview=_CAPITALONE,
    preview_columns=("DESCRIPTION", "SUB_CATG_NAME"),
)

# Apple Card.
_APPLE = {
    "PAYMENT_CHANNEL": Ladder(
        [
            ("ACH DEPOSIT%", "PAYMENT"),
            ("MONTHLY INSTALLMENTS%", "INSTALLMENT"),
            ("DAILY CASH ADJUSTMENT%", "REWARDS"),
            ("%(RETURN)%", "RETURN"),
            ("APPLE.COM/BILL%", "DIGITAL SERVICES"),
        ],
        "CREDIT CARD",
    ),
    "ENTITY_NAME": Ladder([], Part("merchant")),
    "GEOGRAPHY": Ladder(
        [(regex(APPLE_PLACE), Part("place")), ("APPLE.COM/BILL%", "CUPERTINO CA")], "ONLINE"
    ),
    "DETAILED_CATEGORY": Ladder([], Part("sub_upper")),
    "INSTALLMENT_PLAN": Ladder([("MONTHLY INSTALLMENTS%", Part("plan"))]),
}
APPLE = BankRules(
    "APPLE", ("%Apple%",), fields=_APPLE, preview=_APPLE, preview_columns=("DESCRIPTION", "SUB_CATG_NAME")
)

# Citi.
_CITI = {
    "PAYMENT_CHANNEL": Ladder(
        [
            ("%PAYMENT%THANK YOU%", "PAYMENT"),
            (["WWW %", "%.COM%"], "ONLINE PURCHASE"),
            (["%GAS %", regex(CITI_FUEL)], "GAS STATION"),
        ],
        "CREDIT CARD",
    ),
    "ENTITY_NAME": Ladder(
        [
            ("%PAYMENT%THANK YOU%", "CITI BANK"),
            ("COSTCO GAS %", "COSTCO GAS"),
            ("COSTCO WHSE%", "COSTCO"),
            ("WWW COSTCO COM%", "COSTCO ONLINE"),
            ("USPS.COM%", "USPS ONLINE"),
            ("PROGRESSIVE *INSURANCE%", "PROGRESSIVE"),
        ],
        Part("merchant"),
    ),
    "GEOGRAPHY": Ladder(
        [("%PAYMENT%THANK YOU%", "ONLINE"), (regex(CITI_PLACE), Part("place"))], "ONLINE/TRANSFER"
    ),
    "DETAILED_CATEGORY": Ladder([], "MERCHANDISE"),
}
CITI = BankRules("CITI", ("%Citi%",), fields=_CITI, preview=_CITI)

# In the order a full refresh runs them.
BANKS = {b.bank: b for b in (AXIS, WELLSFARGO, AMEX, DISCOVER, CAPITALONE, APPLE, CITI)}

# The short channel list of the spend report.
REPORT_CHANNEL = Ladder(
    [("POS/%", "DEBIT CARD"), ("UPI/%", "UPI"), ("IMPS/%", "IMPS"), ("ATM-%", "CASH")], "OTHERS"
)
REPORT_MERCHANT = Ladder(
    [("POS/%", Part("slash_2")), (["UPI/%", "IMPS/%"], Part("slash_4"))], "GENERAL"
)
