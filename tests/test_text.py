"""Edge rows of the text, number and date helpers."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.ids import hash_id


def value(spark, text, build):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(build(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("0", "0.0000"), ("-0.004", "-0.0040"), ("12abc", "12.0000"), ("1,234.50", "1.0000"), ("  7.5 ", "7.5000"),
        ("", None), ("abc", None), (None, None), ("+3", "3.0000"), (".5", "0.5000"), ("1e3", "1000.0000"),
        ("1.00005", "1.0001"), ("-1.00005", "-1.0001"), ("99999999999999999999", None),
    ],
)
def test_number_reads_the_leading_number(spark, text, expected):
    got = value(spark, text, lambda c: X.number(c, 19, 4))
    assert got == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    ("text", "pattern", "expected"),
    [
        ("1/5/2025", "M/d/yyyy", datetime(2025, 1, 5)), ("01/05/2025", "M/d/yyyy", datetime(2025, 1, 5)),
        ("13/45/2025", "M/d/yyyy", None), ("", "M/d/yyyy", None), (None, "M/d/yyyy", None),
        ("05-01-2025", "d-M-yyyy", datetime(2025, 1, 5)), ("2025-01-05", "yyyy-M-d", datetime(2025, 1, 5)),
    ],
)
def test_date_text(spark, text, pattern, expected):
    assert value(spark, text, lambda c: X.date_text(c, pattern)) == expected


@pytest.mark.parametrize(
    ("text", "n", "expected"),
    [("A/B/C", 2, "B"), ("A/B/C", 9, "C"), ("ABC", 2, "ABC"), ("A//C", 2, ""), (None, 2, None)],
)
def test_nth_field(spark, text, n, expected):
    assert value(spark, text, lambda c: X.nth_field(c, "/", n)) == expected


def test_delimiters_are_cut_from_the_right(spark):
    assert value(spark, "A   B", lambda c: X.after_last(c, "  ")) == "B"
    assert value(spark, "A REF # B C", lambda c: X.between(c, " REF # ", " ")) == "B"
    assert value(spark, "a b c d", lambda c: X.tail_field(c, " ", 3)) == "b"
    assert value(spark, "a b c d", lambda c: X.tail_field(c, " ", 3, 2)) == "b c"


@pytest.mark.parametrize(("size", "expected"), [(1, ""), (2, "AB"), (3, "BC")])
def test_position_zero_gives_empty_text(spark, size, expected):
    text = "ABC"[:size]
    assert value(spark, text, lambda c: X.from_position(c, X.byte_length(c) - 1)) == expected


def test_blank_tests(spark):
    for text, filled, not_blank in [(None, False, False), ("", False, False), ("  ", True, False), ("x", True, True)]:
        assert bool(value(spark, text, X.filled)) is filled
        assert bool(value(spark, text, X.not_blank)) is not_blank


@pytest.mark.parametrize(
    ("number", "expected"),
    [("12.0000", "12"), ("45.1000", "45.1"), ("0.0000", "0"), ("123456785.0000", "123456785"), ("100.0000", "100")],
)
def test_plain_number_text(spark, number, expected):
    assert value(spark, number, lambda c: X.plain_number_text(c.cast("decimal(19,4)"))) == expected


def test_regex_helpers_ignore_case_and_give_null(spark):
    assert value(spark, "abc 123", lambda c: X.regex_first(c, "[A-Z]+")) == "abc"
    assert value(spark, "123", lambda c: X.regex_first(c, "[A-Z]+")) is None
    assert value(spark, "xYx", lambda c: X.regex_drop(c, "x")) == "Y"


def test_hash_id_is_positive_and_keeps_null(spark):
    import hashlib

    for text in ("", "a", "statement 1", "é"):
        raw = int(hashlib.md5(text.encode()).hexdigest()[:16], 16)
        signed = raw - 2**64 if raw >= 2**63 else raw
        assert value(spark, text, hash_id) == abs(signed)
    assert value(spark, None, hash_id) is None
