"""Column helpers that give the text semantics of the statement data.

The data is compared without regard to case, cut by delimiters that are case
sensitive, and holds numbers as free text.  Everything here is a plain column
expression and stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: a number at the start of a text, as a lenient cast reads it.
LEADING_NUMBER = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def filled(col: Column) -> Column:
    """Neither NULL nor empty."""
    return col.isNotNull() & (col != "")


def not_blank(col: Column) -> Column:
    """Neither NULL nor made of spaces only."""
    return col.isNotNull() & (F.trim(col) != "")


#: Session setting that names the collation under which all names are compared, for instance UNICODE_CI_AI.
NAME_COLLATION = "spark.ledgerloom.nameCollation"


def fold(col: Column, collation: str | None = None) -> Column:
    """Key for comparing names: upper case, or the text under a collation given here or by the session.

    Under UNICODE_CI_AI neither case nor accents count, as in the row store that the statements came from.  Keys of
    different collations cannot be compared, so one job uses one.
    """
    session = SparkSession.getActiveSession()
    chosen = collation or (session.conf.get(NAME_COLLATION, None) if session else None)
    return F.collate(col, chosen) if chosen else F.upper(col)


def same_name(col: Column, value: str) -> Column:
    return fold(col) == fold(F.lit(value))


def name_holds(col: Column, word: str) -> Column:
    return fold(col).contains(fold(F.lit(word)))


def clean_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


def nth_field(col: Column, delimiter: str, n: int) -> Column:
    """Field ``n`` counted from the left; a text with fewer fields gives its last one."""
    return F.substring_index(F.substring_index(col, delimiter, n), delimiter, -1)


def before(col: Column, delimiter: str, count: int = 1) -> Column:
    return F.substring_index(col, delimiter, count)


def after_last(col: Column, delimiter: str) -> Column:
    return F.substring_index(col, delimiter, -1)


def between(col: Column, start: str, end: str) -> Column:
    """Text after the last ``start`` and up to the next ``end``."""
    return before(after_last(col, start), end)


def tail_field(col: Column, delimiter: str, from_right: int, width: int = 1) -> Column:
    """``width`` fields beginning at the ``from_right``-th field from the right."""
    return F.substring_index(F.substring_index(col, delimiter, -from_right), delimiter, width)


def from_position(col: Column, position: Column, length: Column | None = None) -> Column:
    """Substring by 1-based position where position 0 gives an empty text.

    Spark reads position 0 as 1, so it is guarded here; a length below one gives ''.
    """
    size = length if length is not None else F.lit(2**31 - 1)
    return F.when(position == 0, F.lit("")).otherwise(F.substring(col, position, size))


def byte_length(col: Column) -> Column:
    return F.octet_length(col)


def drop_all(col: Column, words: Iterable[str]) -> Column:
    """Remove every occurrence of each word, case sensitive, in the order given."""
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), words, col)


def regex_drop(col: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(col, "(?i)" + pattern, replacement)


def regex_first(col: Column, pattern: str) -> Column:
    """First match, NULL where there is none."""
    return F.regexp_substr(col, F.lit("(?i)" + pattern))


def number(col: Column, precision: int, scale: int) -> Column:
    """Leading number of a text as a decimal, rounded half up; NULL where there is none."""
    return F.regexp_extract(col, LEADING_NUMBER, 1).try_cast(f"decimal({precision},{scale})")


def plain_number_text(value: Column) -> Column:
    """A decimal as text without trailing zeros: 12.00 -> '12', 45.10 -> '45.1'."""
    text = value.cast("string")
    trimmed = F.regexp_replace(text, r"0+$", "")
    return F.when(F.instr(text, ".") > 0, F.regexp_replace(trimmed, r"\.$", "")).otherwise(text)


def date_text(col: Column, pattern: str) -> Column:
    """Text to timestamp by a date pattern, NULL on bad input."""
    return F.try_to_date(col, pattern).cast("timestamp_ntz")


def moment(at: datetime) -> Column:
    """A point in time without zone, whatever zones the session and the driver are in."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
