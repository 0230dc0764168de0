"""Ordered match rules held as data and folded into one CASE expression.

A rule is ``(conditions, result)``.  A condition is a LIKE pattern on the
description, or a ``Match`` on another column or of another kind.  A result is
a literal text, or a ``Part`` naming an expression that the bank's miner
supplies.  Keeping the rules as plain data lets the same tables drive the
DataFrame expression and the SQL used to check it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from ledgerloom.functions.text import any_of


@dataclass(frozen=True)
class Match:
    pattern: str
    column: str = "DESCRIPTION"
    kind: str = "like"


@dataclass(frozen=True)
class Part:
    name: str


@dataclass(frozen=True)
class Ladder:
    """Rules tried in order; ``default`` applies when none matches."""

    rules: list = field(default_factory=list)
    default: object = None


def conditions_of(rule) -> list[Match]:
    raw = rule[0]
    items = raw if isinstance(raw, (list, tuple)) else [raw]
    return [Match(i) if isinstance(i, str) else i for i in items]


def _test(match: Match, found: dict[str, Column]) -> Column:
    """``_FOLDED_<column>`` holds the upper-cased text; ``found`` the first match of patterns already searched."""
    if match.pattern in found:
        return found[match.pattern].isNotNull()
    if match.kind == "regex":
        return F.col(match.column).rlike("(?i)" + match.pattern)
    folded = F.col("_FOLDED_" + match.column)
    if match.kind == "equals":
        return folded == match.pattern
    return folded.like(match.pattern)


def _result(result, parts: dict[str, Column]) -> Column:
    if isinstance(result, Part):
        return parts[result.name]
    return F.lit(result).cast("string")


def first_match(ladder: Ladder, parts: dict[str, Column], found: dict[str, Column] | None = None) -> Column:
    chain = F
    for rule in ladder.rules:
        chain = chain.when(any_of(_test(m, found or {}) for m in conditions_of(rule)), _result(rule[1], parts))
    default = _result(ladder.default, parts)
    return default if chain is F else chain.otherwise(default)
