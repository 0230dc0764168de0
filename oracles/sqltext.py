"""Small SQL text builders for the checking queries."""

from __future__ import annotations

from ledgerloom.fixtures import TABLE_SQL, check_sql, landing_sql
from ledgerloom.functions.rules import Ladder, Part, conditions_of


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def table(name: str) -> str:
    return f"({check_sql(TABLE_SQL[name])})"


def landing(bank: str) -> str:
    return f"({check_sql(landing_sql(bank))})"


def field(text: str, delimiter: str, n: int) -> str:
    """n-th field from the left, the last one where there are fewer."""
    split = f"string_split({text}, {quote(delimiter)})"
    return f"{split}[least({n}, len({split}))]"


def head(text: str, delimiter: str, n: int = 1) -> str:
    return f"array_to_string(string_split({text}, {quote(delimiter)})[1:{n}], {quote(delimiter)})"


def tail(text: str, delimiter: str, n: int = 1) -> str:
    return f"array_to_string(string_split({text}, {quote(delimiter)})[-{n}:], {quote(delimiter)})"


def without(text: str, words: list[str]) -> str:
    for word in words:
        text = f"replace({text}, {quote(word)}, '')"
    return text


def strip_pattern(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {quote('(?i)' + pattern)}, {quote(by)}, 'g')"


def find_pattern(text: str, pattern: str) -> str:
    return f"nullif(regexp_extract({text}, {quote('(?i)' + pattern)}, 0), '')"


def _test(m) -> str:
    if m.kind == "regex":
        return f"regexp_matches({m.column}, {quote('(?i)' + m.pattern)})"
    sign = "=" if m.kind == "equals" else "LIKE"
    return f"upper({m.column}) {sign} {quote(m.pattern)}"


def ladder(rules: Ladder, parts: dict[str, str]) -> str:
    def result(value):
        if isinstance(value, Part):
            return parts[value.name]
        return "CAST(NULL AS VARCHAR)" if value is None else quote(value)

    arms = "".join(
        f" WHEN {' OR '.join(_test(m) for m in conditions_of(r))} THEN {result(r[1])}" for r in rules.rules
    )
    return f"CASE{arms} ELSE {result(rules.default)} END" if arms else result(rules.default)
