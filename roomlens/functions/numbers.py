"""Numeric expressions as SQL text: text to number, ratios, rounding, money."""

from __future__ import annotations

# Money is summed as a decimal so that totals do not depend on the order of addition.
MONEY = "decimal(30,6)"

# Plain decimal and exponent notation; rejects suffixed forms such as "1d" that a cast accepts.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def text_to_double(text: str) -> str:
    """Number written in ``text``; null when it is not a finite number."""
    value = f"try_cast({text} AS DOUBLE)"
    return (
        f"CASE WHEN {text} RLIKE r'{NUMERIC_TEXT}' AND abs({value}) < DOUBLE('Infinity') "
        f"THEN {value} END"
    )


def ratio_pct(part: str, whole: str) -> str:
    """``part / whole * 100``; null when ``whole`` is zero or null."""
    return f"(try_divide(DOUBLE({part}), DOUBLE({whole})) * 100D)"


def rate_pct(part: str, whole: str) -> str:
    """``part * 100 / whole`` rounded half up to 2 digits, as the SQL views report rates."""
    return f"round(try_divide(DOUBLE({part}) * 100D, DOUBLE({whole})), 2)"


def half_even(value: str, digits: int) -> str:
    """Round half to even by scaling, the rule of array libraries; adding 0 turns -0 into 0."""
    if digits == 0:
        return f"(rint({value}) + 0D)"
    scale = f"{10**digits}D"
    return f"(rint(({value}) * {scale}) / {scale} + 0D)"


def money(value: str) -> str:
    """Exact amount; one beyond the type fails instead of leaving a sum unnoticed."""
    return f"CAST({value} AS {MONEY})"
