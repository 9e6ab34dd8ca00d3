"""Text expressions for catalogue fields, as SQL text."""

from __future__ import annotations


def literal(value: str) -> str:
    """``value`` as an SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """``column`` as a quoted SQL name."""
    return "`" + column.replace("`", "``") + "`"


def strip(text: str) -> str:
    """Remove white space of any kind from both ends."""
    return rf"regexp_replace({text}, r'^\s+|\s+$', '')"


def title_case(text: str) -> str:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    words = rf"split(lower({text}), r'(?<=[^\p{{L}}])')"
    return f"array_join(transform({words}, w -> concat(upper(substr(w, 1, 1)), substr(w, 2))), '')"
