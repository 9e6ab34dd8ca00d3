"""List literals of the catalogue: read as the language that wrote them would read them."""

from __future__ import annotations

import ast
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_QUOTES = "'\""


def _parsed(text: str | None) -> Any:
    try:
        return ast.literal_eval(str(text))
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


def _entry(items: Any, index: int) -> str | None:
    """Entry as cleaning takes it: a text without white space and quotes around it, else null."""
    try:
        return items[index].strip().strip(_QUOTES) if len(items) > index else None
    except (TypeError, AttributeError, KeyError):
        return None


def _shown(items: Any, index: int, other: int | None = None) -> str | None:
    """Entry as the exploration shows it: as it is; without one, entry ``other``."""
    try:
        found = items[index] if len(items) > index else None if other is None else items[other]
    except (TypeError, KeyError, IndexError):
        return None
    return None if found is None else str(found)


def entries(text: str | None) -> tuple[str | None, str | None, str | None, str | None]:
    """Main and sub category of a category list, as cleaned and as shown."""
    items = _parsed(text)
    return _entry(items, 1), _entry(items, 2), _shown(items, 1, 0), _shown(items, 2)


_PARTS = ("main", "sub", "shown_main", "shown_sub")


@F.pandas_udf(StructType([StructField(part, StringType()) for part in _PARTS]))
def category_entries(texts: pd.Series) -> pd.DataFrame:
    known = {text: entries(text) for text in texts.unique()}
    return pd.DataFrame([known[text] for text in texts], columns=list(_PARTS))
