"""Access to values inside VARIANT documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_at(document: Column, path: str) -> Column:
    """Value at a path as text: numbers and booleans are spelled out, JSON null and absence give NULL."""
    return F.try_variant_get(document, path, "string")


def whole_number(text: Column) -> Column:
    """Number rounded half up to no decimals; NULL when the text is no number or needs over 18 digits."""
    return text.try_cast("decimal(18,0)")
