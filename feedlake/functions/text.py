"""Pieces of pipe-delimited lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pipe_parts(line: Column) -> Column:
    """All parts of a line; part 0 is the empty text before the leading pipe."""
    return F.split(line, r"\|")


def blank_to_null(text: Column) -> Column:
    """Text without surrounding spaces; NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def record_type(line: Column) -> Column:
    return F.split_part(line, F.lit("|"), F.lit(2))


def without_carriage_return(line: Column) -> Column:
    return F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)
