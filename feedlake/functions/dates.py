"""Strict date parsing and as-of-date attributes."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schemas import STALE_AFTER_DAYS


def strict_date(text: Column, fmt: str) -> Column:
    """Date of a text that has exactly the pattern's length and names a real day, else NULL.

    The length test rejects signed years, which the parser alone would accept.
    """
    return F.when(F.length(text) == len(fmt), F.try_to_date(text, fmt))


def batch_date(batch_id: Column) -> Column:
    return F.to_date(batch_id, "yyyyMMdd")


def check_batch_id(batch_id: str) -> date:
    """The day a batch id stands for; raises unless it is eight digits naming a real day."""
    if not re.fullmatch(r"[0-9]{8}", batch_id):
        raise ValueError(f"batch id {batch_id!r} is not of the form YYYYMMDD")
    try:
        return datetime.strptime(batch_id, "%Y%m%d").date()
    except ValueError as error:
        raise ValueError(f"batch id {batch_id!r} names no calendar day") from error


def age_at(born: Column, as_of: Column) -> Column:
    """Completed years; someone born on 29 February has the birthday on 28 February in other years."""
    years = F.year(as_of) - F.year(born)
    return years - F.when(F.add_months(born, years * 12) > as_of, 1).otherwise(0)


def stale_at(last: Column, as_of: Column, days: int = STALE_AFTER_DAYS) -> Column:
    """Whether `last` lies more than `days` days back; NULL when there is no date."""
    return F.datediff(as_of, last) > days
