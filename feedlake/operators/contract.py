"""Header check of every delivered file against its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.text import pipe_parts
from feedlake.schemas import ContractError, FeedContract

FIELD_COUNT = "HEADER_FIELD_COUNT"
RECORD_TYPE = "HEADER_RECORD_TYPE"
NAMES = "HEADER_NAMES"


def check_contract(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """Files whose first line is not the declared header, with the first violation found.

    The field count is checked first, then the line type, then the names, which
    must be equal in spelling, case and order.
    """
    parts = pipe_parts(F.col("raw_record"))
    names = F.array(*(F.lit(name) for name in contract.header))
    violation = (
        F.when(F.size(parts) != contract.field_count + 2, FIELD_COUNT)
        .when(F.get(parts, 1) != contract.header_type, RECORD_TYPE)
        .when(F.slice(parts, 3, contract.field_count) != names, NAMES)
    )
    return (
        raw.where("source_row_number = 1")
        .select("batch_id", "source_file_name", violation.alias("violation"))
        .where("violation is not null")
    )


def require_contract(raw: DataFrame, contract: FeedContract) -> None:
    """Raise if any file violates the contract, with the number of such files and a few of their names."""
    found = check_contract(raw, contract)
    told = found.groupBy("violation").agg(F.count("*").alias("files"), F.min(F.concat_ws(": ", "source_file_name", "violation")).alias("example"))
    rows = told.orderBy("violation").collect()  # at most one row per kind of violation
    if rows:
        named = ", ".join(f"{row.example} and {row.files - 1} more" if row.files > 1 else row.example for row in rows)
        raise ContractError(f"{sum(row.files for row in rows)} files do not follow contract version {contract.version} ({named})")
