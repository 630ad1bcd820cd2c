"""Declared shapes: the member feed contract, value domains and table schemas.

Nothing here is inferred from data. A file that does not have the declared
shape is a contract violation, a value outside its domain a data-quality reason.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

# Fixed values of the feeds.
COUNTRIES = ("USA", "IND", "PHIL", "CAN", "AU", "CHN", "BRA", "GBR", "JPN", "ARE", "FRA", "DEU", "SGP")
ACTIVE_FLAGS = ("A", "I")
REDEMPTION_STATUSES = ("COMPLETED", "PENDING", "CANCELLED")
DETAIL_TYPE = "D"
HEADER_TYPE = "H"
STALE_AFTER_DAYS = 90
ERROR_TEXT_LIMIT = 4000


class ContractError(ValueError):
    """A contract is inconsistent, or a delivered file does not follow it."""


@dataclass(frozen=True)
class Field:
    """One positional field of a delimited line."""

    name: str
    header: str
    date_format: str | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class FeedContract:
    """Positional contract of a pipe-delimited feed with a header line per file."""

    version: int
    field_count: int
    fields: tuple[Field, ...]
    header: tuple[str, ...]
    record_type: str = DETAIL_TYPE
    header_type: str = HEADER_TYPE

    def __post_init__(self) -> None:
        for what, values in (("header", self.header), ("fields", self.fields)):
            if len(values) != self.field_count:
                raise ContractError(f"{what} has {len(values)} entries, the contract says {self.field_count}")

    @classmethod
    def of(cls, version: int, fields: tuple[Field, ...], **kwargs) -> FeedContract:
        return cls(version, len(fields), fields, tuple(f.header for f in fields), **kwargs)

    @classmethod
    def from_mapping(cls, spec: Mapping) -> FeedContract:
        """Build a contract from a parsed configuration document."""
        absent = {"version", "record_type", "expected_field_count", "expected_header", "fields"} - set(spec)
        if absent:
            raise ContractError(f"contract lacks {', '.join(sorted(absent))}")
        for number, field in enumerate(spec["fields"], start=1):
            if missing := {"name", "position"} - set(field):
                raise ContractError(f"field {number} of the contract lacks {', '.join(sorted(missing))}")
        formats = spec.get("date_formats") or {}
        header = tuple(spec["expected_header"])
        ordered = sorted(spec["fields"], key=lambda f: f["position"])
        fields = tuple(
            Field(f["name"], title, _spark_date_format(formats.get(f["name"])), f.get("max_length"))
            for f, title in zip(ordered, header)
        )
        if len(ordered) != len(header):
            raise ContractError(f"contract declares {len(ordered)} fields but {len(header)} header names")
        return cls(spec["version"], spec["expected_field_count"], fields, header, spec["record_type"])


def _spark_date_format(strftime: str | None) -> str | None:
    if strftime is None:
        return None
    for code, letters in (("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd")):
        strftime = strftime.replace(code, letters)
    return strftime


# The member feed's header, positions and lengths.
MEMBER_CONTRACT = FeedContract.of(
    1,
    (
        Field("member_name", "Member_Name", max_length=255),
        Field("member_id", "Member_Id", max_length=18),
        Field("enrollment_date", "Enrollment_Date", date_format="yyyyMMdd"),
        Field("last_flight_date", "Last_Flight_Date", date_format="yyyyMMdd"),
        Field("tier_code", "Tier_Code", max_length=5),
        Field("agent_name", "Agent_Name", max_length=255),
        Field("state", "State", max_length=5),
        Field("country", "Country", max_length=5),
        Field("dob", "DOB", date_format="ddMMyyyy"),
        Field("is_active", "Is_Active"),
    ),
)


@dataclass(frozen=True)
class FeedSource:
    """Where a feed is delivered: `<landing>/<folder>/<batch_id>/`, files matching `pattern`.

    With `whole_file`, each file is one document instead of one per line.
    """

    folder: str
    pattern: str
    whole_file: bool = False


MEMBER_SOURCE = FeedSource("member", r".*member_profile_feed\.csv")
REDEMPTION_SOURCE = FeedSource("redemption", r".*redemptions\.json")

# Columns that decide whether two rows of one member and version agree.
MEMBER_ATTRIBUTES = (
    "member_name",
    "enrollment_date",
    "last_flight_date",
    "tier_code",
    "agent_name",
    "state",
    "country",
    "dob",
    "is_active",
    "age",
    "stale_member",
)
LINEAGE = ("batch_id", "source_file_name", "source_row_number")

_LINEAGE_DDL = "batch_id string, source_file_name string, source_row_number bigint"
_STAMPS_DDL = "source_feed_timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz"
_MEMBER_DDL = (
    "member_name string, enrollment_date date, last_flight_date date, tier_code string, agent_name string,"
    " state string, country string, dob date, is_active string, age int, stale_member boolean"
)
_TXN_DDL = "txn_id string, txn_date date, partner string, miles_redeemed decimal(18,0), status string"

RAW_MEMBER = f"record_type string, raw_record string, {_LINEAGE_DDL}, {_STAMPS_DDL}"
RAW_REDEMPTION = f"raw_text string, raw_record variant, {_LINEAGE_DDL}, {_STAMPS_DDL}"
MEMBER_EVALUATED = (
    f"{_LINEAGE_DDL}, record_type string, source_field_count int, raw_record string, member_id string, {_MEMBER_DDL},"
    f" {_STAMPS_DDL}, dq_reason string, is_valid boolean"
)
MEMBER_STAGING = (
    f"{_LINEAGE_DDL}, record_type string, source_field_count int, raw_record string, member_id string, {_MEMBER_DDL},"
    f" {_STAMPS_DDL}"
)
DQ_QUARANTINE = (
    f"{_LINEAGE_DDL}, record_type string, source_field_count int, raw_record string, dq_reason string, {_STAMPS_DDL}"
)
MEMBER_CURRENT = (
    f"member_id string, {_MEMBER_DDL}, source_feed_timestamp timestamp_ntz, {_LINEAGE_DDL},"
    " created_at timestamp_ntz, updated_at timestamp_ntz"
)
REDEMPTION_STAGING = (
    f"{_LINEAGE_DDL}, pos int, member_id string, feed_date date, {_TXN_DDL}, ingestion_timestamp timestamp_ntz"
)
REDEMPTION_EVALUATED = f"{REDEMPTION_STAGING}, dq_reason string, is_valid boolean"
REDEMPTION_QUARANTINE = (
    f"{_LINEAGE_DDL}, pos int, member_id string, {_TXN_DDL}, dq_reason string, ingestion_timestamp timestamp_ntz"
)
REDEMPTION = f"member_id string, feed_date date, {_TXN_DDL}, {_LINEAGE_DDL}, loaded_at timestamp_ntz"
LEDGER_EVENT = (
    "batch_id string, feed_type string, status string, event_at timestamp_ntz, rows_loaded bigint,"
    " rows_rejected bigint, error_message string"
)


def column_names(ddl: str) -> list[str]:
    """Top-level column names of one of the DDL strings above, in order."""
    flat = ddl.replace("decimal(18,0)", "decimal")
    return [part.split()[0] for part in flat.split(",")]


def without_column(ddl: str, name: str) -> str:
    """One of the DDL strings above less a column, such as the one that folders are named by."""
    return ", ".join(part for part in re.split(r",\s*(?![^(]*\))", ddl) if part.split()[0] != name)
