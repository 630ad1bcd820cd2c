"""The stages of a batch as functions from frames to frames, without storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.dates import age_at, batch_date, stale_at
from feedlake.operators.keyed import HOT_ROWS, absent_keys, attach, key_sizes
from feedlake.operators.merge import upsert
from feedlake.operators.parse import parse_lines
from feedlake.operators.rules import evaluate, member_rules, redemption_rules, split_valid
from feedlake.schemas import (
    DQ_QUARANTINE,
    MEMBER_CONTRACT,
    MEMBER_CURRENT,
    MEMBER_EVALUATED,
    MEMBER_STAGING,
    REDEMPTION,
    REDEMPTION_EVALUATED,
    REDEMPTION_QUARANTINE,
    FeedContract,
    column_names,
)
from feedlake.sources.scratch import materialise


def evaluate_members(raw: DataFrame, contract: FeedContract = MEMBER_CONTRACT) -> DataFrame:
    """Every detail line typed, judged by all rules, with age and staleness as of its own batch day."""
    as_of = batch_date(F.col("batch_id"))
    judged = evaluate(parse_lines(raw, contract), member_rules(contract)).withColumns(
        {"age": age_at(F.col("dob"), as_of), "stale_member": stale_at(F.col("last_flight_date"), as_of)}
    )
    return judged.select(column_names(MEMBER_EVALUATED))


def member_staging(evaluated: DataFrame) -> DataFrame:
    return split_valid(evaluated)[0].select(column_names(MEMBER_STAGING))


def member_quarantine(evaluated: DataFrame, conflicting_rows: DataFrame) -> DataFrame:
    """Rejected lines with all their reasons, and valid lines in conflict with one another."""
    columns = column_names(DQ_QUARANTINE)
    return split_valid(evaluated)[1].select(columns).unionByName(conflicting_rows.select(columns))


def merge_members(
    current: DataFrame | None, latest_rows: DataFrame, run_ts: Column | None = None, unique: bool = False
) -> DataFrame:
    """Current state after a batch: a member's row gives way only to a newer version."""
    stamps = {"created_at", "updated_at"}
    source = latest_rows.select([name for name in column_names(MEMBER_CURRENT) if name not in stamps])
    return upsert(
        current,
        source,
        ["member_id"],
        version="source_feed_timestamp",
        run_ts=run_ts,
        inserted_at="created_at",
        updated_at="updated_at",
        unique=unique,
    )


def evaluate_redemptions(
    flattened: DataFrame,
    members: DataFrame | Sequence[DataFrame],
    member: Sequence[str] = ("member_id",),
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Flattened transactions judged by all rules.

    All copies of a transaction id within a batch are rejected, and so are
    transactions of members that are not in `members`, nor in any of them if there are several. Both facts are found per
    key from the key columns alone, written, and then brought to the rows, which are read once. With `member`
    as batch and member id, each batch has members of its own. `buckets` is the number of buckets in which members lie.
    """
    txn, member = ["batch_id", "txn_id"], list(member)
    repeated = materialise(key_sizes(flattened, txn, "txn_id_rows").where("txn_id_rows > 1"), "repeated-txns")
    unknown = materialise(absent_keys(flattened, members, member, "unknown_rows", buckets), "unknown-members")
    marked = attach(attach(flattened, repeated, txn, "txn_id_rows", hot_rows), unknown, member, "unknown_rows", hot_rows)
    judged = evaluate(marked.withColumn("member_known", F.col("unknown_rows").isNull()), redemption_rules())
    return judged.select(column_names(REDEMPTION_EVALUATED))


def redemption_quarantine(evaluated: DataFrame) -> DataFrame:
    return split_valid(evaluated)[1].select(column_names(REDEMPTION_QUARANTINE))


def accepted_redemptions(evaluated: DataFrame) -> DataFrame:
    return split_valid(evaluated)[0].select([name for name in column_names(REDEMPTION) if name != "loaded_at"])


def merge_redemptions(
    curated: DataFrame | None, accepted: DataFrame, run_ts: Column | None = None, unique: bool = False
) -> DataFrame:
    """Curated transactions after a batch: the batch processed last wins."""
    return upsert(curated, accepted, ["txn_id"], run_ts=run_ts, inserted_at="loaded_at", unique=unique)
