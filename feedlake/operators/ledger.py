"""Run ledger: appended events, and the state they add up to."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.schemas import ERROR_TEXT_LIMIT, LEDGER_EVENT
from feedlake.sources.scratch import append_rows, read_or_empty

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
# Columns of the ledger that a run over whole folders has no single value for.
UNFILLED = {
    "source_file_name": "string",
    "source_feed_timestamp": "timestamp_ntz",
    "file_size_bytes": "bigint",
    "file_checksum": "string",
}


def ledger_event(
    spark: SparkSession,
    path: str,
    batch_id: str,
    feed_type: str,
    status: str,
    rows_loaded: int | None = None,
    rows_rejected: int | None = None,
    error: str | None = None,
) -> None:
    """Append one event, timed in UTC; each is a file of its own, so that events never overwrite each other."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    text = None if error is None else error[:ERROR_TEXT_LIMIT]
    event = (batch_id, feed_type, status, now, rows_loaded, rows_rejected, text)
    append_rows(spark, path, [event], LEDGER_EVENT)


def ledger_state(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch and feed: its latest run.

    A new start clears the end time, the counts and the error of an earlier run.
    """
    events = read_or_empty(spark, "json", path, LEDGER_EVENT)
    last = F.max_by(F.struct("status", "event_at", "rows_loaded", "rows_rejected", "error_message"), F.col("event_at"))
    state = events.groupBy("batch_id", "feed_type").agg(
        last.alias("last"),
        F.max(F.when(F.col("status") == RUNNING, F.col("event_at"))).alias("started_at"),
        F.min("event_at").alias("created_at"),
    )
    ended = F.col("last.status") != RUNNING
    return state.select(
        "batch_id",
        "feed_type",
        *(F.lit(None).cast(kind).alias(name) for name, kind in UNFILLED.items()),
        F.col("last.status").alias("status"),
        "started_at",
        F.when(ended, F.col("last.event_at")).alias("completed_at"),
        F.col("last.rows_loaded").alias("rows_loaded"),
        F.col("last.rows_rejected").alias("rows_rejected"),
        F.col("last.error_message").alias("error_message"),
        "created_at",
    )
