"""Competing versions of a business key: conflicts within a version, latest across versions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.operators.keyed import HOT_ROWS, attach

CONFLICT_REASON = "MEMBER_ID_SAME_VERSION_CONFLICT"


def conflicts(df: DataFrame, key: str, version: str, compare: list[str], rows: str = "key_rows") -> DataFrame:
    """Key and version pairs whose rows do not all agree on `compare`, with their row counts.

    NULL equals NULL and differs from any value. Rows are told apart by two 64-bit fingerprints, of which the least and the
    greatest per pair are kept: a hash aggregation of fixed width with one shuffle, whatever the number and
    size of the columns. Rows with different fingerprints differ; rows that differ have both alike with a chance of 2^-128.
    """
    prints = fingerprints(compare)
    ends = [end(value).alias(f"_{name}{number}") for number, value in enumerate(prints) for name, end in (("low", F.min), ("high", F.max))]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key, version)
        .agg(F.count("*").alias(rows), *ends)
        .where(" or ".join(f"_low{number} <> _high{number}" for number in range(len(prints))))
        .select(key, version, rows)
    )


def fingerprints(columns: list[str]) -> list[Column]:
    """Two independent hashes of a row's values; which of them are NULL is hashed too, as a hash passes over NULLs."""
    absent = reduce(add, (F.col(name).isNull().cast("long") * F.lit(1 << place) for place, name in enumerate(columns)))
    return [F.xxhash64(F.lit(seed), absent, *columns) for seed in ("first", "second")]


def split_conflicts(
    df: DataFrame, conflicting: DataFrame, key: str, version: str, rows: str = "key_rows", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows of conflicting versions, labelled with the reason, and all other rows that have a key."""
    marked = attach(df.where(F.col(key).isNotNull()), conflicting, [key, version], rows, hot_rows)
    bad = marked.where(F.col(rows).isNotNull()).drop(rows).withColumn("dq_reason", F.lit(CONFLICT_REASON))
    return bad, marked.where(F.col(rows).isNull()).drop(rows)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark limits each key to one row before the shuffle, so a hot key costs one
    row per task. The order should be total.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_members(rows: DataFrame) -> DataFrame:
    """Latest row per member; identical copies are told apart by file and line."""
    return latest(
        rows, ["member_id"], [F.desc("source_feed_timestamp"), F.asc("source_file_name"), F.asc("source_row_number")]
    )
