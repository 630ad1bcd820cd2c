"""Data-quality rules: every rule is evaluated, every reason is kept."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.schemas import ACTIVE_FLAGS, COUNTRIES, REDEMPTION_STATUSES, FeedContract

SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """A reason and the condition under which it applies; a NULL condition does not apply."""

    name: str
    condition: Column


def missing(name: str) -> Rule:
    return Rule(f"{name.upper()}_MISSING", F.col(name).isNull())


def missing_date(name: str) -> Rule:
    return Rule(f"{name.upper()}_MISSING", F.col(f"{name}_raw").isNull())


def invalid_date(name: str) -> Rule:
    return Rule(f"{name.upper()}_INVALID", F.col(f"{name}_raw").isNotNull() & F.col(name).isNull())


def outside(name: str, domain: Iterable[str], suffix: str = "INVALID") -> Rule:
    return Rule(f"{name.upper()}_{suffix}", ~F.col(name).isin(*domain))


def too_long(name: str, limit: int) -> Rule:
    return Rule(f"{name.upper()}_TOO_LONG", F.length(name) > limit)


def member_rules(contract: FeedContract) -> list[Rule]:
    """Rules of a parsed member line, in the order in which their reasons are listed."""
    return [
        Rule("FIELD_COUNT_MISMATCH", F.col("source_field_count") != contract.field_count),
        missing("member_name"),
        missing("member_id"),
        missing_date("enrollment_date"),
        invalid_date("enrollment_date"),
        invalid_date("last_flight_date"),
        invalid_date("dob"),
        missing("country"),
        outside("country", COUNTRIES, "UNSUPPORTED"),
        missing("is_active"),
        outside("is_active", ACTIVE_FLAGS),
        *(too_long(field.name, field.max_length) for field in contract.fields if field.max_length),
    ]


def redemption_rules() -> list[Rule]:
    """Rules of a flattened transaction that carries `txn_id_rows` and `member_known`."""
    return [
        missing("member_id"),
        missing("txn_id"),
        Rule("TXN_DATE_INVALID_OR_MISSING", F.col("txn_date").isNull()),
        Rule("FEED_DATE_INVALID_OR_MISSING", F.col("feed_date").isNull()),
        Rule("MILES_REDEEMED_INVALID", F.col("miles_redeemed").isNull() | (F.col("miles_redeemed") < 0)),
        Rule("STATUS_INVALID", F.col("status").isNull() | ~F.col("status").isin(*REDEMPTION_STATUSES)),
        missing("partner"),
        Rule("DUPLICATE_TXN_ID", F.col("txn_id_rows") > 1),
        Rule("MEMBER_NOT_FOUND", F.col("member_id").isNotNull() & ~F.col("member_known")),
    ]


def evaluate(df: DataFrame, rules: Sequence[Rule], sep: str = SEPARATOR) -> DataFrame:
    """Add `dq_reason`, all reasons that apply or NULL, and `is_valid`."""
    reasons = F.concat_ws(sep, *(F.when(rule.condition, F.lit(rule.name)) for rule in rules))
    return df.withColumn("dq_reason", F.nullif(reasons, F.lit(""))).withColumn("is_valid", F.col("dq_reason").isNull())


def split_valid(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid and the rejected rows."""
    return evaluated.where("is_valid"), evaluated.where("not is_valid")


def reason_counts(evaluated: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """How many rows each reason applies to."""
    return (
        evaluated.where("dq_reason is not null")
        .select(F.explode(F.split("dq_reason", sep)).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("hits"))
    )
