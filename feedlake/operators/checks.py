"""Assertions over the tables a run leaves behind, each one row: check, status, violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.operators.keyed import absent_keys

PASS, FAIL = "PASS", "FAIL"


def verdict(name: str, violations: DataFrame) -> DataFrame:
    """One row telling whether `violations` is empty and how many rows it has."""
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"),
        F.when(F.col("violations") == 0, PASS).otherwise(FAIL).alias("status"),
        "violations",
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def misrouted(current: DataFrame, routed: DataFrame, key: str) -> DataFrame:
    """Keys that are in several partitions or, though current, in none."""
    several = routed.groupBy(key).agg(F.count("*").alias("copies")).where("copies <> 1").select(key)
    absent = current.select(key).join(routed.select(key), key, "left_anti")
    return several.union(absent).distinct()


def not_latest(current: DataFrame, eligible: DataFrame, staged: DataFrame, key: str, version: str) -> DataFrame:
    """Keys that are missing or held in a version that is older than the newest eligible one or was never staged.

    A held version need not be eligible any more: a later file of its day may have contradicted it, which leaves the
    accepted row in force.
    """
    newest = eligible.groupBy(key).agg(F.max(version).alias("_newest"))
    known = staged.select(key, F.col(version).alias("_held"), F.lit(True).alias("_known")).distinct()
    both = current.select(key, F.col(version).alias("_held")).join(newest, key, "full_outer")
    outdated = F.col("_held").isNull() | (F.col("_held") < F.col("_newest"))
    return both.join(known, [key, "_held"], "left").where(outdated | F.col("_known").isNull()).drop("_known")


def unmoved(moved: DataFrame, routed: DataFrame, key: str, by: str) -> DataFrame:
    """Moved keys that are not in their new partition, or still in the old one."""
    places = routed.select(key, F.col(by).alias("_place"))
    seen = (
        moved.join(places, key, "left")
        .groupBy(key, f"from_{by}", f"to_{by}")
        .agg(
            F.count_if(F.col("_place") == F.col(f"to_{by}")).alias("in_new"),
            F.count_if(F.col("_place") == F.col(f"from_{by}")).alias("in_old"),
        )
    )
    return seen.where("in_new <> 1 or in_old <> 0")


def reconcile(flattened: DataFrame, evaluated: DataFrame, curated: DataFrame) -> DataFrame:
    """Per batch: rows flattened, accepted and rejected, and accepted ones that are not in the curated table."""
    delivered = flattened.groupBy("batch_id").agg(F.count("*").alias("flattened"))
    judged = evaluated.groupBy("batch_id").agg(
        F.count_if("is_valid").alias("accepted"), F.count_if(~F.col("is_valid")).alias("quarantined")
    )
    lost = (
        evaluated.where("is_valid")
        .select("batch_id", "txn_id")
        .join(curated.select("txn_id"), "txn_id", "left_anti")
        .groupBy("batch_id")
        .agg(F.count("*").alias("lost"))
    )
    return (
        delivered.join(judged, "batch_id", "left")
        .join(lost, "batch_id", "left")
        .select(
            "batch_id",
            "flattened",
            F.coalesce("accepted", F.lit(0)).alias("accepted"),
            F.coalesce("quarantined", F.lit(0)).alias("quarantined"),
            F.coalesce("lost", F.lit(0)).alias("accepted_not_curated"),
        )
    )


def reconcile_members(raw: DataFrame, evaluated: DataFrame, conflicting: DataFrame) -> DataFrame:
    """Per batch: lines delivered, lines that are no details, and details accepted, rejected and in conflict."""
    delivered = raw.groupBy("batch_id").agg(F.count("*").alias("delivered"))
    judged = evaluated.groupBy("batch_id").agg(
        F.count("*").alias("details"),
        F.count_if("is_valid").alias("accepted"),
        F.count_if(~F.col("is_valid")).alias("rejected"),
    )
    clashing = conflicting.groupBy("batch_id").agg(F.count("*").alias("conflicting"))
    return (
        delivered.join(judged, "batch_id", "left")
        .join(clashing, "batch_id", "left")
        .select(
            "batch_id",
            "delivered",
            (F.col("delivered") - F.coalesce("details", F.lit(0))).alias("other_lines"),
            *(F.coalesce(name, F.lit(0)).alias(name) for name in ("accepted", "rejected", "conflicting")),
        )
    )


def unreconciled(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where("flattened <> accepted + quarantined or accepted_not_curated <> 0")


def unknown_member_accepted(evaluated: DataFrame, members: DataFrame) -> DataFrame:
    """Members that have accepted transactions but do not exist."""
    return absent_keys(evaluated.where("is_valid"), members, ["member_id"])


def run_twice(curated: DataFrame, evaluated: DataFrame) -> DataFrame:
    """What a run that repeats itself would leave twice: transactions in the curated table, rejected rows of a place in a document."""
    lineage = ["batch_id", "source_file_name", "source_row_number", "pos"]
    rejects = repeated_keys(evaluated.where("not is_valid"), lineage)
    return repeated_keys(curated, ["txn_id"]).select("copies").unionByName(rejects.select("copies"))


def check_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks over the published tables.

    Expects member_current, member_staging, member_eligible (staged rows free of conflicts),
    member_country, member_moved, redemption, redemption_staging and
    redemption_evaluated.
    """
    current, routed = tables["member_current"], tables["member_country"]
    curated, evaluated = tables["redemption"], tables["redemption_evaluated"]
    verdicts = [
        verdict("member_unique", repeated_keys(current, ["member_id"])),
        verdict("country_routing", misrouted(current, routed, "member_id")),
        verdict(
            "latest_wins",
            not_latest(current, tables["member_eligible"], tables["member_staging"], "member_id", "source_feed_timestamp"),
        ),
        verdict("country_movement", unmoved(tables["member_moved"], routed, "member_id", "country")),
        verdict("txn_unique", repeated_keys(curated, ["txn_id"])),
        verdict("unknown_member_quarantined", unknown_member_accepted(evaluated, current)),
        verdict(
            "redemption_reconcile",
            unreconciled(reconcile(tables["redemption_staging"], evaluated, curated)),
        ),
        verdict("idempotent", run_twice(curated, evaluated)),
    ]
    return reduce(DataFrame.unionByName, verdicts)


def failed_checks(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == FAIL)


class CheckFailure(AssertionError):
    """At least one check did not pass."""


def require_passed(results: DataFrame) -> None:
    """Raise naming every failed check."""
    failed = failed_checks(results).orderBy("check_name").collect()  # one row per check
    if failed:
        raise CheckFailure(", ".join(f"{row.check_name}: {row.violations} violations" for row in failed))
