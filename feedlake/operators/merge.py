"""Upsert by key: the new snapshot that a batch makes of the current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMBIGUOUS = "AMBIGUOUS_MERGE"


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    version: str | None = None,
    run_ts: Column | None = None,
    inserted_at: str | None = None,
    updated_at: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Snapshot of `target` after inserting or updating the rows of `source`.

    The target holds one row per key. Two source rows of one key make the upsert fail; they are met
    in an aggregation by the keys that the join then joins by, so this takes no further shuffle. A caller whose source has one row per key
    by construction says so by `unique` and is spared the aggregation. With `version`, a
    source row replaces a target row only if its version is strictly greater, so late and repeated
    deliveries change nothing. `inserted_at` and `updated_at` name audit columns:
    both are set on insert, `updated_at` also on update, to `run_ts` or, if the
    source has the column itself, to the source's value.
    """
    run_ts = F.localtimestamp() if run_ts is None else run_ts
    audit = [name for name in (inserted_at, updated_at) if name]
    values = [name for name in source.columns if name not in keys and name not in audit]
    source = source.withColumns({name: run_ts for name in audit if name not in source.columns})
    held = [*values, *audit]
    new = source.select(*keys, F.struct(*held).alias("_new")) if unique else _one_per_key(source, keys, held)
    if target is None:
        return new.select(*keys, "_new.*")

    old = target.select(*keys, F.struct(*values, *audit).alias("_old"))
    both = old.join(new, keys, "full_outer")
    inserts = F.col("_old").isNull()
    takes = F.col("_new").isNotNull()
    if version:
        takes = takes & (inserts | (F.col(f"_new.{version}") > F.col(f"_old.{version}")))
    columns = [F.when(takes, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name) for name in values]
    if inserted_at:
        columns.append(F.coalesce(f"_old.{inserted_at}", f"_new.{inserted_at}").alias(inserted_at))
    if updated_at:
        columns.append(
            F.when(takes, F.col(f"_new.{updated_at}")).otherwise(F.col(f"_old.{updated_at}")).alias(updated_at)
        )
    return both.select(*keys, *columns)


def _one_per_key(source: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys and the struct `_new` of the other columns; a key with two rows fails the job that computes it."""
    grouped = source.groupBy(*keys).agg(F.first(F.struct(*values)).alias("_new"), F.count("*").alias("_copies"))
    message = F.format_string(f"{AMBIGUOUS}: key %s occurs %d times in the source", F.to_json(F.struct(*keys)), "_copies")
    return grouped.select(*keys, F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.col("_new")).alias("_new"))
