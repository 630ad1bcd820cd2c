"""Current state projected into partitions such as one per country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(current: DataFrame, by: str, domain: Sequence[str]) -> DataFrame:
    """Rows of the current state that belong to one of the partitions of `domain`."""
    return current.where(F.col(by).isin(*domain))


def changed_keys(staged: DataFrame, key: str) -> DataFrame:
    """Distinct keys that a batch touched."""
    return staged.select(key).distinct()


def reroute(
    previous: DataFrame, current: DataFrame, changed: DataFrame, key: str, by: str, domain: Sequence[str]
) -> DataFrame:
    """Projection after a batch: changed keys leave every partition and enter the one they are in now.

    Rows of other keys stay exactly as they were in `previous`.
    """
    survivors = previous.join(changed, key, "left_anti")
    entering = project(current, by, domain).join(changed, key, "left_semi")
    return survivors.unionByName(entering)


def affected_partitions(
    before: DataFrame | None, after: DataFrame, key: str, by: str, compare: Sequence[str]
) -> DataFrame:
    """Partitions that lose, gain or update a row between two states; a row is updated if `compare` differs.

    States that are bucketed by the key are compared without a shuffle.
    """
    if before is None:
        return after.select(by).distinct()
    old = before.select(key, F.struct(by, *compare).alias("_old"))
    new = after.select(key, F.struct(by, *compare).alias("_new"))
    differing = old.join(new, key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    places = F.array_compact(F.array(F.col(f"_old.{by}"), F.col(f"_new.{by}")))
    return differing.select(F.explode(places).alias(by)).distinct()


def movements(before: DataFrame, after: DataFrame, key: str, by: str) -> DataFrame:
    """Keys whose partition differs between two states."""
    old = before.select(key, F.col(by).alias(f"from_{by}"))
    new = after.select(key, F.col(by).alias(f"to_{by}"))
    return old.join(new, key).where(F.col(f"from_{by}") != F.col(f"to_{by}"))
