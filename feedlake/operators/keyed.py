"""Per-key results brought back to the rows of the key, safe against hot keys.

A key may own any share of the rows: a missing id, an unknown member, a
transaction delivered again and again. Results per key are therefore computed by
aggregation, which combines on the map side, and written, as they are read twice:
keys with very many rows, at most `MAX_HOT_KEYS`, are broadcast, and all others
are joined by key. The rows themselves are read once. A row of a hot key has its
answer from the broadcast; it takes part in the join under a salt, a hash of
the row, which no key has, and so is spread instead of piled up with its likes.

The broadcast is bounded in bytes too: a hot key is in at least `HOT_ROWS` rows,
so all hot keys together take at most the size of the data divided by that,
100 MB for 100 TB.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from feedlake.sources.scratch import materialise

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
# Places that the rows of a hot key are spread to.
SALTS = 1 << 20


def key_sizes(df: DataFrame, keys: list[str], rows: str = "key_rows") -> DataFrame:
    """Row count of every key; NULL is a key of its own."""
    return df.groupBy(*keys).agg(F.count("*").alias(rows))


def _same_key(keys: list[str]) -> Column:
    return reduce(and_, (F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys))


def _hot(stats: DataFrame, keys: list[str], rows: str, hot_rows: int) -> DataFrame:
    # The key columns make the order total, so every evaluation picks the same keys. Keys past the limit
    # are not lost: whatever is not picked here goes through the join on the key.
    return stats.where(F.col(rows) >= hot_rows).orderBy(F.desc(rows), *keys).limit(MAX_HOT_KEYS)


def _row_hash(df: DataFrame) -> Column:
    """A number made of the row's values alone, so that a task that is run again deals its rows as before."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    return F.xxhash64(*plain)


def attach(
    df: DataFrame, stats: DataFrame, keys: list[str], rows: str = "key_rows", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left join of a count per key to the rows of `df`: adds the column `rows` of `stats`.

    `stats` has one row per key, with the key's size in `df`. It is read twice and should be a written table.
    """
    renamed = {key: f"_key_{key}" for key in keys}
    hot = _hot(stats, keys, rows, hot_rows).select(*keys, F.col(rows).alias("_hot_rows")).withColumnsRenamed(renamed)
    marked = df.join(F.broadcast(hot), _same_key(keys), "left").drop(*renamed.values())
    salted = marked.withColumn("_salt", F.when(F.col("_hot_rows").isNull(), 0).otherwise(1 + F.pmod(_row_hash(df), F.lit(SALTS))))
    plain = stats.select(*keys, F.col(rows).alias("_rows"), F.lit(0).cast("long").alias("_place")).withColumnsRenamed(renamed)
    on = _same_key(keys) & (F.col("_salt") == F.col("_place"))
    return salted.join(plain, on, "left").select(*df.columns, F.coalesce("_hot_rows", "_rows").alias(rows))


def with_key_size(df: DataFrame, keys: list[str], name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the number of rows that share the row's key.

    Only keys with more than one row take part in the join back.
    """
    repeated = materialise(key_sizes(df, keys, name).where(F.col(name) > 1), "repeated-keys")
    return attach(df, repeated, keys, name, hot_rows).withColumn(name, F.coalesce(name, F.lit(1).cast("long")))


def absent_keys(
    df: DataFrame, lookup: DataFrame | Sequence[DataFrame], keys: list[str], rows: str = "key_rows", buckets: int | None = None
) -> DataFrame:
    """Keys of `df` without NULLs that have no row in `lookup`, with their row counts.

    Several lookups are asked one after another, and a key is absent if none of them has it. Lookups that are bucketed by the keys are
    read in place, which a union of them would not be; with `buckets`, their number, the keys are dealt to as many partitions.
    """
    present = reduce(and_, (F.col(key).isNotNull() for key in keys))
    absent = key_sizes(df.where(present), keys, rows)
    lookups = [lookup] if isinstance(lookup, DataFrame) else lookup
    if buckets is None or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) == buckets:
        for known in lookups:  # the aggregation has dealt the keys as the buckets are
            absent = absent.join(known.select(*keys), keys, "left_anti")
        return absent
    absent = absent.repartition(buckets, *keys)
    for known in lookups:  # Spark would move an anti-join to before the keys are dealt
        there = known.select(*keys, F.lit(True).alias("_there"))
        absent = absent.join(there, keys, "left").where("_there is null").drop("_there")
    return absent


def with_exists(
    df: DataFrame, lookup: DataFrame, keys: list[str], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add whether `lookup` has the row's key; false where part of the key is NULL.

    `lookup` need not be unique on the keys.
    """
    rows = f"_{name}_rows"
    absent = materialise(absent_keys(df, lookup, keys, rows), "absent-keys")
    present = reduce(and_, (F.col(key).isNotNull() for key in keys))
    return attach(df, absent, keys, rows, hot_rows).withColumn(name, present & F.col(rows).isNull()).drop(rows)
