"""Versioned tables: every run writes new folders, one appended record publishes them all.

Files of a published version are never changed. A batch table holds one slot per
batch, a projection one slot per partition value. Slots of an entity table are
hash-bucketed by its key, so that the next run joins to them without shuffling
them. A run writes the slots it replaces under a new version number and then
appends one commit file that names them; readers follow the latest commit of
each slot, so they see all of a run or nothing. One run at a time may write.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.schemas import column_names, without_column
from feedlake.sources.scratch import append_rows, delete_folder, exists, read_or_empty, small_frame

_COMMITS_DDL = (
    "version bigint, batch_id string, table_name string, slot string, row_count bigint, buckets int,"
    " committed_at timestamp_ntz"
)
WHOLE = ""


@dataclass
class Slot:
    """One replaceable part of a table."""

    table: str
    slot: str
    version: int
    row_count: int
    buckets: int = 0


@dataclass
class Lake:
    """Tables below a root folder. `buckets` defaults to the session's shuffle partitions."""

    spark: SparkSession
    root: str
    buckets: int | None = None
    _pending: list[Slot] = field(default_factory=list)
    _published: dict[str, list[Slot]] | None = None

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        if self.buckets is None:
            self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    # -- commits ---------------------------------------------------------------

    def published(self) -> dict[str, list[Slot]]:
        """Latest published version of every slot of every table."""
        if self._published is None:
            commits = read_or_empty(self.spark, "json", f"{self.root}/control/commits", _COMMITS_DDL)
            newest = F.max_by(F.struct("version", "row_count", "buckets"), F.col("version")).alias("s")
            rows = commits.groupBy("table_name", "slot").agg(newest).collect()
            tables: dict[str, list[Slot]] = {}
            for row in sorted(rows, key=lambda row: row.slot):
                slot = Slot(row.table_name, row.slot, row.s.version, row.s.row_count, row.s.buckets)
                tables.setdefault(row.table_name, []).append(slot)
            self._published = tables
        return self._published

    def slots(self, table: str) -> list[Slot]:
        return self.published().get(table, [])

    def refresh(self) -> None:
        """Look at the commits anew, as another process may have published."""
        self._published = None

    def next_version(self) -> int:
        return 1 + max((slot.version for slots in self.published().values() for slot in slots), default=0)

    def commit(self, batch_id: str) -> None:
        """Publish everything written since the last commit, by one appended file."""
        if not self._pending:
            return
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = [(s.version, batch_id, s.table, s.slot, s.row_count, s.buckets, now) for s in self._pending]
        append_rows(self.spark, f"{self.root}/control/commits", rows, _COMMITS_DDL)
        self._pending.clear()
        self.refresh()

    def discard(self) -> None:
        """Forget what was written since the last commit; its folders are overwritten by the next run."""
        self._pending.clear()

    def superseded(self, keep_runs: int = 1) -> list[str]:
        """Folders of slots that neither the current state nor the states of the last `keep_runs` runs before need."""
        commits = read_or_empty(self.spark, "json", f"{self.root}/control/commits", _COMMITS_DDL)
        oldest = self.next_version() - 1 - keep_runs  # the oldest state that must stay readable
        in_force = F.max(F.when(F.col("version") <= oldest, F.col("version"))).alias("needed")
        needed = commits.groupBy("table_name", "slot").agg(in_force)
        gone = commits.join(needed, ["table_name", "slot"]).where("version < needed and row_count > 0")
        rows = gone.select("table_name", "version", "slot").distinct().collect()
        return sorted(self._path(row.table_name, row.version, row.slot) for row in rows)

    def remove_superseded(self, keep_runs: int = 1) -> int:
        """Delete the superseded folders; returns how many there were. Not to be called while a run writes."""
        folders = [folder for folder in self.superseded(keep_runs) if exists(self.spark, folder)]
        for folder in folders:
            delete_folder(self.spark, folder)
        return len(folders)

    # -- writing ---------------------------------------------------------------

    def _path(self, table: str, version: int, slot: str = WHOLE) -> str:
        path = f"{self.root}/tables/{table}/v={version}"
        return f"{path}/{slot}" if slot else path

    def write_batch(
        self,
        df: DataFrame,
        table: str,
        ddl: str,
        version: int,
        batch_id: str,
        split_by: str | None = None,
        **counts: Column,
    ) -> tuple[DataFrame, dict[str, int]]:
        """Replace the slot of a batch, also by nothing; returns what was written and counts of it.

        Rows, and whatever else `counts` asks for, are counted while they are written.
        """
        slot = f"batch_id={batch_id}"
        path = self._path(table, version, slot)
        seen = Observation()
        df = df.select([name for name in column_names(ddl) if name != "batch_id"])
        df = df.observe(seen, F.count("*").alias("rows"), *(count.alias(name) for name, count in counts.items()))
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(split_by) if split_by else writer).parquet(path)
        self._pending.append(Slot(table, slot, version, seen.get["rows"]))
        return self._read([path], table, ddl), seen.get

    def in_buckets(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """`df` shuffled so that each task writes one bucket, and joins to a bucketed slot as it is."""
        return df.repartition(self.buckets, *keys)

    def write_entity(
        self, df: DataFrame, table: str, ddl: str, version: int, keys: list[str], slot: str = WHOLE
    ) -> DataFrame:
        """Replace a slot of an entity table, bucketed and sorted by its key; returns what was written.

        `df` should come out of a join with a bucketed slot, or of `in_buckets`;
        otherwise every task writes a file for every bucket.
        """
        path = self._path(table, version, slot)
        name = self._unused_name()
        seen = Observation()
        (
            df.select(column_names(ddl))
            .observe(seen, F.count("*").alias("rows"))
            .write.bucketBy(self.buckets, *keys)
            .sortBy(*keys)
            .option("path", path)
            .mode("overwrite")
            .saveAsTable(name)
        )
        written = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        self._pending.append(Slot(table, slot, version, seen.get["rows"], self.buckets))
        return written

    def write_projection(
        self, df: DataFrame, table: str, ddl: str, version: int, by: str, affected: list[str], keys: list[str]
    ) -> None:
        """Replace the affected partitions of a projection, also by nothing; each is bucketed and sorted by the key.

        `df` should be a slot of an entity table of the same key: its tasks hold whole buckets, or splits of one, so
        that nothing is shuffled and a partition has a file for each of them, large partitions large ones.
        """
        if not affected:
            return
        name = self._unused_name()
        seen = Observation()
        sizes = [F.count_if(F.col(by) == value).alias(f"n{index}") for index, value in enumerate(affected)]
        (
            df.select(column_names(ddl))
            .observe(seen, *sizes)
            .write.partitionBy(by)
            .bucketBy(self.buckets, *keys)
            .sortBy(*keys)
            .option("path", self._path(table, version))
            .option("partitionOverwriteMode", "static")
            .mode("overwrite")
            .saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")
        self._pending.extend(
            Slot(table, f"{by}={value}", version, seen.get[f"n{index}"], self.buckets) for index, value in enumerate(affected)
        )

    # -- reading ---------------------------------------------------------------

    def _read(self, paths: list[str], table: str, ddl: str) -> DataFrame:
        # The declared schema keeps partition values such as 20260926 text.
        reader = self.spark.read.schema(ddl).option("basePath", f"{self.root}/tables/{table}")
        return reader.parquet(*paths).select(column_names(ddl))

    def read(self, table: str, ddl: str, slot: str | None = None) -> DataFrame:
        """Published rows of a batch table or projection, all slots or one."""
        found = [s for s in self.slots(table) if slot is None or s.slot == slot]
        # A split or projected slot without rows may have no file to read.
        paths = [self._path(table, s.version, s.slot) for s in found if s.row_count]
        return self._read(paths, table, ddl) if paths else small_frame(self.spark, [], ddl)

    def read_entity(self, table: str, ddl: str, keys: list[str], slot: str = WHOLE) -> DataFrame | None:
        """A published slot of an entity table with its bucketing, or None if it has no rows."""
        found = [s for s in self.slots(table) if s.slot == slot and s.row_count]
        if not found:
            return None
        name, on = self._unused_name(), ", ".join(keys)
        path = self._path(table, found[0].version, slot).replace("\\", "\\\\").replace("'", "\\'")
        # A table entry is how Spark learns of the bucketing; the plan keeps it when the entry is gone.
        self.spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({on}) SORTED BY ({on})"
            f" INTO {found[0].buckets} BUCKETS LOCATION '{path}'"
        )
        published = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return published

    def read_projection(self, table: str, ddl: str, by: str, keys: list[str]) -> list[DataFrame]:
        """The published partitions of a projection that have rows, each with its bucketing."""
        stored = without_column(ddl, by)
        found = [(s.slot, self.read_entity(table, stored, keys, s.slot)) for s in self.slots(table)]
        return [
            rows.withColumn(by, F.lit(slot.split("=", 1)[1])).select(column_names(ddl))
            for slot, rows in found
            if rows is not None
        ]

    def row_count(self, table: str, slot: str = WHOLE) -> int:
        """Published rows of a slot."""
        return sum(s.row_count for s in self.slots(table) if s.slot == slot)

    def empty_slot(self, table: str, slot: str, version: int) -> None:
        """Replace a slot by nothing."""
        self._pending.append(Slot(table, slot, version, 0))

    @staticmethod
    def _unused_name() -> str:
        return f"spark_catalog.default.feedlake_{uuid.uuid4().hex}"
