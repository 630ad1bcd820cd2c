"""Files loaded exactly once, by a file-source stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.schemas import FeedSource
from feedlake.sources.heads import empty_files, head_lines
from feedlake.sources.landing import (
    Register,
    delivered_files,
    index_splits,
    land,
    landing_folder,
    note_load,
    note_replaced,
    text_lines,
    visible_splits,
)
from feedlake.sources.scratch import exists, small_frame

Sink = Callable[[DataFrame, int], None]


def ingest_new(
    spark: SparkSession, path: str, checkpoint: str, sink: Sink, pattern: str = ".*", whole_file: bool = False
) -> int:
    """Pass the lines of all files that no earlier call has passed to `sink`; returns how many loads ran.

    The checkpoint remembers the files. If `sink` raises, the load counts as not
    done, and the next call passes the same files under the same load number, so
    a sink that overwrites by load number leaves neither gaps nor copies. A
    missing folder has no new files.
    """
    loads: list[int] = []
    failures: list[Exception] = []

    def keep(batch: DataFrame, load: int) -> None:
        try:
            sink(batch, load)
        except Exception as error:
            failures.append(error)
            raise
        loads.append(load)

    if not exists(spark, path):
        return 0
    lines = text_lines(spark.readStream, path, pattern, whole_file)
    query = (
        lines.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if failures:
            raise failures[0] from error
        raise
    return len(loads)


@dataclass
class LoadResult:
    """What a call has loaded; `status` is LOADED or SKIPPED."""

    loads: int = 0
    files: int = 0
    lines: int = 0
    replaced_files: int = 0

    @property
    def status(self) -> str:
        return "LOADED" if self.loads else "SKIPPED"


def load_feed(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    source: FeedSource,
    batch_id: str,
    json: bool = False,
    check: Callable[[str], None] | None = None,
    check_heads: Callable[[DataFrame], None] | None = None,
) -> LoadResult:
    """Load the new and the changed files of one feed and batch into RAW.

    A file that was loaded is skipped as long as its size and modification time stay; once they differ, its
    lines replace those loaded before. A file that was loaded and is empty now has its lines replaced by none;
    one that is gone, or was always empty, delivers nothing. `check_heads` gets the first lines of all files
    that are to be loaded before any of them is, and `check` the folder of the landed lines before
    they become visible. Either may raise; then nothing of the load becomes visible, and in the first case nothing is even landed.
    """
    path, checkpoint = f"{landing}/{source.folder}/{batch_id}", f"{raw_root}/checkpoints/{batch_id}"
    result = LoadResult()

    def store(batch: DataFrame, load: int) -> Register:
        target = landing_folder(raw_root, batch_id, load)
        land(batch, target, json)
        register = index_splits(batch.sparkSession, raw_root, target, source.folder, batch_id, heads=not json)
        if check:
            check(target)
        return register

    def sink(batch: DataFrame, load: int) -> None:
        register = store(batch, load)
        note_load(batch.sparkSession, raw_root, batch_id, load, register)
        _add(result, register)

    if not exists(spark, path):
        return result
    if check_heads:
        awaited, _ = _not_in_force(spark, path, raw_root, source, batch_id)
        check_heads(head_lines(awaited.where("file_size > 0"), source.folder, batch_id))
    ingest_new(spark, path, checkpoint, sink, source.pattern, source.whole_file)

    changed, load = _not_in_force(spark, path, raw_root, source, batch_id)
    # Spark lists all paths of a folder on the driver anyway; these are the few among them that differ.
    found = changed.select("file_path", F.coalesce("old_lines", F.lit(0)).alias("old_lines")).collect()
    if found:
        paths = [row.file_path for row in found]
        register = store(text_lines(spark.read, path, source.pattern, source.whole_file, paths), load)
        replaced_lines = sum(row.old_lines for row in found)
        if register.lines or replaced_lines:
            note_replaced(spark, raw_root, batch_id, load, small_frame(spark, [(path,) for path in paths], "file_path string"))
            note_load(spark, raw_root, batch_id, load, register, replaced_lines)
            _add(result, register)
            result.replaced_files += sum(row.old_lines > 0 for row in found)
    return result


def _not_in_force(spark: SparkSession, path: str, raw_root: str, source: FeedSource, batch_id: str) -> tuple[DataFrame, int]:
    """Delivered files that are not visible as they are now, with the number of lines they had; the next load's number.

    Files that never had a line and have none now are left out. A store that Python cannot open is taken as having no emptied file.
    """
    splits, load = visible_splits(spark, raw_root, batch_id)
    loaded = splits.groupBy("file_path").agg(
        F.max("file_size").alias("old_size"), F.max("file_modified").alias("old_modified"), F.sum("line_count").alias("old_lines")
    )
    same = F.col("file_size").eqNullSafe(F.col("old_size")) & F.col("file_modified").eqNullSafe(F.col("old_modified"))
    delivered = delivered_files(spark, path, source.pattern)
    differing = delivered.join(loaded, "file_path", "left").where(~same & (F.col("file_size") > 0)).select("file_path", "file_size", "old_lines")
    # Spark lists no file without content. Of loaded files that are not listed, most are gone, and few, if any, emptied.
    unlisted = loaded.join(delivered.select("file_path"), "file_path", "left_anti").select("file_path", "old_lines")
    emptied = empty_files(unlisted).select("file_path", F.lit(0).cast("long").alias("file_size"), "old_lines")
    return differing.unionByName(emptied), load


def _add(result: LoadResult, register: Register) -> None:
    result.loads += 1
    result.files += register.files
    result.lines += register.lines
