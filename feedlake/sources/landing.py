"""Text and JSON files landed as numbered lines.

A line's number in its file cannot be known while a file is read in many splits.
Landing therefore writes every line with its split and the running id Spark gives
rows within a task, then counts the lines of each split, a table with one row per
split, and adds the splits up per file. Line number = lines in earlier splits +
place within the split. The lines themselves are written once and never shuffled.

A load becomes visible when its number is noted in the list of loads, after its
lines and splits are complete and checked. A file that was delivered anew under its
name, told by size or modification time, is a load of its own that replaces the
file's earlier lines.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.functions.dates import batch_date, check_batch_id
from feedlake.functions.text import record_type, without_carriage_return
from feedlake.schemas import RAW_MEMBER, RAW_REDEMPTION, column_names
from feedlake.sources.scratch import append_rows, new_folder, read_or_empty, small_frame

LINES = "lines"
SPLITS = "splits"
_TEXT_DDL = "raw_text string, file_path string, split_start bigint, row_id bigint, batch_id string, load bigint"
_LINES_DDL = f"{_TEXT_DDL}, document variant"  # lines that are no documents have none in their files
_SPLITS_DDL = (
    "file_path string, split_start bigint, first_id bigint, line_count bigint, source_file_name string,"
    " lines_before bigint, first_line string, file_size bigint, file_modified timestamp,"
    " ingestion_timestamp timestamp_ntz, batch_id string, load bigint"
)
# Bytes of the split register that are broadcast at most; a larger one is left to Spark's own choice of join.
MAX_BROADCAST_BYTES = 64 << 20
# Of a register row besides its two texts: five numbers and the overhead of a row.
SPLIT_ROW_BYTES = 96
# Loads of changed files are numbered apart from the stream's, and after all of them.
FIRST_CHANGE = 1 << 32


@dataclass(frozen=True)
class Register:
    """What a load's split register adds up to; `bytes` is what its columns for line numbers take."""

    bytes: int
    lines: int
    files: int


class MalformedDocumentError(ValueError):
    """A delivered JSON file holds a line that is no JSON document."""


class NoFilesError(ValueError):
    """A batch has no file to read."""


def _decoded(file_path: Column) -> Column:
    # The path comes as a URI, where only `+` stands for itself although decoding would make it a space.
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def path_filter(pattern: str) -> Column:
    """Whether the whole path of a row's file matches `pattern`.

    Spark prunes the file list with it, but also tests it for every row, so a
    pattern that only asks for a certain end is tested as just that.
    """
    file_path = F.col("_metadata.file_path")
    ending = re.fullmatch(r"\.\*((?:[A-Za-z0-9_~/-]|\\\.)*)", pattern)
    if ending:
        return F.endswith(file_path, F.lit(ending[1].replace("\\.", ".")))
    return _decoded(file_path).rlike(f"^(?:{pattern})$")


def _as_read(uri: str) -> str:
    """The path that a file's URI stands for, as Spark's reader takes it: signs that it would take for a pattern are escaped."""
    return re.sub(r"[\\{}\[\]*?]", r"\\\g<0>", unquote(uri))


def delivered_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file_path, file_size, file_modified) of the files below `path` that match; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(path_filter(pattern))
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def text_lines(
    reader, path: str, pattern: str, whole_file: bool = False, file_paths: list[str] | None = None
) -> DataFrame:
    """Whole lines of all files below `path` whose full path matches `pattern`, with their split.

    With `file_paths`, the URIs of files, only of those: they are what the scan is given to read, so that the plan
    does not grow with their number, and no other file is listed. One that is gone by then fails the load.

    `reader` is `spark.read` or `spark.readStream`. Lines are split at newlines
    only; a carriage return before the newline is dropped. With `whole_file`
    each file is one row.
    """
    reader = reader.format("text").option("recursiveFileLookup", "true").option("lineSep", "\n")
    reader = reader.option("maxFileAge", "36500d")  # a stream would pass over files much older than the newest
    if whole_file:
        reader = reader.option("wholetext", "true")
    if file_paths is None:
        found = reader.load(path).where(path_filter(pattern))
    else:
        found = reader.load([_as_read(uri) for uri in file_paths])
    return found.select(
        without_carriage_return(F.col("value")).alias("raw_text"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def relative_name(file_path: Column, folder: str, batch_id: str) -> Column:
    """File name below the landing root: `<folder>/<batch_id>/...`."""
    return F.regexp_extract(_decoded(file_path), f"({re.escape(folder)}/{re.escape(batch_id)}/.*)$", 1)


def landing_folder(root: str, batch_id: str, load: int) -> str:
    return f"{root}/batch_id={batch_id}/load={load}"


def land(lines: DataFrame, target: str, json: bool = False) -> None:
    """Write the lines of a load to `target`.

    With `json`, blank lines are skipped, and a line that is no JSON document
    fails the load. Lines are judged while they are written, in one pass, and the document that each was parsed to is
    written beside its text, so that it is not parsed again.
    """
    watch = None
    if json:
        lines = lines.where(F.col("raw_text").rlike(r"\S"))
        watch = Observation()
        parsed = lines.withColumn("document", F.try_parse_json("raw_text"))
        lines = parsed.observe(watch, F.count_if(F.col("document").isNull()).alias("malformed"))
    columns = [name for name in lines.columns if name != "row_id"]
    landed = lines.select(*columns, F.monotonically_increasing_id().alias("row_id"))
    landed.write.mode("overwrite").parquet(f"{target}/{LINES}")
    if watch is not None and watch.get["malformed"]:
        raise MalformedDocumentError(f"{watch.get['malformed']} lines of {target} are not JSON documents")


def _read(spark: SparkSession, root: str, targets: list[str], part: str, ddl: str) -> DataFrame:
    # The batch is read off the folder names; the declared type keeps it text.
    reader = spark.read.schema(ddl).option("basePath", root)
    return reader.parquet(*(f"{target}/{part}" for target in targets)).select(column_names(ddl))


def index_splits(
    spark: SparkSession, root: str, target: str, folder: str, batch_id: str, heads: bool = False
) -> Register:
    """Write one row per split of the landed lines: its first row id, and the lines its file has before it.

    With `heads`, the register also keeps the first line of every file, so that headers can be
    checked without the lines being read again.
    """
    ddl = f"{_LINES_DDL}, file_size bigint, file_modified timestamp"
    head = F.when(F.first("split_start") == 0, F.min_by("raw_text", "row_id")) if heads else F.lit(None).cast("string")
    splits = (
        _read(spark, root, [target], LINES, ddl)
        .groupBy("file_path", "split_start")
        .agg(
            F.min("row_id").alias("first_id"),
            F.count("*").alias("line_count"),
            head.alias("first_line"),
            F.max("file_size").alias("file_size"),
            F.max("file_modified").alias("file_modified"),
        )
        .withColumn("source_file_name", relative_name(F.col("file_path"), folder, batch_id))
    )
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    before = F.coalesce(F.sum("line_count").over(earlier), F.lit(0))
    indexed = splits.withColumns({"lines_before": before, "ingestion_timestamp": F.localtimestamp()})
    sizes = Observation()
    row_bytes = F.octet_length("file_path") + F.octet_length("source_file_name") + SPLIT_ROW_BYTES
    indexed = indexed.observe(
        sizes,
        F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("line_count"), F.lit(0)).alias("lines"),
        F.count_if(F.col("lines_before") == 0).alias("files"),
    )
    indexed.write.mode("overwrite").parquet(f"{target}/{SPLITS}")
    return Register(sizes.get["bytes"], sizes.get["lines"], sizes.get["files"])


def _numbered(lines: DataFrame, splits: DataFrame, register_bytes: int) -> DataFrame:
    places = splits.select(
        "batch_id", "load", "file_path", "split_start", "first_id", "lines_before", "source_file_name", "ingestion_timestamp"
    )
    if register_bytes <= MAX_BROADCAST_BYTES:
        places = F.broadcast(places)
    return lines.join(places, ["batch_id", "load", "file_path", "split_start"]).select(
        "raw_text",
        "document",
        "batch_id",
        "source_file_name",
        (F.col("lines_before") + F.col("row_id") - F.col("first_id") + 1).alias("source_row_number"),
        batch_date(F.col("batch_id")).cast("timestamp_ntz").alias("source_feed_timestamp"),
        "ingestion_timestamp",
    )


def landed_lines(
    spark: SparkSession, root: str, targets: list[str], register_bytes: int, replaced: DataFrame | None = None
) -> DataFrame:
    """Lines of the given landings with their number in the file, without files that a later load replaced."""
    lines = _read(spark, root, targets, LINES, _LINES_DDL)
    return _numbered(lines, _in_force(_read(spark, root, targets, SPLITS, _SPLITS_DDL), replaced), register_bytes)


def _in_force(splits: DataFrame, replaced: DataFrame | None) -> DataFrame:
    if replaced is None:
        return splits
    newer = replaced.groupBy("batch_id", "file_path").agg(F.max("load").alias("newest"))
    return splits.join(newer, ["batch_id", "file_path"], "left").where("newest is null or load >= newest").drop("newest")


def first_lines(spark: SparkSession, root: str, target: str) -> DataFrame:
    """The first line of every landed file, in the shape of the raw member table, from the split register alone."""
    heads = _read(spark, root, [target], SPLITS, _SPLITS_DDL).where("split_start = 0")
    return raw_member(
        heads.select(
            F.col("first_line").alias("raw_text"),
            "batch_id",
            "source_file_name",
            F.lit(1).cast("long").alias("source_row_number"),
            batch_date(F.col("batch_id")).cast("timestamp_ntz").alias("source_feed_timestamp"),
            "ingestion_timestamp",
        )
    )


def raw_member(lines: DataFrame) -> DataFrame:
    """Numbered lines in the shape of the raw member table."""
    shaped = lines.withColumnRenamed("raw_text", "raw_record").withColumn("record_type", record_type(F.col("raw_record")))
    return shaped.select(column_names(RAW_MEMBER))


def raw_redemption(lines: DataFrame) -> DataFrame:
    """Numbered lines in the shape of the raw redemption table, with the documents as they were parsed when they were landed."""
    return lines.withColumnRenamed("document", "raw_record").select(column_names(RAW_REDEMPTION))


def _ingest(
    spark: SparkSession, path: str, batch_id: str, pattern: str, json: bool = False, whole_file: bool = False
) -> DataFrame:
    check_batch_id(batch_id)
    folder = path.rstrip("/").rsplit("/", 1)[-1]
    root = new_folder(spark, f"landing-{folder}")
    target = landing_folder(root, batch_id, 0)
    land(text_lines(spark.read, f"{path}/{batch_id}", pattern, whole_file), target, json)
    register = index_splits(spark, root, target, folder, batch_id)
    return landed_lines(spark, root, [target], register.bytes)


def ingest_lines(spark: SparkSession, path: str, batch_id: str, pattern: str = ".*") -> DataFrame:
    """Every line of the files in `<path>/<batch_id>/` unparsed, with batch, file, line number and times."""
    return raw_member(_ingest(spark, path, batch_id, pattern))


def ingest_json(
    spark: SparkSession, path: str, batch_id: str, pattern: str = ".*", whole_file: bool = False
) -> DataFrame:
    """Every JSON document of the files in `<path>/<batch_id>/`, one per line or one per file, with lineage.

    A root array stays one document. Any malformed line fails the whole load.
    """
    return raw_redemption(_ingest(spark, path, batch_id, pattern, json=True, whole_file=whole_file))


def ingest_summary(raw: DataFrame) -> DataFrame:
    """Lines per loaded file."""
    return raw.groupBy("batch_id", "source_file_name").agg(F.count("*").alias("row_count"))


_LOADS_DDL = "batch_id string, load bigint, register_bytes bigint, line_count bigint"
_REPLACED_DDL = "batch_id string, load bigint, file_path string"


def note_load(spark: SparkSession, root: str, batch_id: str, load: int, register: Register, replaced_lines: int = 0) -> None:
    """Make a complete load visible; `replaced_lines` were visible so far and are no longer."""
    row = (batch_id, load, register.bytes, register.lines - replaced_lines)
    append_rows(spark, f"{root}/loads", [row], _LOADS_DDL)


def note_replaced(spark: SparkSession, root: str, batch_id: str, load: int, file_paths: DataFrame) -> None:
    """Say which files a load brings anew; this counts when the load itself is noted."""
    named = file_paths.select(F.lit(batch_id).alias("batch_id"), F.lit(load).alias("load"), "file_path")
    named.coalesce(1).write.mode("append").json(f"{root}/replaced")


def _loads(spark: SparkSession, root: str, batch_id: str | None) -> dict[tuple[str, int], Row]:
    noted = read_or_empty(spark, "json", f"{root}/loads", _LOADS_DDL)
    if batch_id is not None:
        noted = noted.where(F.col("batch_id") == batch_id)
    # A load that was repeated after a failure may be noted twice.
    return {(row.batch_id, row.load): row for row in noted.collect()}


def _replaced(spark: SparkSession, root: str, loads: dict[tuple[str, int], Row]) -> DataFrame | None:
    """Files that visible loads brought anew; None if there are none, which is the usual case."""
    changes = [key for key in loads if key[1] >= FIRST_CHANGE]
    if not changes:
        return None
    noted = small_frame(spark, changes, "batch_id string, load bigint")
    return spark.read.schema(_REPLACED_DDL).json(f"{root}/replaced").join(F.broadcast(noted), ["batch_id", "load"])


def visible_splits(spark: SparkSession, root: str, batch_id: str) -> tuple[DataFrame, int]:
    """The split register of a batch as far as it is in force, and the number of the next load of changed files."""
    loads = _loads(spark, root, batch_id)
    if not loads:
        return small_frame(spark, [], _SPLITS_DDL), FIRST_CHANGE
    targets = [landing_folder(root, *key) for key in sorted(loads)]
    splits = _in_force(_read(spark, root, targets, SPLITS, _SPLITS_DDL), _replaced(spark, root, loads))
    return splits, max(FIRST_CHANGE, 1 + max(load for _, load in loads))


def loaded_lines(spark: SparkSession, root: str, batch_id: str | None = None) -> tuple[DataFrame, int]:
    """Visible numbered lines of a batch, or of all, and how many there are."""
    loads = _loads(spark, root, batch_id)
    if not loads:
        nothing = small_frame(spark, [], _TEXT_DDL).withColumn("document", F.lit(None).cast("variant"))
        return _numbered(nothing, small_frame(spark, [], _SPLITS_DDL), 0), 0
    targets = [landing_folder(root, *key) for key in sorted(loads)]
    register_bytes = sum(row.register_bytes for row in loads.values())
    lines = landed_lines(spark, root, targets, register_bytes, _replaced(spark, root, loads))
    return lines, sum(row.line_count for row in loads.values())
