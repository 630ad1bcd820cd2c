"""The first line of files, and which files have none, without reading the files."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.sources.landing import relative_name

#: Bytes of a first line that are looked at; a longer one is no header of any contract.
MOST_BYTES = 1 << 20
_CHUNK = 1 << 14
_SCHEMA = pa.schema([("file_path", pa.string()), ("first_line", pa.string())])


def _open(uri: str):
    """The file as a stream of bytes; None if it is gone or its store is out of reach from here."""
    parts = urlsplit(uri)
    try:
        if parts.scheme in ("", "file"):
            return open(unquote(parts.path), "rb")
        store, path = fs.FileSystem.from_uri(uri)
        return store.open_input_stream(path)
    except (OSError, pa.ArrowException, ImportError):
        return None


def first_line(uri: str) -> str | None:
    """The line up to the first line end, without it; None for a file that cannot be opened."""
    opened = _open(uri)
    if opened is None:
        return None
    with opened:
        held = b""
        while b"\n" not in held and len(held) < MOST_BYTES and (more := opened.read(_CHUNK)):
            held += more
    return held.split(b"\n", 1)[0].removesuffix(b"\r").decode("utf-8", "replace")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("file_path").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(map(first_line, paths), pa.string())], schema=_SCHEMA)


def is_empty(uri: str) -> bool:
    """Whether there is such a file and nothing in it."""
    opened = _open(uri)
    if opened is None:
        return False
    with opened:
        return not opened.read(1)


def _without_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(map(is_empty, batch.column("file_path").to_pylist()), pa.bool_()))


def empty_files(files: DataFrame) -> DataFrame:
    """Those of the files that are there and have no content, which no listing by a reader of Spark shows."""
    return files.mapInArrow(_without_content, files.schema)


def head_lines(files: DataFrame, folder: str, batch_id: str) -> DataFrame:
    """The first line of each file, with its batch, name and line number, as the contract check takes them.

    Every file is opened by the task that has it in its listing and read as far as its first line end. Files that cannot be
    opened from Python are left out; their headers are known when they are landed.
    """
    heads = files.select("file_path").mapInArrow(_opened, "file_path string, first_line string").where("first_line is not null")
    return heads.select(
        F.lit(batch_id).alias("batch_id"),
        relative_name(F.col("file_path"), folder, batch_id).alias("source_file_name"),
        F.lit(1).cast("long").alias("source_row_number"),
        F.col("first_line").alias("raw_record"),
    )
