"""Places for intermediate tables, and reading of paths that may not exist yet."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
# Folders handed out within `temporary`; None outside of it.
_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder.

    A local master without such a setting gets one temporary folder per application.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="feedlake-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nothing else uses."""
    path = f"{scratch_root(spark)}/feedlake/{name}-{uuid.uuid4().hex}"
    made = _handed_out.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread writes within are deleted at the end, also after a failure.

    Frames that depend on them are void then, so results must be written within too.
    """
    made: list[str] = []
    token = _handed_out.set(made)
    try:
        yield
    finally:
        _handed_out.reset(token)
        for path in made:
            delete_folder(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a scratch table and read it back, which ends its lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables below the scratch folder; frames that were read from them are void then."""
    delete_folder(spark, f"{scratch_root(spark)}/feedlake")


# Spark offers no public way to ask about or remove paths of any file system; this one needs a classic session.
def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def replace_file(spark: SparkSession, source_uri: str, target_uri: str) -> None:
    """Put a file in place of another, both named by their URIs."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)) for uri in (source_uri, target_uri))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, False)
    files.rename(source, target)


def empty_file(spark: SparkSession, uri: str) -> None:
    """Put an empty file in place of the one that the URI names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A frame of a few given rows, handed over as Arrow, which starts no Python worker."""
    schema = StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)


def append_rows(spark: SparkSession, path: str, rows: list[tuple], ddl: str) -> None:
    """Append a few rows to a log as one JSON file, which appears as a whole or not at all."""
    small_frame(spark, rows, ddl).coalesce(1).write.mode("append").json(path)


def read_or_empty(spark: SparkSession, fmt: str, path: str, ddl: str) -> DataFrame:
    """The files at `path`, or an empty frame of the same shape if there are none yet."""
    if exists(spark, path):
        return spark.read.format(fmt).schema(ddl).load(path)
    return small_frame(spark, [], ddl)
