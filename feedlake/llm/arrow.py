"""Small helpers for functions that run over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows in a slice of a batch, and bytes of text after which a slice ends early.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


#: What workers remember between tasks, with the modules that use it.
_remembered: list[tuple[dict, tuple[str, ...]]] = []
# The module whose work this worker did last.
_last_user: list[str] = []


def remembered(*users: str) -> dict:
    """A dictionary that lives as long as the worker, and is emptied when it turns to another module's work."""
    held: dict = {}
    _remembered.append((held, tuple(f"feedlake.llm.{user}" for user in users)))
    return held


def turn_to(user: str) -> None:
    """Say whose work a worker does now; what only others use is given back, to the system too."""
    for held, users in _remembered:
        if user not in users:
            held.clear()
    if _last_user and _last_user != [user]:
        # The first is Arrow's own memory, the second what numpy and Python have freed.
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()
    _last_user[:] = [user]


def mapped(df: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`mapInArrow` by a worker that has given back what other modules' work left behind."""
    user = getattr(of_batches, "func", of_batches).__module__

    def run(batches):
        turn_to(user)
        yield from of_batches(batches)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most_rows: int = SLICE_ROWS, most_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds few rows and few bytes of `column`; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0)
        start, held = 0, 0
        for row, size in enumerate(sizes.to_pylist()):
            if row > start and (row - start >= most_rows or held + size > most_bytes):
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    return batch.column(column).cast(pa.binary()).fill_null(b"").to_pylist()


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def per_text(
    df: DataFrame, ddl: str, make: Callable[[], Callable[[list[bytes]], dict]], keep: list[str], text: str = "text",
    most_rows: int = SLICE_ROWS, most_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Map texts to columns, slice by slice, next to the kept columns of their rows.

    `make` runs once per task and returns a function from a list of UTF-8 texts to
    the new columns by name; `ddl` gives their types in that order.
    """
    kept = df.select(*map(_quoted, keep)).schema
    added = StructType.fromDDL(ddl)
    schema = StructType([*kept.fields, *added.fields])

    def run(batches):
        turn_to(make.__module__)
        of_texts = make()
        shape = to_arrow_schema(schema)
        for part in slices(batches, text, most_rows, most_bytes):
            made = of_texts(texts(part, text))
            columns = [part.column(name).cast(shape.field(name).type) for name in kept.names]
            for field in added.fields:
                values = made[field.name]
                kind = shape.field(field.name).type
                columns.append(values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(columns, schema=shape)

    return df.select(*map(_quoted, dict.fromkeys([*keep, text]))).mapInArrow(run, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of neighbouring rows with equal keys, also across batches, as (key, table)."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for name in keys:
            values = batch.column(name).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        key_columns = [batch.column(name) for name in keys]
        for start, end in zip(starts, starts[1:]):
            key = tuple(column[start].as_py() for column in key_columns)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(start, end - start))
    if held:
        yield held_key, pa.Table.from_batches(held)
