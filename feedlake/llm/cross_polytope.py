"""Near-duplicate vectors by cross-polytope hashing.

A vector is normalised, padded to a power of two and turned by three rounds of random signs and a fast Hadamard transform;
the nearest signed axis is its hash, the second nearest a probe. A table joins several such hashes to a key; a
vector is entered under its key and looked up under the keys with one hash replaced by its probe. Pairs that meet in any table
are compared exactly, by cosine in double precision.

Vectors with equal components form a class, and only classes are hashed. A bucket is worked through in blocks of bounded size; a block
counts the links of its members and reports only those links that join components, so that the pairs of a
dense group are counted but never written. A pair is counted in one block: in the first table, and there under the
smaller key, where it meets.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
lengths. Rows without an id count as vectors. Repeated rows are copies that link with each other. An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from feedlake.llm import arrow
from feedlake.llm.graph import components
from feedlake.llm.tables import written

COSINE = 0.95
#: Tables, and hashes in a table's key. With these a pair at the threshold is missed with a probability below 1e-4.
TABLES, HASHES = 20, 3
#: Members in a chunk of a bucket; a block holds two chunks.
CHUNK = 1024
ROWS = 512


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform along the last axis, scaled to keep lengths."""
    n = x.shape[-1]
    step = 1
    while step < n:
        y = x.reshape(*x.shape[:-1], n // (2 * step), 2, step)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(*x.shape[:-1], n)
        step *= 2
    return x / np.sqrt(n)


def hashes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and second nearest signed axis of each vector, for every hash of every table."""
    n, size = unit.shape
    padded = 1 << max(1, (size - 1).bit_length())
    x = np.zeros((n, padded))
    x[:, :size] = unit
    signs = np.random.Generator(np.random.PCG64(8)).integers(0, 2, (TABLES * HASHES, 3, padded)) * 2.0 - 1.0
    nearest = np.empty((n, TABLES * HASHES), dtype=np.int32)
    second = np.empty_like(nearest)
    for number, turns in enumerate(signs):
        turned = x
        for turn in turns:
            turned = _hadamard(turned * turn)
        reach = np.abs(turned)
        top = np.argpartition(-reach, 1, axis=1)[:, :2]
        reached = np.take_along_axis(reach, top, axis=1)
        top = np.where((reached[:, :1] >= reached[:, 1:]), top, top[:, ::-1])
        axis = top * 2 + (np.take_along_axis(turned, top, axis=1) < 0)
        nearest[:, number], second[:, number] = axis[:, 0], axis[:, 1]
    return nearest, second


def _keys(nearest: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """Own key and probed keys, (vectors, tables, 1 + hashes)."""
    own = nearest.reshape(-1, TABLES, HASHES).astype(np.int64)
    other = second.reshape(-1, TABLES, HASHES).astype(np.int64)
    keys = np.empty((*own.shape[:2], 1 + HASHES), dtype=np.int64)
    for probe in range(1 + HASHES):
        parts = own.copy()
        if probe:
            parts[..., probe - 1] = other[..., probe - 1]
        key = np.full(own.shape[:2], size, dtype=np.int64)
        for number in range(HASHES):
            key = key * np.int64(1 << 17) + parts[..., number]
        keys[..., probe] = key
    return keys


def _usable(values: pa.Array) -> list[np.ndarray | None]:
    made = []
    for value in values:
        vector = None
        if value.is_valid and len(value.values) and not value.values.null_count:
            vector = np.asarray(value.values, dtype=np.float64)
            peak = np.abs(vector).max()
            if not np.isfinite(peak) or peak == 0:
                vector = None
        made.append(vector)
    return made


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _keyed(df: DataFrame, vector: str) -> DataFrame:
    """Vectors with a key of their components, null for those that link with nothing."""
    with_node = StructType([*df.schema.fields, StructField("node", StringType())])
    schema = arrow.to_arrow_schema(with_node)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                nodes = [None if v is None else xxhash.xxh3_128_hexdigest(v.tobytes()) for v in _usable(part.column(vector))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.string())], schema=schema)

    return df.mapInArrow(run, with_node)


def _hashed(classes: DataFrame) -> DataFrame:
    """The classes with `keys`: table by table, the key under which a class is entered and those it probes."""
    with_keys = StructType([*classes.schema.fields, StructField("keys", ArrayType(LongType()))])
    schema = arrow.to_arrow_schema(with_keys)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                vectors = [np.asarray(value.values, dtype=np.float64) for value in part.column("vector")]
                sizes = np.array([len(v) for v in vectors])
                keys = np.empty((len(vectors), TABLES * (1 + HASHES)), dtype=np.int64)
                for size in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == size)
                    keys[rows] = _keys(*hashes(_unit(np.stack([vectors[row] for row in rows]))), size).reshape(len(rows), -1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(keys), pa.list_(pa.int64()))], schema=schema)

    return classes.mapInArrow(run, with_keys)


def _met_here(table_no: int, bucket: int, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows meet first in this table, and there under no smaller key than this one."""
    chosen = np.zeros(len(a), dtype=bool)
    for start in range(0, len(a), 1 << 14):
        of_a, of_b = keys[a[start : start + (1 << 14)]], keys[b[start : start + (1 << 14)]]
        at_b = (of_a == of_b[..., :1]).any(axis=2)
        at_a = (of_b == of_a[..., :1]).any(axis=2)
        first = np.argmax(at_a | at_b, axis=1) == table_no
        here_a, here_b = of_a[:, table_no, 0], of_b[:, table_no, 0]
        infinite = np.iinfo(np.int64).max
        least = np.minimum(np.where(at_a[:, table_no], here_a, infinite), np.where(at_b[:, table_no], here_b, infinite))
        chosen[start : start + (1 << 14)] = first & (least == bucket)
    return chosen


def _blocks(batches, cosine: float, schema: pa.Schema):
    """Numbers of links (a, null, n) and links that join components (a, b, 0), block by block."""
    for (table_no, bucket, left, right), table in arrow.runs(batches, ["table_no", "bucket", "left", "right"]):
        if table.num_rows < 2:
            continue
        nodes = table["node"].to_pylist()
        weight = table["copies"].to_numpy()
        own, chunk = np.asarray(table["own"].to_pylist(), dtype=bool), table["chunk"].to_numpy()
        unit = _unit(np.stack([np.asarray(value.values, dtype=np.float64) for value in table["vector"].combine_chunks()]))
        near = unit @ unit.T >= cosine
        allowed = own[:, None] | own[None, :]
        allowed &= (chunk[:, None] != chunk[None, :]) if left != right else np.triu(np.ones_like(near), 1)
        a, b = np.nonzero(np.triu(near & allowed, 1))
        if not len(a):
            continue
        keys = np.asarray(table["keys"].combine_chunks().flatten()).reshape(len(nodes), TABLES, 1 + HASHES)
        met = _met_here(table_no, bucket, keys, a, b)
        a, b = a[met], b[met]
        n = np.bincount(a, weight[b], len(nodes)) + np.bincount(b, weight[a], len(nodes))
        roots = list(range(len(nodes)))

        def find(row: int) -> int:
            while roots[row] != row:
                roots[row] = row = roots[roots[row]]
            return row

        rows = [(nodes[row], None, int(n[row])) for row in np.flatnonzero(n).tolist()]
        for first, second in zip(a.tolist(), b.tolist()):
            x, y = find(first), find(second)
            if x != y:
                roots[x] = y
                rows.append((nodes[first], nodes[second], 0))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind.type) for c, kind in zip(zip(*rows), schema)], schema=schema)


def near_vectors(df: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector: its id, n_links, component_id (the smallest id that links reach) and kept."""
    keyed = written(_keyed(df.select(F.col(vec_id).alias("vec"), F.col(vector).alias("vector")), "vector"), "vectors")
    classes = written(
        keyed.where("node is not null").groupBy("node").agg(F.min("vec").alias("first_vec"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")),
        "vector-classes",
    )
    hashed = written(_hashed(classes.select("node", "copies", "vector")), "vector-keys")
    entries = hashed.select("node", F.posexplode("keys").alias("place", "bucket")).select(
        "node", F.floor(F.col("place") / (1 + HASHES)).cast("int").alias("table_no"), "bucket", (F.col("place") % (1 + HASHES) == 0).alias("own")
    )
    shared = entries.groupBy("table_no", "bucket").agg(F.count("*").alias("n"), F.count_if("own").alias("n_own")).where("n > 1 and n_own > 0")
    placed = entries.join(shared.select("table_no", "bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), ["table_no", "bucket"])
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    at = F.col("chunk")
    blocks = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, at).alias("left"), F.greatest(c, at).alias("right")))
    dealt = chunked.select("node", "table_no", "bucket", "own", "chunk", F.explode(blocks).alias("block"))
    filled = dealt.select("node", "table_no", "bucket", "own", "chunk", "block.left", "block.right").join(hashed, "node")
    ordered = filled.repartition("table_no", "bucket", "left", "right").sortWithinPartitions("table_no", "bucket", "left", "right", "node")
    ddl = "a string, b string, n long"
    found = written(ordered.mapInArrow(partial(_blocks, cosine=cosine, schema=arrow.arrow_schema(ddl)), ddl), "vector-links")

    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    final = components(found.where("b is not null").select("a", "b"))
    first = classes.select("node", "first_vec", "copies")
    least = final.join(first, "node").groupBy("root").agg(F.min("first_vec").alias("component_id"))
    by_class = (
        first.join(counts, "node", "left").join(final.join(least, "root").select("node", "component_id"), "node", "left")
        .select("node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first_vec").alias("component_id"))
    )
    told = keyed.select("vec", "node").join(by_class, "node", "left")
    return told.select(
        F.col("vec").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec").cast("long").alias("component_id"),
    ).withColumn("kept", F.col(vec_id).eqNullSafe(F.col("component_id")))
