"""Near-duplicates by b-bit MinHash.

A document's set is its distinct shingles of so many words. Documents with equal sets form a class, and only classes go
on. Of each of 128 minima the low 16 bits are kept, four to a 64-bit word: 32 words, and each word is a band. Classes
that agree in a band share a bucket. A pair with similarity 0.8 misses all bands with a probability of 5e-8.

Two steps find the links that decide the components, without writing out the pairs of a bucket:

1. Every class is compared with one hub, the class with the smallest document of its buckets. Its similarity is
   estimated from the signatures, counting equal 16-bit lanes and taking off chance agreement, and confirmed on the full sets.
2. Buckets whose members are not all in one component yet are worked through in blocks of bounded size. Only members outside the
   component of the bucket's hub are compared with the others. In a block, pairs of different components are met in their
   first common band, by estimate, most alike first, and confirmed on full sets; links join components as they
   are found, so that pairs that add nothing are passed over.

A document with fewer words than a shingle has its whole word sequence as its only shingle; one without words, or a null
text, has an empty set and is linked with nothing. Repeated rows are in one class; rows without an id, and rows that share an id, are
judged by their own sets. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow, words
from feedlake.llm.graph import components
from feedlake.llm.tables import written

MINIMA, BITS, LANES = 128, 16, 4
BANDS = MINIMA // LANES
#: A pair is linked from this share in per cent; estimates this far below are passed over (more than 5 deviations).
PERCENT, MARGIN = 80, 0.2
#: Shingles in a chunk of a bucket; a block holds two chunks.
CHUNK = 1 << 18
#: Documents up to which candidate numbers are broadcast, 8 bytes each.
BROADCAST_IDS = 1 << 20

_rng = np.random.Generator(np.random.PCG64(5))
_PLACES = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(1, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_HIGH = np.uint64(0x8000800080008000)
_LOW = np.uint64(0x7FFF7FFF7FFF7FFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; words are split at ASCII white space, A-Z lower-cased."""
    own = words.hashes(text.lower().split())
    if not len(own):
        return own
    width = min(size, len(own))
    mixed = np.full(len(own) - width + 1, np.uint64(width))
    for place in range(width):
        mixed = mixed + own[place : len(own) - width + 1 + place] * _PLACES[place]
    return np.unique(_mixed(mixed))


def signature(own: np.ndarray) -> np.ndarray:
    """Low bits of the minima of a set, four to a word."""
    short = (own >> np.uint64(32)).astype(np.uint32)
    minima = np.full(MINIMA, np.uint32(0xFFFFFFFF))
    for start in range(0, len(short), 1024):
        hashed = short[start : start + 1024] * _FACTORS[:, None] + _OFFSETS[:, None]
        minima = np.minimum(minima, hashed.min(axis=1))
    return (minima & np.uint32(0xFFFF)).astype(np.uint16).view(np.uint64)


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of one packed signature to many, corrected for lanes that agree by chance."""
    differing = one ^ many
    nonzero = (((differing & _LOW) + _LOW) | differing) & _HIGH
    agreeing = 1 - np.bitwise_count(nonzero).sum(axis=-1, dtype=np.int64) / MINIMA
    chance = 2.0**-BITS
    return (agreeing - chance) / (1 - chance)


def _described(docs: DataFrame, size: int, keep: list[str], text: str) -> DataFrame:
    """Number of shingles, a 128-bit key of the set (null if empty), and the signature words of each document."""

    def make():
        def described(values: list[bytes]) -> dict:
            sets = [shingle_set(value, size) for value in values]
            return {
                "n_shingles": [len(own) for own in sets],
                "set_key": [xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None for own in sets],
                "bands": [signature(own).view(np.int64) if len(own) else None for own in sets],
            }

        return described

    return arrow.per_text(docs, "n_shingles long, set_key binary, bands array<long>", make, keep, text)


def _sets(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(doc, set_key, shingles) of documents."""

    def make():
        def sets_of(values: list[bytes]) -> dict:
            sets = [shingle_set(value, size) for value in values]
            return {"set_key": [xxhash.xxh3_128_digest(own.tobytes()) for own in sets], "shingles": [own.view(np.int64) for own in sets]}

        return sets_of

    return arrow.per_text(docs, "set_key binary, shingles array<long>", make, [doc_id], text).withColumnRenamed(doc_id, "doc")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _linked(a: Column, b: Column, percent: int) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= percent * (F.size(a) + F.size(b) - shared)


def _estimated(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, bands_a, bands_b) whose estimated similarity is not clearly too low."""
    ddl = "a binary, b binary"
    schema = arrow.arrow_schema(ddl)

    def likely(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = [np.asarray(batch.column(name).flatten()).view(np.uint64).reshape(-1, BANDS) for name in ("bands_a", "bands_b")]
            alike = pa.array(estimates(*packed) >= percent / 100 - MARGIN)
            yield pa.RecordBatch.from_arrays([batch.column(name).filter(alike) for name in ("a", "b")], schema=schema)

    return arrow.mapped(pairs, likely, ddl)


def _blocks(batches, percent: int, schema: pa.Schema):
    """Links that join components, of the blocks that follow one another in sorted rows."""
    for (band, *_), table in arrow.runs(batches, ["band", "bucket", "left", "right"]):
        nodes, labels = table["node"].to_pylist(), table["label"].to_pylist()
        outside = np.asarray(table["outside"].to_pylist(), dtype=bool)
        packed = np.asarray(table["bands"].combine_chunks().flatten()).view(np.uint64).reshape(-1, BANDS)
        sets = table["shingles"].combine_chunks()
        roots = {label: label for label in labels}

        def find(label: bytes) -> bytes:
            while roots[label] != label:
                roots[label] = label = roots[roots[label]]
            return label

        pairs, across = [], not outside.all()
        for row in np.flatnonzero(outside).tolist():
            alike = estimates(packed[row], packed)
            for other in np.flatnonzero(alike >= percent / 100 - MARGIN).tolist():
                if labels[other] == labels[row] or outside[other] and (across or other <= row):
                    continue
                if int(np.argmax(packed[row] == packed[other])) == band:
                    pairs.append((-alike[other], row, other))
        found = []
        for _, row, other in sorted(pairs):
            first, second = find(labels[row]), find(labels[other])
            if first != second and _similar(*(sets[at].values.to_numpy().view(np.uint64) for at in (row, other)), percent):
                roots[first] = second
                found.append((nodes[row], nodes[other]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in zip(*found)], schema=schema)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, n_shingles, component_id (the smallest id that links reach) and kept."""
    described = written(_described(docs, size, [doc_id], text).withColumnRenamed(doc_id, "doc"), "shingled")
    classes = written(
        described.where("set_key is not null").groupBy("set_key").agg(F.min("doc").alias("first_doc"), F.max("n_shingles").alias("n"), F.any_value("bands").alias("bands")).withColumnRenamed("set_key", "node"),
        "classes",
    )
    members = classes.select("node", "first_doc", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = written(members.groupBy("band", "bucket").agg(F.min(F.struct("first_doc", "node")).alias("hub"), F.count("*").alias("n_members")).where("n_members > 1"), "buckets")
    in_buckets = written(members.join(shared.select("band", "bucket", "hub"), ["band", "bucket"]).select("node", "first_doc", "n", "band", "bucket", "hub"), "members")

    wanted = in_buckets.select("node", F.col("first_doc").alias("doc")).distinct()
    wanted_docs = wanted.select(F.col("doc").alias(doc_id)).distinct()
    if wanted_docs.count() <= BROADCAST_IDS:
        wanted_docs = F.broadcast(wanted_docs)
    texts = docs.select(doc_id, text).join(wanted_docs, doc_id, "left_semi")
    if not wanted.where("doc is null").isEmpty():
        texts = texts.unionByName(docs.select(doc_id, text).where(F.col(doc_id).isNull()))
    sets = _sets(texts, size, doc_id, text).groupBy(F.col("set_key").alias("node")).agg(F.any_value("shingles").alias("shingles"))
    sets = written(sets.join(wanted.select("node").distinct(), "node", "left_semi"), "sets")

    signatures = classes.select("node", "bands")
    stars = in_buckets.groupBy("node").agg(F.min("hub.first_doc").alias("_"), F.min("hub").alias("hub")).select(F.col("node").alias("a"), F.col("hub.node").alias("b")).where("a <> b")
    pairs = stars.join(signatures.toDF("a", "bands_a"), "a").join(signatures.toDF("b", "bands_b"), "b")
    likely = _estimated(pairs.select("a", "b", "bands_a", "bands_b"), percent)
    confirmed = likely.join(sets.toDF("a", "shingles_a"), "a").join(sets.toDF("b", "shingles_b"), "b")
    star_links = written(confirmed.where(_linked(F.col("shingles_a"), F.col("shingles_b"), percent)).select("a", "b"), "star-links")

    roots = components(star_links)
    labelled = in_buckets.join(roots, "node", "left").select(
        "band", "bucket", "node", "first_doc", "n", F.coalesce("root", "node").alias("label")
    )
    by_label = labelled.groupBy("band", "bucket", "label").agg(F.min("first_doc").alias("first_doc"), F.sum("n").alias("weight"))
    by_bucket = by_label.groupBy("band", "bucket").agg(
        F.min(F.struct("first_doc", "label", "weight")).alias("hub"), F.sum("weight").alias("weight"), F.count("*").alias("n_labels")
    )
    open_buckets = by_bucket.where("n_labels > 1").select(
        "band", "bucket", F.col("hub.label").alias("hub_label"),
        F.ceil((F.col("weight") - F.col("hub.weight")) / CHUNK).cast("int").alias("outer"), F.ceil(F.col("hub.weight") / CHUNK).cast("int").alias("inner"),
    )
    opened = labelled.join(open_buckets, ["band", "bucket"]).withColumn("outside", F.col("label") != F.col("hub_label"))
    links = star_links.unionByName(_block_links(opened, signatures, sets, percent))
    final = components(links)

    first = classes.select("node", "first_doc")
    least = final.join(first, "node").groupBy("root").agg(F.min("first_doc").alias("component_id"))
    reached = final.join(least, "root").select("node", "component_id")
    by_class = first.join(reached, "node", "left").select(F.col("node").alias("set_key"), F.coalesce("component_id", "first_doc").alias("component_id"))
    told = described.select("doc", "n_shingles", "set_key").join(by_class, "set_key", "left").select("doc", "n_shingles", F.coalesce("component_id", "doc").alias("component_id"))
    return told.select(F.col("doc").alias(doc_id), "n_shingles", "component_id", F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def _block_links(opened: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within buckets that hold several components.

    Members outside the hub's component are dealt to `outer` chunks by hash, those inside to `inner` ones. A block
    (left, right) holds an outer chunk and another chunk, outer or inner, so that an inner member is copied once per outer
    chunk.
    """

    def dealt_to(chunks: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(chunks)).cast("int")

    def numbers(chunks: str) -> Column:
        return F.sequence(F.lit(0), F.col(chunks) - 1)

    def blocks(left: Column, right: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"))

    own = opened.withColumn("chunk", F.when(F.col("outside"), dealt_to("outer")).otherwise(dealt_to("inner")))
    at = F.col("chunk")
    with_outer = F.transform(numbers("outer"), lambda c: blocks(F.least(c, at), F.greatest(c, at)))
    with_inner = F.transform(numbers("inner"), lambda c: blocks(at, F.col("outer") + c))
    of_inner = F.transform(numbers("outer"), lambda c: blocks(c, F.col("outer") + at))
    places = F.when(F.col("outside"), F.concat(with_outer, with_inner)).otherwise(of_inner)
    dealt = own.select("band", "bucket", "node", "label", "outside", F.explode(places).alias("block"))
    filled = dealt.select("band", "bucket", "block.left", "block.right", "node", "label", "outside").join(signatures, "node").join(sets, "node")
    ordered = filled.repartition("band", "bucket", "left", "right").sortWithinPartitions("band", "bucket", "left", "right", "node")
    ddl = "a binary, b binary"
    schema = arrow.arrow_schema(ddl)
    columns = ["band", "bucket", "left", "right", "node", "label", "outside", "bands", "shingles"]
    return arrow.mapped(ordered.select(*columns), partial(_blocks, percent=percent, schema=schema), ddl)
