"""WARC archives of one Zstandard frame per record, written and read back by Spark.

An archive begins with a skippable frame that holds the dictionary, itself compressed, and then has one frame per record. Spark's text
writer puts the frames into files of any store: a line is a frame, and the line separator is the eight bytes of an empty skippable
frame, which readers of the format pass over. A task closes an archive when it has `ARCHIVE_BYTES` and begins the next, so that
files stay small enough to be read as wholes, one task for several of them.

Of records with equal payloads of at least `REVISIT_BYTES`, that with the largest page_id is the response, and the others are revisits that name it and
have no payload. Equal payloads are found by their SHA-256 and length; payloads are not shuffled for it, unless more than
`BROADCAST_PAYLOADS` of them are repeated. The dictionary is trained on the beginnings of at most `SAMPLE_PAGES` pages, those with the smallest hashes.

The reader loads the dictionary, decodes frame by frame, and checks each record: its version, the fields that every record must have, the
length of its block against the length that it states, the end of the record, and block and payload digests. A record that fails has its
`error` and is passed over; what cannot be decoded is passed over up to the next separator.

A null html is an empty payload, a null url has no field. Rows that share the largest page_id of a payload are all responses; rows without an id
revisit a payload that a row with an id has, and are responses else. Repeated rows are records of their own. An empty table writes no archive,
which reads as no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.tables import written

#: Fixed values of the format: magic numbers of frames; the empty skippable frame that separates records.
FRAME, DICTIONARY_FRAME, SKIPPABLE = 0xFD2FB528, 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
SEPARATOR = "P*M\x18\0\0\0\0"
#: Payload bytes from which equal ones are revisits.
REVISIT_BYTES = 1000
#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: Pages whose beginnings the dictionary is trained on, bytes of each, and the dictionary's size.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 512, 8192, 32 << 10
#: Repeated payloads up to which they are broadcast, some 60 bytes each.
BROADCAST_PAYLOADS = 1 << 20
LEVEL = 3
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("6f1c1d1e-53a4-5b5e-9a51-3f2f0c7d2a11")
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def trained_dictionary(pages: DataFrame) -> bytes:
    """A dictionary for payloads like these; empty if there are too few to learn from.

    Pages are chosen by a hash of id and address, so that tasks hand on 8 bytes for each of their smallest ones; pages
    with one hash count as one.
    """
    hashed = pages.select(F.xxhash64("page_id", "url").alias("at"), F.substring("html", 1, SAMPLE_CHARS).alias("begun"))
    chosen = written(hashed.select("at").distinct().orderBy("at").limit(SAMPLE_PAGES), "sampled-pages")
    begun = hashed.join(F.broadcast(chosen), "at", "left_semi").groupBy("at").agg(F.min("begun").alias("begun"))
    samples = [row.begun.encode() for row in begun.orderBy("at").collect() if row.begun]  # at most SAMPLE_PAGES beginnings
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id} {payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, date: str, revisits: int | None = None) -> bytes:
    """A response record, or one that revisits the payload of the page `revisits`."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    of_payload = digest(payload)
    block = head + (payload if revisits is None else b"")
    fields = [("WARC-Type", "response" if revisits is None else "revisit"), ("WARC-Record-ID", _record_id(page_id, of_payload)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisits is not None:
        fields += [("WARC-Refers-To", _record_id(revisits, of_payload)), ("WARC-Profile", IDENTICAL)]
    fields += [
        ("WARC-Payload-Digest", of_payload), ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    told = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"".join([b"WARC/1.1\r\n", told.encode(), b"\r\n", block, b"\r\n\r\n"])


def _payload_key(html: str) -> tuple[Column, Column]:
    payload = F.coalesce(F.col(html), F.lit(""))
    return F.unhex(F.sha2(payload, 256)), F.octet_length(payload).cast("long")


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, revisits): the page whose payload a page repeats, or null."""
    of_payload, size = _payload_key("html")
    told = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", of_payload.alias("payload_sha"), size.alias("size"))
    long_ones = told.where(F.col("size") >= REVISIT_BYTES)
    groups = long_ones.groupBy("payload_sha", "size").agg(F.count("*").alias("copies"), F.max("page_id").alias("response"))
    repeated = written(groups.where("copies > 1 and response is not null").drop("copies"), "repeated-payloads")
    if repeated.count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    other = ~F.col("page_id").eqNullSafe(F.col("response"))
    return told.join(repeated, ["payload_sha", "size"], "left").select("page_id", "url", "html", F.when(other, F.col("response")).alias("revisits"))


_FRAMES = "archive string, place long, frame binary"


def _frames(batches, schema: pa.Schema, dictionary: bytes, date: str, archive_bytes: int):
    """Frames of records, dealt to archives of bounded size; the dictionary comes first in each."""
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
    first = [dictionary_frame(dictionary)] if dictionary else []
    task, number, held, place = TaskContext.get().partitionId(), 0, 0, 0
    for batch in batches:
        for part in arrow.slices(iter([batch]), "html"):
            rows = []
            for page_id, url, html, revisits in zip(*(part.column(name).to_pylist() for name in ("page_id", "url", "html", "revisits"))):
                frames = [packer.compress(record(page_id, url, (html or "").encode(), date, revisits))]
                if held >= archive_bytes:
                    number, held = number + 1, 0
                for frame in frames if held else first + frames:
                    rows.append((f"{task:06d}-{number:06d}", place, frame))
                    place += 1
                    held += len(frame)
            yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def write_archives(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", dictionary: bytes | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row of (page_id, url, html) to archives below `folder`.

    Tasks number their archives themselves and the writer's commit makes each appear once, also if a task is run again.
    """
    dictionary = trained_dictionary(pages) if dictionary is None else dictionary
    framed = partial(_frames, schema=arrow.arrow_schema(_FRAMES), dictionary=dictionary, date=date, archive_bytes=archive_bytes)
    made = arrow.mapped(with_revisits(pages), framed, _FRAMES)
    lines = made.sortWithinPartitions("archive", "place").select("archive", F.col("frame").cast("string").alias("frame"))
    lines.write.partitionBy("archive").option("lineSep", SEPARATOR).mode("overwrite").text(folder)


class BrokenRecord(ValueError):
    """A record or frame that does not follow the format."""


def frames(data: bytes):
    """(offset, content or error) of every record frame of an archive; skippable frames are passed over."""
    at, known, separator = 0, None, SEPARATOR.encode()
    while at < len(data):
        start = at
        try:
            if len(data) - at < 8:
                raise BrokenRecord("cut off frame")
            magic, size = struct.unpack_from("<II", data, at)
            if magic in SKIPPABLE:
                if at + 8 + size > len(data):
                    raise BrokenRecord("cut off frame")
                if magic == DICTIONARY_FRAME and at == 0:
                    known = _dictionary(data[8 : 8 + size])
                at += 8 + size
                continue
            if magic != FRAME:
                raise BrokenRecord("no frame")
            made = []
            decoder = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            while not decoder.eof:
                fed = data[at : at + (1 << 16)]
                if not fed:
                    raise BrokenRecord("cut off frame")
                made.append(decoder.decompress(fed))
                at += len(fed)
            at -= len(decoder.unused_data)
            yield start, b"".join(made)
        except (BrokenRecord, zstandard.ZstdError) as error:
            yield start, BrokenRecord(str(error))
            found = data.find(separator, start + 1)
            at = len(data) if found < 0 else found


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    if content[:4] == struct.pack("<I", FRAME):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Fields, by lower-case names, and block of a record; raises if it does not follow the format."""
    head, found, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise BrokenRecord("no record of a known version")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            raise BrokenRecord("malformed field")
        fields[name.decode().lower()] = value.decode("utf-8", "replace").strip()
    for name in _REQUIRED:
        if not fields.get(name):
            raise BrokenRecord(f"no {name}")
    if not fields["content-length"].isascii() or not fields["content-length"].isdigit():
        raise BrokenRecord("content-length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BrokenRecord(f"content-length {size}, but {len(rest)} bytes follow the fields")
    block = rest[:size]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != digest(block):
        raise BrokenRecord("block digest differs")
    return fields, block


def _payload(fields: dict[str, str], block: bytes) -> bytes | None:
    """The payload of a response, checked against its digest; None for records of other types."""
    if fields["warc-type"] == "revisit" and not fields.get("warc-refers-to"):
        raise BrokenRecord("no warc-refers-to")
    if fields["warc-type"] != "response":
        return None
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise BrokenRecord("no payload")
    stated = fields.get("warc-payload-digest")
    if stated is not None and stated != digest(payload):
        raise BrokenRecord("payload digest differs")
    return payload


_RECORDS = (
    "archive string, frame_offset long, record_type string, record_id string, target_uri string, page_id long, refers_to string,"
    " payload_digest string, payload_bytes long, payload binary, error string"
)


def _sha1(stated: str | None) -> str | None:
    """Lower-case hexadecimal form of a `sha1:` digest."""
    if not stated or not stated.startswith("sha1:"):
        return None
    return base64.b32decode(stated[5:]).hex()


def _records(batches, schema: pa.Schema, payloads: bool):
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, held = [], 0
            for offset, content in frames(data.as_py()):
                row = {"archive": path, "frame_offset": offset}
                try:
                    if isinstance(content, BrokenRecord):
                        raise content
                    fields, block = parsed(content)
                    payload = _payload(fields, block)
                    page_id = fields.get("page-id")
                    row |= {
                        "record_type": fields["warc-type"], "record_id": fields["warc-record-id"], "target_uri": fields.get("warc-target-uri"),
                        "page_id": None if page_id is None else int(page_id), "refers_to": fields.get("warc-refers-to"),
                        "payload_digest": _sha1(fields.get("warc-payload-digest")), "payload_bytes": None if payload is None else len(payload),
                        "payload": payload if payloads else None,
                    }
                    held += len(payload or b"") if payloads else 0
                except ValueError as error:
                    row["error"] = str(error)
                rows.append(row)
                if len(rows) >= 4096 or held >= arrow.SLICE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below `folder`: its place, type, ids, digest, payload, or what is wrong with it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    return arrow.mapped(files, partial(_records, schema=arrow.arrow_schema(_RECORDS), payloads=payloads), _RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits with the id and the size of the payload they stand for; fails on a record with an error.

    A revisit whose response is not in the archives has neither. `records` is read twice and should be a written table.
    """
    sound = records.withColumn("record_type", F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error(F.concat_ws(": ", "archive", "error"))))
    responses = sound.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("response_page"), F.col("payload_bytes").alias("response_bytes")
    )
    once = responses.groupBy("refers_to").agg(F.max("response_page").alias("response_page"), F.max("response_bytes").alias("response_bytes"))
    revisits = sound.where("record_type = 'revisit'").join(once, "refers_to", "left").select(
        "page_id", F.col("response_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("response_page").alias("refers_to")
    )
    own = sound.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    return own.unionByName(revisits)
