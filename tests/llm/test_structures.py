"""Archives, periodic runs and repaired conversations, against brute force and round trips."""

import hashlib
import heapq
import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.errors import PySparkException

from feedlake.llm import arrow, turn_dawg, warc_zstd, word_runs
from feedlake.llm.queries import QUERIES
from feedlake.llm.tables import read
from feedlake.sources.scratch import new_folder

SF_DIR = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


# -- archives --------------------------------------------------------------------


def archived(spark, rows, **how):
    folder = new_folder(spark, "test-archives")
    warc_zstd.write_archives(spark.createDataFrame(rows, PAGES), folder, **how)
    return folder


def test_archives_read_back_what_was_written(spark):
    long_one, big = "é" * 600, "x\r\n\r\n" * 400_000
    rows = [
        (1, "http://a/ü b\r\n", long_one), (2, None, long_one), (3, "http://c", "short"), (4, "", "short"), (5, "u", None), (6, "u", ""), (7, "u", big),
        (9, "u", "y" * 1000), (9, "u", "y" * 1000), (8, "u", "y" * 1000), (None, "u", "y" * 1000), (None, "u", "z" * 2000), (None, "u", "z" * 2000),
        (20, "u", "w" * 999), (21, "u", "w" * 999),
    ]
    folder = archived(spark, rows)
    records = warc_zstd.read_archives(spark, folder)
    assert records.where("error is not null").isEmpty()
    told = {(r.page_id, r.record_type): bytes(r.payload or b"") for r in records.collect()}
    assert told[2, "response"] == long_one.encode() and told[1, "revisit"] == b"" and told[7, "response"] == big.encode()
    uris = {r.page_id: r.target_uri for r in records.where("page_id < 5").collect()}
    assert uris == {1: "http://a/%C3%BC%20b%0D%0A", 2: None, 3: "http://c", 4: ""}
    got = sorted(warc_zstd.resolved(records).collect(), key=str)

    def expected(page_id, html):
        payload = (html or "").encode()
        keeper = max((p for p, _, h in rows if h == html and p is not None), default=None) if len(payload) >= 1000 else None
        revisit = keeper is not None and keeper != page_id
        return (page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None)

    assert [tuple(row) for row in got] == [tuple(row) for row in sorted((spark.createDataFrame([expected(p, h) for p, _, h in rows], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long").collect()), key=str)]


def test_archives_are_files_that_other_readers_decode(spark):
    rng = random.Random(7)
    rows = [(n, f"http://h/{n}", f"<html><head><title>{n}</title></head><body>" + " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(200))) for n in range(300)]
    folder = archived(spark, rows, archive_bytes=4000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    assert len(files) > 8
    seen = 0
    for file in files:
        data = bytes(file.content)
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).stream_reader(data[8 + size :], read_across_frames=True)
        seen += reader.read().count(b"WARC/1.1\r\n")
    assert seen == len(rows)
    assert warc_zstd.read_archives(spark, folder).where("record_type = 'response' and error is null").count() == len(rows)


def test_a_foreign_archive_with_a_plain_dictionary(spark, tmp_path):
    samples = [warc_zstd.record(n, "http://x", b"body %d" % n * 30, "2020-01-01T00:00:00Z") for n in range(200)]
    dictionary = zstandard.train_dictionary(4096, samples)
    packer = zstandard.ZstdCompressor(dict_data=dictionary)
    raw = dictionary.as_bytes()
    (tmp_path / "a.warc.zst").write_bytes(struct.pack("<II", 0x184D2A5D, len(raw)) + raw + b"".join(map(packer.compress, samples)))
    (tmp_path / "b.warc.zst").write_bytes(b"".join(map(zstandard.ZstdCompressor().compress, samples)))
    read_back = warc_zstd.read_archives(spark, str(tmp_path))
    assert read_back.where("error is null").groupBy("archive").count().where("count = 200").count() == 2


@pytest.mark.parametrize("spoil, error", [
    (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "version"), (lambda r: r.replace(b"WARC-Date", b"WARC-Dato"), "warc-date"),
    (lambda r: r[:-4], "content-length"), (lambda r: r + r, "content-length"), (lambda r: r.replace(b"Content-Length: 8", b"Content-Length: x"), "no number"),
    (lambda r: r.replace(b"hello", b"hullo"), "block digest"), (lambda r: r.replace(b"WARC-Type:", b"WARC Type:"), "malformed"),
])
def test_a_broken_record_is_told_and_passed_over(spark, tmp_path, spoil, error):
    good = warc_zstd.record(1, "u", b"hello", "2020-01-01T00:00:00Z")
    spoiled = spoil(good)
    assert spoiled != good
    pack = zstandard.ZstdCompressor().compress
    (tmp_path / "a").write_bytes(pack(good) + pack(spoiled) + pack(good))
    rows = warc_zstd.read_archives(spark, str(tmp_path)).orderBy("frame_offset").collect()
    assert [r.error is None for r in rows] == [True, False, True] and error in rows[1].error
    with pytest.raises(PySparkException, match=error):
        warc_zstd.resolved(warc_zstd.read_archives(spark, str(tmp_path))).collect()


def test_a_damaged_frame_is_passed_over_up_to_the_next_separator(spark, tmp_path):
    pack, separator = zstandard.ZstdCompressor(write_checksum=True).compress, warc_zstd.SEPARATOR.encode()
    good = pack(warc_zstd.record(1, "u", b"hello" * 50, "2020-01-01T00:00:00Z"))
    bad = good[:-6] + b"\0" + good[-5:]
    (tmp_path / "a").write_bytes(good + separator + bad + separator + good + separator + good[:20])
    assert [r.error is None for r in warc_zstd.read_archives(spark, str(tmp_path)).orderBy("frame_offset").collect()] == [True, False, True, False]


def test_an_empty_table_writes_no_archive(spark):
    folder = archived(spark, [])
    assert warc_zstd.resolved(warc_zstd.read_archives(spark, folder)).isEmpty()


# -- runs ------------------------------------------------------------------------


def brute_runs(own):
    """Runs by comparing the words at every distance."""
    numbers, found = np.unique(np.array(own, dtype=object).astype(bytes), return_inverse=True)[1] if own else np.zeros(0, int), []
    for q in range(1, len(own) // 3 + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + q
            if length >= max(24, 3 * q):
                part = numbers[start : start + length]
                if not any((part[d:] == part[:-d]).all() for d in range(1, q) if q % d == 0):
                    found.append((start, length, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_collapse(own, found):
    gone = set()
    for start, length, q in found:
        gone.update(range(start + q, start + length))
    return b" ".join(word for at, word in enumerate(own) if at not in gone)


def test_runs_of_random_repetitive_words():
    rng, total = random.Random(5), 0
    for _ in range(1500):
        own, alphabet = [], [b"a", b"b", b"c"][: rng.choice([1, 2, 3])]
        while len(own) < rng.randrange(1, 200):
            own += ([rng.choice(alphabet) for _ in range(rng.randrange(1, 14))] * rng.randrange(1, 9))[: rng.randrange(1, 80)]
        found = word_runs.runs(own)
        assert found == brute_runs(own)
        assert b" ".join(word_runs.collapsed(own, found)) == brute_collapse(own, found)
        total += len(found)
    assert total > 1000


def made_periodic(doc_id, text):
    own = (text or "").encode()
    own = [w for w in own.translate(bytes(0x20 if 9 <= c <= 13 else c for c in range(256))).split(b" ") if w]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(own)
    if h % 10 == 0 and n:
        a, out = g % n, list(own)
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            out[i] = own[a + (i - a) % p]
        own = out
    return own


def test_the_query_against_brute_force(spark):
    docs = {row.doc_id: row.text for row in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    got = QUERIES["op12_word_runs"](spark, SF_DIR).collect()
    assert len(got) == len(docs) and sum(row.n_runs for row in got) > 10
    for row in got:
        own = made_periodic(row.doc_id, docs[row.doc_id])
        found = brute_runs(own)
        best = min(found, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert tuple(row) == (
            row.doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapse(own, found)).hexdigest(),
        )


def test_odd_documents(spark):
    texts = [None, "", " \t\n", "a", "a " * 24, "a " * 23, "a b " * 30, "a b c d e f g h " * 3, "a b c d e f g h " * 3, "x " * 300_000, "ß " * 12 + "ss " * 12]
    docs = spark.createDataFrame([(n, text, "kept", n) for n, text in enumerate(texts)], "runs2 int, text string, note string, n int")
    rows = {row.n: row for row in word_runs.collapse_runs(docs, ["n", "note"]).collect()}
    assert [(rows[n].n_words, len(rows[n].runs)) for n in rows] == [(0, 0), (0, 0), (0, 0), (1, 0), (24, 1), (23, 0), (30, 1), (24, 1), (24, 1), (300_000, 1), (24, 0)]
    assert rows[7].best.asDict() == {"start": 0, "length": 24, "period": 8} and bytes(rows[7].collapsed) == b"a b c d e f g h" and rows[3].collapsed is None
    assert word_runs.collapse_runs(docs.limit(0), ["n"]).isEmpty()


# -- conversations ---------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def best_audit(signature):
    """Cheapest edits by search over all of them."""
    queue, seen = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(signature) and state in (0, 3):
            return cost, audit
        after = 3 if state == 2 else 2
        heapq.heappush(queue, (cost + 3, audit + "I", at, after))
        if at < len(signature):
            symbol = signature[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, state))
            if symbol != "x":
                stays = 3 if symbol.isupper() else 0
                heapq.heappush(queue, (cost + 3 + stays, audit + "R", at + 1, after))
                if symbol.lower() == ("a" if state == 2 else "u"):
                    heapq.heappush(queue, (cost + stays, audit + "K", at + 1, after))
                if symbol.lower() == "s" and state == 0:
                    heapq.heappush(queue, (cost + stays, audit + "K", at + 1, 1))


def brute_repair(rows):
    rows = sorted(((t is not None, t or 0, r or " " if r is None else r, " " if x is None else x) for _, t, r, x in rows))
    seen, signature, faults, illegal, before = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}, 0, None
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        signature += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    numbers = [turn for known, turn, _, _ in rows if known]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = best_audit(signature)
    out, at = [], 0
    for letter in audit:
        said = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((said, ""))
            continue
        _, _, role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((role if letter == "K" else said, text))
    return gaps, *faults.values(), illegal, cost, audit, out


def test_repair_against_search(spark):
    rng, rows = random.Random(3), []
    for conv in range(400):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "u2", "", None, "user", "assistant"])
            text = rng.choice(["Hi.", "Yes!  ", "no", "", " \n", None, "é?", "Why? ", "a:b\nc."])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 3, None, 2]), role, text))
    rows += [(1000, 0, "user", "Hi."), (1000, 0, "user", "Hi."), (1000, 1, "assistant", "<ok>."), (1000, 5, "user", "Hi.")]
    long_one = [(2000, n, ("user", "assistant")[n % 2], f"turn {n}.") for n in range(30_000)]
    prepared = turn_dawg.rows_of(spark.createDataFrame(rows + long_one, TURNS).withColumn("audit", turn_dawg.F.lit(1)).repartition(5))
    reported = turn_dawg.reports(prepared)
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    turns = {}
    for row in turn_dawg.repaired_turns(prepared, reported).orderBy("conv_id", "place").collect():
        turns.setdefault(row.conv_id, []).append((row.role, row.text))
    got = {row.conv_id: row for row in reported.collect()}
    assert got.keys() == by_conv.keys() | {2000} and got[2000].audit == "K" * 30_000 and got[2000].cost == 0
    for conv, own in by_conv.items():
        *numbers, out = brute_repair(own)
        assert (got[conv].gaps, got[conv].blank, got[conv].duplicate, got[conv].truncated, got[conv].illegal, got[conv].cost, got[conv].audit) == tuple(numbers), own
        assert turns.get(conv, []) == out
    digests = {row.conv_id: row.repaired_sha256 for row in turn_dawg.repaired_digests(turn_dawg.repaired_turns(prepared, reported)).collect()}
    assert digests == {conv: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in said).encode()).hexdigest() for conv, said in turns.items()}


def test_every_ending_is_one_node(spark):
    rng = random.Random(9)
    signatures = ["".join(rng.choice("xsuaoSUAO") for _ in range(rng.randrange(0, 9))) for _ in range(3000)]
    rows = turn_dawg.audits(spark.createDataFrame([(s,) for s in signatures], "signature string").coalesce(1)).collect()
    assert sorted(row.signature for row in rows) == sorted(set(signatures))
    assert all((row.cost, row.audit) == best_audit(row.signature) for row in rows)
    endings = {s[at:] for s in signatures for at in range(len(s))}
    assert len(endings) <= sum(row.nodes for row in rows) <= len(endings) + 9 * 8


def test_no_conversations(spark):
    rows = turn_dawg.rows_of(spark.createDataFrame([], TURNS))
    reported = turn_dawg.reports(rows)
    assert reported.isEmpty() and turn_dawg.repaired_digests(turn_dawg.repaired_turns(rows, reported)).isEmpty()
