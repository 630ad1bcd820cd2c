"""Substring dedup by repeated-phrase automata.

A window is so many consecutive words of one document. A word goes if a window that covers it also starts in a document with a
smaller id. The steps:

1. Every window has an anchor, its phrase of `PHRASE` words with the least hash. Neighbouring windows share anchors,
   so that about one word in twenty starts one. Only anchors that two documents have can lie in a repeated window.
2. The windows of such anchors are hashed, and each hash keeps its smallest document and place. Hashes with two documents
   confirm recurring passages: runs of such windows in the document that owns them.
3. The phrases of the passages' anchors are the patterns, each with the words of the passage's windows around it. Patterns are dealt
   to shards by phrase, and each shard compiles an Aho-Corasick automaton over numbered words. Of a phrase in very many passages, the
   `KEY_PASSAGES` with the smallest documents are searched first; so shards are bounded in passages.
4. All documents that hold a pattern's anchor are streamed, as segments of the words around it, past the automaton of
   the anchor's shard, which tells the places of phrases in them. Each occurrence found is compared word by word with the passage, to both sides; a common run of a window's length
   covers its words. Segments of the passages' first documents have nothing to find and are passed over, and what was found for equal words
   is remembered within a phrase. Shards with many segments are copied, so that a frequent passage is many tasks.
5. Windows that none of these covered, around phrases with further passages, are streamed past automata in which every such window is a pattern of its own. Each has one
   owner, and they are dealt by all their words, so that these shards are bounded however many passages share a phrase.

Documents with equal word sequences are settled beforehand: all but those with the smallest id lose every word if they
have a window, and only the first is searched. Words are split at ASCII white space and compared as they
are. Null and empty texts have no words. Rows without an id keep all words and take none from others; rows that share an id
do not take words from each other, and repeated rows give repeated results. An empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.tables import written

WINDOW, PHRASE = 50, 10
#: Words on either side of an anchor's phrase that its windows can reach.
SIDE = WINDOW - PHRASE
#: Anchors and passages in a shard's automaton on average, and segments that one copy of it searches.
SHARD_ANCHORS, SHARD_PASSAGES, COPY_SEGMENTS = 2048, 4096, 8192
#: Passages around one phrase that are searched first.
KEY_PASSAGES = 16
#: Documents up to which candidate numbers are broadcast, 8 bytes each.
BROADCAST_IDS = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _hashes(own: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word. Texts of a corpus have too many words for remembering their hashes to pay."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, own)), dtype=np.uint64)


def _rolling(hashed: np.ndarray, width: int, base: int) -> np.ndarray:
    """A 64-bit hash of every run of `width` words."""
    n = len(hashed)
    powers = np.cumprod(np.full(n, base, dtype=np.uint64), dtype=np.uint64)
    back = np.cumprod(np.full(n - width + 1, pow(base, -1, 1 << 64), dtype=np.uint64), dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * powers, dtype=np.uint64)])
    x = (total[width:] - total[:-width]) * back
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of every window's anchor, and the hashes of all phrases; for documents that have a window."""
    phrases = _rolling(hashed, PHRASE, _BASES[0])
    span = WINDOW - PHRASE + 1
    at = np.empty(len(phrases) - span + 1, dtype=np.int64)
    for start in range(0, len(at), 1 << 16):
        part = np.lib.stride_tricks.sliding_window_view(phrases[start : start + (1 << 16) + span - 1], span)
        at[start : start + len(part)] = np.argmin(part, axis=1) + np.arange(start, start + len(part))
    return at, phrases


def _unit(own: list[bytes]) -> tuple[int, bytes]:
    """A number that tells word sequences apart, and the sequence as text."""
    text = b" ".join(own)
    return xxhash.xxh3_64_intdigest(text) - (1 << 63), text


def _scanned(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, n_words, unit, all_sha256, anchors) of every document; anchors only where it has a window."""

    def make():
        def scan(values: list[bytes]) -> dict:
            made = {"n_words": [], "unit": [], "all_sha256": [], "anchors": []}
            for value in values:
                own = value.split()
                unit, joined = _unit(own)
                made["n_words"].append(len(own))
                made["unit"].append(unit)
                made["all_sha256"].append(hashlib.sha256(joined).hexdigest())
                found = np.zeros(0, np.int64)
                if len(own) >= WINDOW:
                    at, phrases = anchors(_hashes(own))
                    found = np.unique(phrases[at[np.diff(at, prepend=-1) > 0]]).view(np.int64)
                made["anchors"].append(found)
            return made

        return scan

    return arrow.per_text(docs, "n_words long, unit long, all_sha256 string, anchors array<long>", make, [doc_id], text).withColumnRenamed(doc_id, "doc")


def _with_texts(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, unit, anchors, words): the word sequences of the wanted (doc, unit), joined by spaces."""
    ids = wanted.select(F.col("doc").alias(doc_id)).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def make():
        def joined(values: list[bytes]) -> dict:
            made = [_unit(value.split()) for value in values]
            return {"unit": [unit for unit, _ in made], "words": [words for _, words in made]}

        return joined

    texts = arrow.per_text(docs.select(doc_id, text).join(ids, doc_id, "left_semi"), "unit long, words binary", make, [doc_id], text)
    return texts.withColumnRenamed(doc_id, "doc").dropDuplicates(["doc", "unit"]).join(wanted, ["doc", "unit"])


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def _windows(batches, schema: pa.Schema):
    """(first, second, doc, unit, place): hashes of the windows whose anchor is wanted."""
    for part in arrow.slices(batches, "words"):
        for doc, unit, wanted, text in zip(*(part.column(name).to_pylist() for name in ("doc", "unit", "anchors", "words"))):
            hashed = _hashes(text.split())
            at, phrases = anchors(hashed)
            places = np.flatnonzero(np.isin(phrases[at].view(np.int64), np.asarray(wanted, dtype=np.int64)))
            if len(places):
                first, second = (_rolling(hashed, WINDOW, base)[places].view(np.int64) for base in _BASES)
                same = np.full(len(places), doc, dtype=np.int64), np.full(len(places), unit, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (first, second, *same, places.astype(np.int32))], schema=schema)


#: Patterns and segments: words from word number `base` of the document, the anchor's phrase at `place` among them; all windows in them have that anchor.
#: Patterns have neither unit nor base. The key deals them: the phrase's hash, or that of the whole window.
_CUT = "key long, doc long, unit long, words binary, base int, place int"
#: What was found: covered words have neither key nor words; windows left over are rows of `_CUT` besides.
_FOUND = "doc long, unit long, start int, end int, key long, words binary, place int"


def _offsets(text: bytes) -> np.ndarray:
    """Where the words of a text with single spaces begin, and where one after the last would."""
    return np.concatenate([[0], np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1, [len(text) + 1]])


def _window_key(words: bytes, place: int) -> int:
    return xxhash.xxh3_64_intdigest(words, seed=place) - (1 << 63)


def _by_anchor(at: np.ndarray, windows: np.ndarray):
    """(place, first, last) of the anchors of neighbouring windows, and at which places their windows have them."""
    of = at[windows]
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(of)]):
        place = int(of[start])
        yield place, place - int(windows[end - 1]), place - int(windows[start])


def _around(text: bytes, at: np.ndarray, windows: np.ndarray):
    """(place, base, words, place in the words) for the anchors of some windows, given in order."""
    offsets = _offsets(text)
    for run in np.split(windows, np.flatnonzero(np.diff(windows) > 1) + 1) if len(windows) else []:
        for place, first, last in _by_anchor(at, run):
            base = place - last
            yield place, base, text[offsets[base] : offsets[place - first + WINDOW] - 1], last


def _patterns(batches, schema: pa.Schema):
    """Passages around the anchors of their windows."""
    for part in arrow.slices(batches, "words"):
        rows = []
        for doc, places, text in zip(*(part.column(name).to_pylist() for name in ("doc", "places", "words"))):
            at, phrases = anchors(_hashes(text.split()))
            hashed = phrases.view(np.int64)
            rows += {(int(hashed[at_word]), doc, None, words, None, place) for at_word, _, words, place in _around(text, at, np.unique(np.asarray(places)))}
        yield _rows(schema, rows)


def _segments(batches, schema: pa.Schema):
    """The words around each wanted anchor of a document."""
    for part in arrow.slices(batches, "words"):
        rows = []
        for doc, unit, wanted, text in zip(*(part.column(name).to_pylist() for name in ("doc", "unit", "anchors", "words"))):
            at, phrases = anchors(_hashes(text.split()))
            hashed = phrases.view(np.int64)
            keep = np.flatnonzero(np.isin(hashed[at], np.asarray(wanted, dtype=np.int64)))
            rows += [(int(hashed[at_word]), doc, unit, words, base, place) for at_word, base, words, place in _around(text, at, keep)]
        if rows:
            yield _rows(schema, rows)


def _single(batches, schema: pa.Schema):
    """Patterns of one window each."""
    for part in arrow.slices(batches, "words"):
        rows = []
        for doc, text, place in zip(*(part.column(name).to_pylist() for name in ("doc", "words", "place"))):
            offsets = _offsets(text)
            for start in range(len(offsets) - WINDOW):
                words = text[offsets[start] : offsets[start + WINDOW] - 1]
                rows.append((_window_key(words, place - start), doc, None, words, None, place - start))
        yield _rows(schema, rows)


class Shard:
    """An automaton for the phrases of some anchors, with the passages that hold them.

    Words are spelled as a few symbols of 64 each, from an alphabet per place, so that the automaton's nodes have few
    children and no match begins or ends within a word. Passages are found by the words that all windows with the phrase at
    `low` to `high` have in common: the phrase itself, or the window where the two are one.
    """

    def __init__(self, patterns: list[tuple[int, bytes, int, int, int]]):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        self.passages = []
        self.by_key: dict[tuple, list[int]] = {}
        for number, (owner, words, at, low, high) in enumerate(patterns):
            passage = words.split()
            self.passages.append((owner, passage, at))
            self.by_key.setdefault(self._key(passage, at, low, high), []).append(number)
            for word in passage[at : at + PHRASE]:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        self.width = 1
        while 64**self.width <= len(self.numbers):
            self.width += 1
        self.spelled = {word: self._spell(number) for word, number in self.numbers.items()}
        self.unknown = self._spell(0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for _, passage, at in self.passages:
            self.automaton.add_word("".join(map(self.spelled.__getitem__, passage[at : at + PHRASE])))
        if self.passages:
            self.automaton.make_automaton()

    def _spell(self, number: int) -> str:
        return "".join(chr(0x100 + 64 * place + (number >> 6 * place) % 64) for place in range(self.width))

    @staticmethod
    def _key(words: list[bytes], at: int, low: int, high: int) -> tuple:
        """What the windows with the phrase at `low` to `high` have in common; none if the words do not reach so far."""
        start, end = at - low, at + WINDOW - high
        return (low, high, b" ".join(words[start:end])) if start >= 0 and end <= len(words) else ()

    def occurrences(self, words: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """(owner, start, end) of common runs with passages, by owner, as far as the words are not covered yet.

        The automaton finds the places of the phrases in the whole segment; `low` and `high` are the segment's range.
        """
        own = words.split()
        found: list[tuple[int, int, int]] = []
        if not self.passages or len(own) < WINDOW:
            return found
        spelled = "".join([self.spelled.get(word, self.unknown) for word in own])
        places = []
        for last, _ in self.automaton.iter(spelled):
            begin = (last + 1) // self.width - PHRASE
            places += [(self.passages[number][0], number, begin) for number in self.by_key.get(self._key(own, begin, low, high), ())]
        for owner, number, begin in sorted(places):
            _, passage, offset = self.passages[number]
            left, right = min(begin, offset), min(len(own) - begin, len(passage) - offset)
            if own[begin - left : begin] != passage[offset - left : offset]:
                left = next(n for n in range(left) if own[begin - n - 1] != passage[offset - n - 1])
            if own[begin : begin + right] != passage[offset : offset + right]:
                right = next(n for n in range(right) if own[begin + n] != passage[offset + n])
            if left + right >= WINDOW:
                found.append((owner, begin - left, begin + right))
                if left + right == len(own):
                    break
        return found

    def covered(self, doc: int, words: bytes, low: int, high: int) -> list[tuple[int, int]]:
        """Word ranges that windows of other owners' passages cover, owners with smaller ids only."""
        return _united([(start, end) for owner, start, end in self.occurrences(words, low, high) if owner < doc])


def _united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    united: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if united and start <= united[-1][1]:
            united[-1] = united[-1][0], max(united[-1][1], end)
        else:
            united.append((start, end))
    return united


def _left_over(words: bytes, place: int, ranges: list[tuple[int, int]]):
    """(start, key, words, place) of the windows that reach beyond the covered ranges."""
    offsets = _offsets(words)
    for start in range(len(offsets) - WINDOW):
        if not any(low <= start and start + WINDOW <= high for low, high in ranges):
            window = words[offsets[start] : offsets[start + WINDOW] - 1]
            yield start, _window_key(window, place - start), window, place - start


def _searched(batches, schema: pa.Schema, windows: bool = False):
    """Covered word ranges, and windows left over; rows come sorted by shard, copy, kind and key, patterns before segments.

    Patterns have no unit; their `place` is the anchor's in their words, and they have no `base`. They say whether their key has more passages.
    With `windows`, each row is one window.
    """
    of_shard, shard, patterns, least, more = None, None, [], {}, set()
    of_key, found = None, {}
    for batch in batches:
        rows = []
        for number, copy, key, doc, unit, words, base, place, crowded in zip(
            *(batch.column(name).to_pylist() for name in ("shard", "copy", "key", "doc", "unit", "words", "base", "place", "more"))
        ):
            if (number, copy) != of_shard:
                of_shard, shard, patterns, least, more, of_key = (number, copy), None, [], {}, set(), None
            if unit is None:
                patterns.append((doc, words, place, place, place) if windows else (doc, words, place, 0, SIDE))
                least[key] = min(doc, least.get(key, doc))
                if crowded:
                    more.add(key)
                continue
            if least.get(key, doc) >= doc:
                continue
            if shard is None:
                shard = Shard(patterns)
                patterns = []
            if key != of_key:
                of_key, found = key, {}
            if (words, place) not in found:
                found[words, place] = shard.occurrences(words, place if windows else 0, place if windows else SIDE)
            ranges = _united([(start, end) for owner, start, end in found[words, place] if owner < doc])
            rows += [(doc, unit, base + start, base + end, None, None, None) for start, end in ranges]
            if key in more:
                rows += [(doc, unit, base + start, base + start + WINDOW, *rest) for start, *rest in _left_over(words, place, ranges)]
        if rows:
            yield _rows(schema, rows)


def _kept(batches, schema: pa.Schema):
    """(doc, unit, n_removed, kept_sha256, kept) of documents with covered ranges."""
    for part in arrow.slices(batches, "words"):
        rows = []
        for doc, unit, ranges, text in zip(*(part.column(name).to_pylist() for name in ("doc", "unit", "ranges", "words"))):
            own = text.split()
            left, removed, at = [], 0, 0
            for start, end in _united([(x["start"], x["end"]) for x in ranges]):
                left += own[at:start]
                removed += end - start
                at = end
            kept = b" ".join([*left, *own[at:]])
            rows.append((doc, unit, removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
        yield _rows(schema, rows)


def _mapped(df: DataFrame, of_batches, ddl: str) -> DataFrame:
    return df.mapInArrow(partial(of_batches, schema=arrow.arrow_schema(ddl)), ddl)


def _streamed(patterns: DataFrame, segments: DataFrame, searched) -> DataFrame:
    """What is found where segments are streamed past the automata of patterns (`_CUT`, more)."""
    keys, passages = patterns.agg(F.count_distinct("key"), F.count("*")).first()
    shards = max(-(-keys // SHARD_ANCHORS), -(-passages // SHARD_PASSAGES), 1)
    shard = F.pmod(F.col("key"), F.lit(shards))
    patterns, segments = patterns.withColumn("shard", shard), segments.withColumn("shard", shard).withColumn("more", F.lit(None).cast("boolean"))
    copies = written(segments.groupBy("shard").agg(F.ceil(F.count("*") / COPY_SEGMENTS).cast("int").alias("copies")), "copies")
    tasks = (copies.agg(F.sum("copies")).first()[0] or 0) + 1
    columns = ["shard", "copy", "key", "doc", "unit", "words", "base", "place", "more"]
    copied = patterns.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = segments.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("doc", "unit", "base"), F.col("copies")).cast("int"))
    together = copied.select(*columns).unionByName(dealt.select(*columns))
    together = together.repartition(2 * tasks, "shard", "copy").sortWithinPartitions("shard", "copy", F.col("unit").isNotNull(), "key")
    return written(_mapped(together, searched, _FOUND), "found")


def _covered(patterns: DataFrame, segments: DataFrame) -> DataFrame:
    """(doc, unit, start, end): word ranges that passages of smaller documents cover."""
    crowded = written(patterns.groupBy("key").count().where(F.col("count") > KEY_PASSAGES).select("key"), "crowded")
    if not (n := crowded.count()):
        return _streamed(patterns.withColumn("more", F.lit(False)), segments, _searched).select("doc", "unit", "start", "end")
    keys = F.broadcast(crowded) if n <= BROADCAST_IDS else crowded
    shared = written(patterns.join(keys, "key", "left_semi").select(*patterns.columns), "shared-patterns")
    ranked = shared.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("doc", "words", "place")))
    least = ranked.where(F.col("rank") <= KEY_PASSAGES).drop("rank").withColumn("more", F.lit(True))
    others = patterns.join(keys, "key", "left_anti").select(*patterns.columns).withColumn("more", F.lit(False))
    found = _streamed(written(others.unionByName(least), "first-patterns"), segments, _searched)
    single = written(_mapped(shared, _single, _CUT).withColumn("more", F.lit(False)), "window-patterns")
    left_over = found.where("words is not null").select("key", "doc", "unit", "words", F.col("start").alias("base"), "place")
    further = _streamed(single, left_over, partial(_searched, windows=True))
    return found.where("words is null").unionByName(further).select("doc", "unit", "start", "end")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, n_words, n_removed, kept_sha256 and, where words went, the kept text."""
    scanned = written(_scanned(docs, doc_id, text), "scanned")
    firsts = scanned.where("doc is not null").groupBy("unit", "all_sha256").agg(F.min("doc").alias("first_doc"), F.any_value("anchors").alias("anchors"))
    searched = written(firsts.where(F.size("anchors") > 0).select(F.col("first_doc").alias("doc"), "unit", "anchors"), "firsts")
    exploded = searched.select("doc", "unit", F.explode("anchors").alias("anchor"))
    repeated = exploded.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("anchor")
    wanted = exploded.join(repeated, "anchor").groupBy("doc", "unit").agg(F.collect_list("anchor").alias("anchors"))
    texts = written(_with_texts(docs, written(wanted, "anchored"), doc_id, text), "anchored-texts")

    windows = _mapped(texts, _windows, "first long, second long, doc long, unit long, place int")
    owned = windows.groupBy("first", "second").agg(F.min(F.struct("doc", "unit", "place")).alias("owner"), F.max("doc").alias("last_doc")).where("owner.doc < last_doc")
    passages = owned.groupBy("owner.doc", "owner.unit").agg(F.collect_list("owner.place").alias("places"))
    in_passages = texts.select("doc", "unit", "words").join(passages, ["doc", "unit"]).select("doc", "places", "words")
    # A window is owned once, so that no two of them are alike.
    patterns = written(_mapped(in_passages, _patterns, _CUT), "patterns")

    owned_anchors = patterns.select(F.col("key").alias("anchor")).distinct()
    confirmed = texts.select("doc", "unit", F.explode("anchors").alias("anchor")).join(owned_anchors, "anchor")
    of_unit = confirmed.groupBy("doc", "unit").agg(F.collect_list("anchor").alias("anchors"))
    confirmed_texts = texts.select("doc", "unit", "words").join(of_unit, ["doc", "unit"]).select("doc", "unit", "anchors", "words")
    segments = written(_mapped(confirmed_texts, _segments, _CUT), "segments")
    covered = _covered(patterns, segments).distinct()
    ranges = covered.groupBy("doc", "unit").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    kept = _mapped(
        texts.select("doc", "unit", "words").join(ranges, ["doc", "unit"]), _kept, "doc long, unit long, n_removed long, kept_sha256 string, kept string"
    )

    first_of = firsts.select("unit", "all_sha256", "first_doc")
    told = scanned.select("doc", "n_words", "unit", "all_sha256").join(first_of, ["unit", "all_sha256"], "left").join(kept, ["doc", "unit"], "left")
    copy = F.coalesce((F.col("doc") > F.col("first_doc")) & (F.col("n_words") >= WINDOW), F.lit(False))
    return told.select(
        F.col("doc").alias(doc_id), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
