"""Benchmark decontamination by Wu-Manber search over words.

A benchmark item gives all its windows of so many consecutive words; a shorter item is one window. Windows of one length
form a pattern set with three tables: for each block of two words, how far a search may move on when it meets the block
(the whole window when it knows it not); for a block that ends a window, the windows of that suffix, told
apart by their first block; and the windows' words, to which a candidate is compared directly.

Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. Null and empty texts have no
words and hit nothing; an item without words has no window. Items with equal ids count once, and a window of several
items counts for each. Documents are judged row by row, so that repeated rows give repeated results; an empty table
of either kind gives no rows or no hits. Other columns are not looked at.

The patterns are dealt to shards of bounded bytes. One shard is the usual case: documents are read once and nothing is
shuffled. With more, documents are read once per shard; a shard's hits are written and its patterns given back before the next is sent, so that
one shard at a time is held by the driver and the executors, and hits are put together by document.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import arrow
from feedlake.llm.tables import written

WINDOW = 10
#: Bytes of window words in a shard, which is sent to every executor.
SHARD_BYTES = 16 << 20

_SPACED = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20
    for byte in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_SPACED).split()


def windows_of(text: bytes, size: int) -> set[bytes]:
    """The windows of an item, their words joined by spaces."""
    own = words(text)
    if not own:
        return set()
    return {b" ".join(own[at : at + size]) for at in range(max(1, len(own) - size + 1))}


class PatternSet:
    """Shift, suffix and prefix tables over windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.shift: dict = {}
        self.suffixes: dict = {}
        self.patterns: list[tuple[tuple[int, ...], list[int]]] = []

    def add(self, window: tuple[int, ...], items: list[int]) -> None:
        last = self.length - 1
        for end in range(self.block - 1, self.length):
            block = window[end - self.block + 1 : end + 1]
            self.shift[block] = min(self.shift.get(block, self.length), last - end)
        by_prefix = self.suffixes.setdefault(window[-self.block :], {})
        by_prefix.setdefault(window[: self.block], []).append(len(self.patterns))
        self.patterns.append((window, items))

    def search(self, ids: list[int], covered: set[int], items: set[int]) -> None:
        """Add the positions of words within occurrences, and the items of their windows."""
        size, block, n = self.length, self.block, len(ids)
        shift, default, at = self.shift.get, self.length - self.block + 1, self.length - 1
        while at < n:
            move = shift(tuple(ids[at - block + 1 : at + 1]), default)
            if move:
                at += move
                continue
            start = at - size + 1
            for number in self.suffixes[tuple(ids[at - block + 1 : at + 1])].get(tuple(ids[start : start + block]), ()):
                window, of_items = self.patterns[number]
                if tuple(ids[start : at + 1]) == window:
                    covered.update(range(start, at + 1))
                    items.update(of_items)
            at += 1


class Matcher:
    """All pattern sets of a shard."""

    def __init__(self, windows: list[tuple[bytes, list[int]]]):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, PatternSet] = {}
        for window, items in windows:
            own = tuple(self.ids.setdefault(word, len(self.ids) + 1) for word in window.split(b" "))
            by_length.setdefault(len(own), PatternSet(len(own))).add(own, items)
        self.sets = list(by_length.values())

    def search(self, own: list[bytes]) -> tuple[set[int], set[int]]:
        known = self.ids.get
        ids = [known(word, 0) for word in own]
        covered: set[int] = set()
        items: set[int] = set()
        for patterns in self.sets:
            patterns.search(ids, covered, items)
        return covered, items


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, items): every window of the benchmark with the items that have it."""
    ddl = "window binary, item_id long"
    schema = arrow.arrow_schema(ddl)

    def cut(batches):
        for part in arrow.slices(batches, "text"):
            rows = [(window, item) for item, text in zip(part.column("item_id").to_pylist(), arrow.texts(part)) for window in windows_of(text, size)]
            yield pa.RecordBatch.from_arrays([pa.array([row[0] for row in rows], pa.binary()), pa.array([row[1] for row in rows], pa.int64())], schema=schema)

    cut_windows = arrow.mapped(items.select(F.col("item_id").cast("long"), "text"), cut, ddl)
    return cut_windows.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


_HITS = "n_words long, hit array<int>, items array<long>"


def _searched(docs: DataFrame, shared: Broadcast, keep: list[str], text: str) -> DataFrame:
    def make():
        matcher = Matcher(shared.value)

        def hits(values: list[bytes]) -> dict:
            made = {"n_words": [], "hit": [], "items": []}
            for value in values:
                own = words(value)
                covered, items = matcher.search(own)
                made["n_words"].append(len(own))
                made["hit"].append(sorted(covered))
                made["items"].append(sorted(items))
            return made

        return hits

    return arrow.per_text(docs, _HITS, make, keep, text)


def search(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", size: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The kept columns, n_words, `hit` (positions of words within occurrences) and `items` of those, for each document."""
    windows = written(item_windows(items, size), "windows")
    weight = F.length("window") + 16 * F.size("items") + 64
    total = windows.agg(F.sum(weight)).first()[0] or 0
    shards = -(-total // shard_bytes) or 1
    dealt = windows.withColumn("shard", F.pmod(F.xxhash64("window"), F.lit(shards)))

    def shared(number: int) -> Broadcast:
        rows = dealt.where(F.col("shard") == number).orderBy("window").select("window", "items").toArrow()
        return docs.sparkSession.sparkContext.broadcast(list(zip(rows["window"].to_pylist(), rows["items"].to_pylist())))

    if shards == 1:
        return _searched(docs, shared(0), keep, text)
    row = docs.select(*dict.fromkeys([*keep, text])).withColumn("_text_key", F.sha2(F.coalesce(text, F.lit("")), 256))
    keys = [*dict.fromkeys(keep), "_text_key"]
    found = None
    for number in range(shards):
        patterns = shared(number)
        part = written(_searched(row, patterns, keys, text).where(F.size("hit") > 0), "hits")
        patterns.destroy()
        found = part if found is None else found.unionByName(part)
    together = found.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = _searched(row, docs.sparkSession.sparkContext.broadcast([]), keys, text).select(*keys, "n_words")
    right = together.select(*[F.col(key).alias(f"_of_{key}") for key in keys], "hit", "items")
    same = [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys]
    joined = counted.join(right, same, "left")
    return joined.select(
        *keep, "n_words", F.coalesce("hit", F.array().cast("array<int>")).alias("hit"), F.coalesce("items", F.array().cast("array<long>")).alias("items")
    )
