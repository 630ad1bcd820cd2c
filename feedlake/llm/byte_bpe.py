"""Byte-level BPE encoding and decoding over whole texts.

A text is split by the tokenizer's pattern; each pre-token is merged on its own. The pre-tokens that a slice of texts brings
are merged together: their symbols form one linked list with gaps between pre-tokens, and possible merges wait in buckets by rank.
A hierarchical bitmap over the ranks finds the lowest rank in use with one find-first-set on each of its two levels; all positions of
its bucket are merged next, from the left. Pre-tokens do not touch, so the lowest rank of all is also the lowest of each that has it.
Entries whose pair has changed meanwhile are stale and skipped. Where a merge would open one of a lower rank, only the
leftmost position of each pre-token is merged and the others wait. The work for n bytes is n log n
at most, so that a text without any space is no harder than others. Short pre-tokens are remembered per worker, in two generations: when
the younger has its share it becomes the older, and what is met again moves to the younger.

Null and empty texts have no ids and decode to nothing. Rows are mapped one by one: repeated rows give repeated
results, an empty table an empty one, and further columns are not looked at.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType
from public_tokenizers import PATTERN

from feedlake.llm import arrow

#: Pre-tokens up to so many code points are remembered, so many of them per worker.
CACHED_CHARS, CACHED_TOKENS = 48, 1 << 18
#: Rows and bytes of text whose pre-tokens are merged together.
TOGETHER_ROWS, TOGETHER_BYTES = 10_000, 4 << 20
#: Rank of a pair that cannot be merged.
NEVER = 1 << 31


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a tokenizer file of lines with base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class RankQueue:
    """Buckets of positions by rank, and a two-level bitmap of the ranks in use.

    `words` holds one bit per rank, and `top` one bit per word that is not zero. The queue is empty between
    batches, so that one is enough for a worker.
    """

    def __init__(self, n_ranks: int):
        self.shift = -(-max(1, n_ranks - 1).bit_length() // 2)
        self.mask = (1 << self.shift) - 1
        self.words = [0] * ((n_ranks >> self.shift) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, ranks: list[int], positions: list[int]) -> None:
        buckets, words, shift, mask = self.buckets, self.words, self.shift, self.mask
        for rank, position in zip(ranks, positions):
            if rank in buckets:
                buckets[rank].append(position)
            else:
                buckets[rank] = [position]
                words[rank >> shift] |= 1 << (rank & mask)
                self.top |= 1 << (rank >> shift)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank in use and its bucket."""
        index = (self.top & -self.top).bit_length() - 1
        word = self.words[index]
        rank = index << self.shift | (word & -word).bit_length() - 1
        self.words[index] = word & (word - 1)
        if not self.words[index]:
            self.top &= self.top - 1
        return rank, self.buckets.pop(rank)


class Encoder:
    """Encodes and decodes with one file of ranks."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.queue = RankQueue(max(self.ranks.values(), default=0) + 1)
        self.pieces = regex.compile(PATTERN)
        self.of_byte = np.array([self.ranks.get(bytes([byte]), -1) for byte in range(256)], dtype=np.int64)
        # Every pair of tokens that together are a token, as one sorted number, and the rank of the whole.
        get = self.ranks.get
        pairs = [
            (left << 32 | right, rank)
            for token, rank in self.ranks.items()
            for at in range(1, len(token))
            if (left := get(token[:at])) is not None and (right := get(token[at:])) is not None
        ]
        pairs.sort()
        self.pairs = np.array([pair for pair, _ in pairs] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs] + [NEVER], dtype=np.int64)
        tokens: list[bytes | None] = [None] * (max(self.ranks.values(), default=0) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.cache: dict[str, bytes] = arrow.remembered("byte_bpe")
        self.older: dict[str, bytes] = arrow.remembered("byte_bpe")

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NEVER)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as the bytes of 32-bit integers."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), sizes)
        whole = np.array([self.ranks.get(one, -1) for one in pieces])
        # Position n stands for no neighbour: its symbol pairs with none.
        symbols = np.append(symbols, -1)
        following, previous = np.arange(1, n + 2), np.arange(-1, n)
        following[ends - 1] = n
        previous[ends - sizes] = n
        waits = np.full(n + 1, NEVER)
        alive = np.ones(n, dtype=bool)
        starts = np.arange(n)
        waits[:n] = np.where((following[:n] < n) & (whole[piece] < 0), self._rank_of(symbols[starts], symbols[following[:n]]), NEVER)
        queue = self.queue
        first = np.flatnonzero(waits < NEVER)
        queue.push(waits[first].tolist(), first.tolist())
        while queue.top:
            rank, bucket = queue.pop()
            at = np.sort(np.array(bucket))
            at = at[(waits[at] == rank) & np.concatenate([[True], at[1:] != at[:-1]])]
            if not len(at):
                continue
            # Of pairs that overlap, every second one is merged, from the left.
            overlaps = np.concatenate([[False], at[1:] == following[at[:-1]]])
            if overlaps.any():
                places = np.arange(len(at))
                run = np.maximum.accumulate(np.where(overlaps, 0, places))
                at = at[(places - run) % 2 == 0]
            gone = following[at]
            after = following[gone]
            if len(at) > 1:
                # What merges can open: with the symbols beside them, as these are or merged as well.
                own = np.full(len(at), rank)
                opens = self._rank_of(np.concatenate([own, symbols[previous[at]], [rank]]), np.concatenate([symbols[after], own, [rank]]))
                if opens.min() < rank:
                    leftmost = np.concatenate([[True], piece[at[1:]] != piece[at[:-1]]])
                    wait = at[~leftmost].tolist()
                    queue.push([rank] * len(wait), wait)
                    at, gone, after = at[leftmost], gone[leftmost], after[leftmost]
            symbols[at] = rank
            alive[gone] = False
            waits[gone] = waits[at] = NEVER
            following[at] = after
            linked = after < n
            previous[after[linked]] = at[linked]
            # The pair that begins here, and the one that ends here, if its left side was not merged too.
            left = np.concatenate([at, previous[at]])
            left = left[following[left] < n] if len(left) else left
            made = self._rank_of(symbols[left], symbols[following[left]])
            waits[left] = made
            opened = made < NEVER
            queue.push(made[opened].tolist(), left[opened].tolist())
        kept = np.flatnonzero(alive)
        ids = symbols[kept].astype(np.int32)
        cuts = np.searchsorted(kept, np.concatenate([[0], ends])).tolist()
        return [ids[start:end].tobytes() if of < 0 else np.int32(of).tobytes() for of, start, end in zip(whole.tolist(), cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as the bytes of 32-bit integers."""
        share = {}.setdefault  # a pre-token that recurs is held once, not as often as it occurs
        pieces = [list(map(share, found, found)) for found in map(self.pieces.findall, texts)]
        unseen = set().union(*pieces).difference(self.cache)
        known = {piece: ids for piece in unseen if (ids := self.older.get(piece)) is not None}
        new = [piece for piece in unseen if piece not in known]
        self.cache.update(known)
        self.cache.update(zip(new, self.merge([piece.encode() for piece in new])))
        made = [b"".join(map(self.cache.__getitem__, own)) for own in pieces]
        for piece in new:
            if len(piece) > CACHED_CHARS:
                del self.cache[piece]
        if len(self.cache) >= CACHED_TOKENS // 2:
            self.older.clear()
            self.cache, self.older = self.older, self.cache
        return made

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that each list of ids stands for; null decodes to nothing."""
        offsets = ids.offsets.to_numpy().astype(np.int64)
        spelled = self.tokens.take(ids.values[offsets[0] : offsets[-1]])
        starts, data = (np.frombuffer(buffer, dtype=kind) for buffer, kind in zip(spelled.buffers()[1:], (np.int64, np.uint8)))
        if not len(spelled):
            return pa.array([b""] * len(ids), pa.large_binary())
        cuts = starts[spelled.offset :][offsets - offsets[0]]
        lengths = np.diff(cuts) * ids.is_valid().to_numpy(zero_copy_only=False)
        if ids.null_count:
            data = np.concatenate([data[start : start + length] for start, length in zip(cuts.tolist(), lengths.tolist())])
            cuts = np.concatenate([[0], np.cumsum(lengths)])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(data)])

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _listed(made: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(ids) // 4 for ids in made)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), dtype=np.int32)))


def encode(docs: DataFrame, ranks_path: str, keep: list[str], text: str = "text", decoded: bool = False) -> DataFrame:
    """The kept columns and `ids`, the token ids of the whole text.

    With `decoded`, also the bytes that the ids stand for, by the same worker, so that ids need not come back to be decoded.
    """

    def make():
        own = encoder(ranks_path)

        def ids_of(values: list[bytes]) -> dict:
            ids = _listed(own.encode_all([value.decode() for value in values]))
            return {"ids": ids, "decoded": own.decode_all(ids)} if decoded else {"ids": ids}

        return ids_of

    ddl = "ids array<int>, decoded binary" if decoded else "ids array<int>"
    return arrow.per_text(docs, ddl, make, keep, text, TOGETHER_ROWS, TOGETHER_BYTES)


def decode(encoded: DataFrame, ranks_path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The kept columns and `decoded`, the bytes that the ids stand for; null ids decode to nothing."""
    kept = encoded.select(*keep).schema
    schema = StructType([*kept.fields, StructField("decoded", BinaryType())])

    def run(batches):
        own = encoder(ranks_path)
        shape = arrow.to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, arrow.SLICE_ROWS):
                part = batch.slice(start, arrow.SLICE_ROWS)
                columns = [part.column(name).cast(shape.field(name).type) for name in kept.names]
                made = own.decode_all(part.column(ids).cast(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*columns, made.cast(pa.binary())], schema=shape)

    return arrow.mapped(encoded.select(*dict.fromkeys([*keep, ids])), run, schema)
