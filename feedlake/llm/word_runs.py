"""Periodic runs of words, found by uniting suffix classes in the order of decreasing common prefixes.

A run is a stretch of words with smallest period q that no neighbouring word extends and that is at least three periods and `LEAST`
words long. The suffixes at its start and one period later agree on length - q words, at least 2q and `SHARED`. So:

1. Runs of `SHARED` words that recur in a document are looked for by hashes; a document without any has no run and is done.
2. Others get a suffix array by prefix doubling, whose ranks also tell the common prefixes of neighbouring suffixes.
3. Kruskal: neighbours are united by decreasing common prefix, down to `SHARED`. A class is an ordered list of positions, and the
   smaller list is put into the larger one. Positions that become neighbours in the united list at a distance of at most
   half their common prefix are a seed: their distance is a period. A smaller period would have put a position between them, as
   by the theorem of Fine and Wilf it divides theirs. A seed whose left neighbours differ is the start of a run, which
   ends where the common prefix does; every run has exactly one.

A document is one row and is searched as a whole; n words take n log² n steps. There is no shuffle: documents share nothing. Words are split at ASCII white space and compared
as they are. Null and empty texts have no words and no runs. Repeated rows give repeated results, an empty table an empty one; columns that
are not kept are not looked at, and kept ones may not be named like the results.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame

from feedlake.llm import arrow
from feedlake.llm import words as words_of
from feedlake.llm.phrase_automata import _BASES, _rolling

#: Least words of a run, and least periods.
LEAST, PERIODS = 24, 3
#: Words that the suffixes at a run's start and one period later share at least: LEAST - q or 2q, whichever is more.
SHARED = 16


def suffix_ranks(numbers: np.ndarray) -> list[np.ndarray]:
    """Ranks of the runs of 1, 2, 4, … words at every position, until all differ; runs past the end are cut."""
    n = len(numbers)
    ranks = [np.unique(numbers, return_inverse=True)[1].astype(np.int64)]
    width = 1
    while width < n and ranks[-1].max() < n - 1:
        after = np.zeros(n, dtype=np.int64)
        after[:-width] = ranks[-1][width:] + 1
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
        width *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Words that the suffixes at `left` and `right`, pairs of different positions, have in common."""
    n = len(ranks[0])
    left, right, total = left.copy(), right.copy(), np.zeros(len(left), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = inside & (ranks[level][np.minimum(left, n - 1)] == ranks[level][np.minimum(right, n - 1)])
        step = same * (1 << level)
        left, right, total = left + step, right + step, total + step
    return total


def seeds(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(position, distance, common prefix) where the prefix is at least twice the distance, of newly adjacent positions."""
    ranks = suffix_ranks(numbers)
    order = np.argsort(ranks[-1], kind="stable")
    shared = common_prefixes(ranks, order[:-1], order[1:])
    edges = np.flatnonzero(shared >= SHARED)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        top = x
        while (above := root.get(top, top)) != top:
            top = above
        while (above := root.get(x, x)) != top:
            root[x], x = top, above
        return top

    found = []
    for a, b, prefix in zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist()):
        a, b = find(a), find(b)
        small, large = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        for place, x in enumerate(small):
            at = bisect_left(large, x)
            if at and (not place or small[place - 1] < large[at - 1]) and 2 * (x - large[at - 1]) <= prefix:
                found.append((large[at - 1], x - large[at - 1], prefix))
            if at < len(large) and (place + 1 == len(small) or small[place + 1] > large[at]) and 2 * (large[at] - x) <= prefix:
                found.append((x, large[at] - x, prefix))
        if 16 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)
        root[a] = b
        members[b] = large
    return found


def runs(own: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word sequence, by start and period."""
    if len(own) < LEAST:
        return []
    recurring = _rolling(words_of.hashes(own), SHARED, _BASES[0])
    if len(np.unique(recurring)) == len(recurring):
        return []
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(word, len(known)) for word in own])
    made = set()
    for start, period, prefix in seeds(numbers):
        if prefix + period >= LEAST and (start == 0 or numbers[start - 1] != numbers[start + period - 1]):
            made.add((start, prefix + period, period))
    return sorted(made, key=lambda run: (run[0], run[2]))


def collapsed(own: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in found):
        if start > at:
            kept += own[at:start]
        at = max(at, end)
    return kept + own[at:]


def greatest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods, exactly compared; of equal ones the first, then that with the shortest period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, collapsed binary, collapsed_sha256 string"


def collapse_runs(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, the number of words, all runs by start and period, the greatest one, and the text without repetitions.

    `collapsed` has the words joined by single spaces, and is null where the document has no run; `collapsed_sha256` is always told.
    """

    def make():
        def search(values: list[bytes]) -> dict:
            made: dict[str, list] = {"n_words": [], "runs": [], "best": [], "collapsed": [], "collapsed_sha256": []}
            for value in values:
                own = value.split()
                found = runs(own)
                left = b" ".join(collapsed(own, found) if found else own)
                named = [dict(zip(("start", "length", "period"), run)) for run in found]
                best = greatest(found)
                made["n_words"].append(len(own))
                made["runs"].append(named)
                made["best"].append(best and dict(zip(("start", "length", "period"), best)))
                made["collapsed"].append(left if found else None)
                made["collapsed_sha256"].append(hashlib.sha256(left).hexdigest())
            return made

        return search

    return arrow.per_text(docs, _FOUND, make, keep, text)
