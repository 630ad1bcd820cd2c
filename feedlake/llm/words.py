"""Hashes of words, remembered per worker."""

from __future__ import annotations

import numpy as np
import xxhash

from feedlake.llm.arrow import remembered

#: Words whose hash a worker remembers.
REMEMBERED = 1 << 18
_known: dict[bytes, bytes] = remembered("bbit_minhash", "word_runs")


def hashes(own: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    try:
        return np.frombuffer(b"".join(map(_known.__getitem__, own)), dtype=np.uint64)
    except KeyError:
        if len(_known) > REMEMBERED:
            _known.clear()
        for word in own:
            if word not in _known:
                _known[word] = xxhash.xxh3_64_digest(word)
        return np.frombuffer(b"".join(map(_known.__getitem__, own)), dtype=np.uint64)
