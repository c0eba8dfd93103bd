"""Words of many texts at once, as 64-bit hashes in numpy.

A word is a run of letters, digits, underscores and non-ASCII characters; ASCII letters count as small.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

ROOT, STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_WORD = np.array([b >= 128 or b == 95 or chr(b).isalnum() for b in range(256)])
_SMALL = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(ROOT, -1, 1 << 64)
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, r, np.uint64))]) for r in (ROOT, inverse))


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words; where each text's words begin (and the last ends); each word's first and last-plus-one byte in its text."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    begins = np.cumsum(sizes + 1) - sizes  # a blank stands before every text
    b = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    edges = np.flatnonzero(np.diff(_WORD[b].view(np.int8))) + 1
    first, last = edges[::2], edges[1::2]
    power, inverse = _powers(1 << max(16, int(len(b)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_SMALL[b] * power[: len(b)])])
    hashes = mixed((sums[last] - sums[first]) * inverse[first])
    ends = np.concatenate([[0], np.searchsorted(first, begins + sizes, "left")]).astype(np.int64)
    of = np.repeat(begins, np.diff(ends))
    return hashes, ends, first - of, last - of


def runs(hashes: np.ndarray, ends: np.ndarray, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the texts they come from; with `short`, a text of fewer words is one run."""
    n = np.diff(ends)
    many = np.maximum(n - k + 1, (n > 0) if short else 0)
    text = np.repeat(np.arange(len(n)), many)
    start = np.repeat(ends[:-1] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    out = np.zeros(len(start), np.uint64)
    for i in range(k):
        at = start + i
        inside = at < ends[text + 1]
        out = (out + np.where(inside, hashes[np.minimum(at, max(0, len(hashes) - 1))], np.uint64(i))) * np.uint64(STEP) if len(hashes) else out
    return mixed(out), text
