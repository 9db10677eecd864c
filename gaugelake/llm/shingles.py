"""Sets of word n-grams as sorted 64-bit hashes, made with numpy for a batch of texts at a time."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20  # bytes hashed at once; a longer single word is taken whole

_U = np.uint64
_rng = np.random.default_rng(20240229)  # fixed seed: hashes must agree between tasks
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_JOIN = _U(0xD6E8FEB86659FD93)

_is_space = np.zeros(256, bool)
_is_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_BYTE_LOWER = _BYTE[_lower]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, CHUNK), _powers(_BASE_INVERSE, CHUNK)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _chunk_words(buf: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer that begins and ends at word boundaries."""
    up, down = (_UP, _DOWN) if len(buf) <= CHUNK else (_powers(_BASE, len(buf)), _powers(_BASE_INVERSE, len(buf)))
    word = ~between[buf]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_LOWER[buf] * up[: len(buf)], out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(data: bytes, between: np.ndarray = _is_space) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all words of ``data``, chunk by chunk, A-Z lower-cased; ``between`` marks the bytes that part words."""
    buf = np.frombuffer(data, np.uint8)
    starts, hashes, lo = [], [], 0
    while lo < len(buf):
        hi = min(lo + CHUNK, len(buf))
        if hi < len(buf):
            spaces = np.flatnonzero(between[buf[lo:hi]])
            if len(spaces):
                hi = lo + int(spaces[-1]) + 1
            else:  # a word longer than a chunk
                while hi < len(buf) and not between[buf[hi]]:
                    hi += 1
        s, h = _chunk_words(buf[lo:hi], between)
        starts.append(s + lo)
        hashes.append(h)
        lo = hi
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``words``-grams, A-Z lower-cased.

    A text of fewer words has one n-gram, its whole sequence; one without words (or null) has none.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    starts, hashes = hashed_words(b" ".join(raw))
    cuts = np.searchsorted(starts, ends)  # words of text i: cuts[i-1]:cuts[i]
    grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        grams = grams * _JOIN + hashes[j: j + len(grams)]
    grams = _mix(grams)
    out, lo = [], 0
    for hi in cuts.tolist():
        if hi - lo >= words:
            out.append(np.unique(grams[lo: hi - words + 1]))
        elif hi > lo:
            whole = _U(hi - lo)
            with np.errstate(over="ignore"):
                for h in hashes[lo:hi]:
                    whole = whole * _JOIN + h
            out.append(_mix(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        lo = hi
    return out
