"""64-bit hashes of words and of word shingles, computed over whole byte arrays at once."""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE_WORDS = 5
#: Non-blank bytes hashed at once; bounds the working memory for very long texts.
BLOCK = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (published constants): a bijection that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = stream(256, 11)
_PLACE = stream(1 << 12, 12) | _U(1)
_SHINGLE = stream(SHINGLE_WORDS, 13) | _U(1)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of UTF-8 bytes."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _IS_BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash a word. Equal words have equal hashes."""
    out = np.empty(len(starts), _U)
    raw, lengths = np.frombuffer(data, np.uint8), ends - starts
    total = np.cumsum(lengths)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")))
        size = lengths[at:to]
        if size.max() > len(_PLACE):
            for i in range(at, to):
                if lengths[i] > len(_PLACE):
                    digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
                    out[i] = int.from_bytes(digest, "little")
                else:
                    out[i] = _hash_run(raw[starts[i] : ends[i]], lengths[i : i + 1])[0]
        else:
            first = np.cumsum(size) - size
            place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            out[at:to] = _hash_run(raw[place + np.repeat(starts[at:to], size)], size, place, first)
        at = to
    return out


def _hash_run(
    values: np.ndarray, size: np.ndarray, place: np.ndarray | None = None, first: np.ndarray | None = None
) -> np.ndarray:
    if place is None:
        place, first = np.arange(len(values)), np.zeros(1, np.int64)
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(_BYTE[values] * _PLACE[place], first) + size.astype(_U))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles, in order; of all words together if there are fewer than five."""
    n = len(words)
    if n == 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        if n < SHINGLE_WORDS:
            return mix(np.array([(words * _SHINGLE[:n]).sum(dtype=_U) + _U(n)], _U))
        out = words[: n - SHINGLE_WORDS + 1] * _SHINGLE[0]
        for k in range(1, SHINGLE_WORDS):
            out += words[k : n - SHINGLE_WORDS + 1 + k] * _SHINGLE[k]
        return mix(out)
