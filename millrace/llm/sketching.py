"""Word shingles and fast similarity sketches, in numpy, for use inside tasks.

Words are hashed in 64 bits, so two different shingles are taken for one with a chance of
2^-64 per pair.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SHIFT, _MIX_A, _MIX_B = U64(33), U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> _SHIFT)
    x *= _MIX_A
    x ^= x >> _SHIFT
    x *= _MIX_B
    x ^= x >> _SHIFT
    return x


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=64)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: str | None) -> np.ndarray:
    """A hash per word: runs without space and \\x09-\\x0D, A-Z in lower case, in order."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=U64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    size = 1 << max(10, (len(data)).bit_length())
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_byte_codes()[data] * _powers(_BASE, size)[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * _powers(_BASE_INVERSE, size)[start] + (end - start).astype(U64))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The distinct shingles of ``width`` words, as sorted hashes.

    A text with fewer words has its whole word sequence as its one shingle, one without
    words has none.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    width_here = min(width, len(words))
    n = len(words) - width_here + 1
    factors = _seeds(width)
    out = words[:n] * factors[0]
    for k in range(1, width_here):
        out += words[k : k + n] * factors[k]
    out = np.sort(mix(out + U64(width_here)))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


@lru_cache(maxsize=4)
def _seeds(t: int) -> np.ndarray:
    return mix(np.arange(1, 2 * t + 1, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of hashes: ``t`` coordinates.

    Round i < t throws every element into a bin chosen by a hash of round and element; a
    bin keeps the smallest value of the first round that reached it. Round t + j throws
    every element into bin j, so no bin stays empty. Rounds end when all bins are full,
    after about t ln t throws whatever the size of the set. Two sets agree in a coordinate
    with the probability of their similarity, with concentration bounds as for independent
    hashes.
    """
    seeds = _seeds(t)
    out = np.zeros(t, dtype=U64)
    filled = np.zeros(t, dtype=bool)
    n, done = len(items), 0
    per_go = max(1, math.ceil(1.3 * t * math.log(t) / n))
    while done < t and not filled.all():
        go = min(per_go, t - done, max(1, 4_000_000 // n))
        thrown = mix(items[None, :] ^ seeds[done : done + go, None])
        bins = (thrown % U64(t)).astype(np.int64).ravel()
        # earlier rounds first, then smaller values: the round is in the top bits
        key = ((np.arange(go, dtype=U64)[:, None] << U64(50)) | (mix(thrown + U64(1)) >> U64(14))).ravel()
        if filled.any():
            free = ~filled[bins]
            bins, key = bins[free], key[free]
        order = np.argsort(key)[::-1]
        out[bins[order]] = key[order] + (U64(done) << U64(50))  # the last one written is the smallest
        filled[bins] = True
        done += go
    for j in np.flatnonzero(~filled):
        out[j] = (mix(items ^ seeds[t + j]) >> U64(14)).min() + (U64(t + j) << U64(50))
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` neighbouring coordinates."""
    parts = coordinates[: bands * rows].reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=U64)
    for k in range(rows):
        out = mix(out * U64(_BASE) + parts[:, k])
    return out.view(np.int64)


def set_hash(items: np.ndarray) -> int | None:
    """A signed 64-bit number for a sorted set; None for the empty one."""
    if not len(items):
        return None
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)
