"""Sets of word shingles, and the bands that retrieve near copies out of a fingerprint's reach."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE, SIMILAR = 5, 0.8
#: Two sets at SIMILAR agree in a band with probability 0.8 ** ROWS = 0.33, and in none of the
#: bands with 0.67 ** BANDS = 0.000003.
BANDS, ROWS = 32, 5
#: Shingles hashed by all rows at a time.
AT_ONCE = 1 << 12
_RNG = np.random.default_rng(53)
_FLIPS = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)
_FACTORS = _RNG.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles; a text of fewer words is one shingle, one without
    words has none. Words are as in
    :func:`scarmap.llm.simhash.fingerprint`."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, h64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([h64(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((h64(joined[a:b], 42) for a, b in spans), np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys (BANDS) of a set that isn't empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), AT_ONCE):
        np.minimum(least, ((hashes[at : at + AT_ONCE] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        key = (key ^ least[row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)
