"""Word hashes of whole texts, vectorized over their bytes."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(23)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_RANDOM.integers(1, 2**62)) * 2 + 1)
#: Letters, digits and the signs that names of licences hold make up words; all else parts them.
_WORD = np.zeros(256, bool)
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz+.-", *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def hash_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (lower-cased, dots and hyphens at their ends included), the line of each counted over all
    texts, and where each text's words begin and the last one's end."""
    a = _FOLD[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    offsets = np.cumsum([0] + [len(x) + 1 for x in raw])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _WORD[a]])))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(raw) + 1, np.int64)
    ends = ends - (a[ends - 1] == 46) * (ends - starts > 1)  # a full stop ends a sentence, not a word
    length = ends - starts
    power = np.ones(int(length.max()), np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power, dtype=np.uint64)
    begin = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(begin, length)
    word = np.add.reduceat(_BYTES[a[np.repeat(starts, length) + inside]] * power[inside], begin)
    word = (word ^ (word >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    lines = np.searchsorted(np.flatnonzero(a == 10), starts)
    return word ^ (word >> np.uint64(29)), lines, np.searchsorted(starts, offsets)
