"""Shingle sets of texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import split_words

#: Odd multipliers that keep the first words of a shingle apart; further places go on from the last.
_PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]

#: Words whose bytes are hashed together.
HASHED = 1 << 15
#: bytes.lower() changes A-Z alone.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def places(k: int) -> np.ndarray:
    out = list(_PLACES[:k])
    while len(out) < k:
        out.append((out[-1] * _PLACES[0] + 2) & (2**64 - 1) | 1)
    return np.array(out, np.uint64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of words, A-Z in lower case: each byte is scrambled with its place, a word's sum is scrambled again."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.cast(pa.binary())
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    out = np.zeros(len(words), np.uint64)
    for first in range(0, len(words), HASHED):
        at = ends[first:first + HASHED + 1]
        raw = _LOWER[np.frombuffer(words.buffers()[2], np.uint8, at[-1] - at[0], at[0])]
        size = np.diff(at)
        place = np.arange(len(raw)) - np.repeat(at[:-1] - at[0], size)
        filled = np.flatnonzero(size)  # reduceat gives an empty word the byte behind it
        sums = np.add.reduceat(mixed((place.astype(np.uint64) << np.uint64(8)) + raw + np.uint64(1)), (at[:-1] - at[0])[filled])
        out[first + filled] = sums
    return mixed(out + np.uint64(0xA0761D6478BD642F))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of every text's shingles of ``k`` words, A-Z in lower case.

    Texts of fewer words have the whole sequence as their only one; texts without words and nulls the empty set.
    """
    words, index, offsets = split_words(texts)
    hashes = word_hashes(words)
    w = hashes[index] if len(index) else np.zeros(0, np.uint64)
    n, at = len(w), places(k)
    rolled = np.zeros(max(n - k + 1, 0), np.uint64)
    for i in range(k):
        rolled += w[i:max(n - k + 1 + i, 0)] * at[i] if len(rolled) else rolled
    rolled = mixed(rolled)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= k:
            s = np.sort(rolled[a:b - k + 1])
            first = np.empty(len(s), bool)
            first[0] = True
            np.not_equal(s[1:], s[:-1], out=first[1:])
            out.append(s[first])
        elif b > a:
            whole = (w[a:b] * at[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    a = mixed(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(mixed(s + np.uint64(0xE7037ED1A0B428DB))) if len(s) else np.uint64(0)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = len(y) - 1
    return int(np.count_nonzero(y[at] == x))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = shared(x, y)
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
