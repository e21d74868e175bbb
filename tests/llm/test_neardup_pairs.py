"""Candidate pairs of near duplicates: what rules them out, and how words are hashed."""

import numpy as np
import pyarrow as pa

from reviewlens.llm import neardup, shingles


def test_pairs_of_unlike_sizes_are_not_likely(spark):
    """Registers alone let short sets pass: too few are filled to tell."""
    empty = np.full(neardup.BANDS * 4, neardup.EMPTY, np.uint16)
    one, two = empty.copy(), empty.copy()
    one[:4], two[:8] = 7, 7
    band = lambda r: [int(x) for x in r.view(np.int64)]
    nodes = spark.createDataFrame([(bytearray(b"a"), 4, band(one)), (bytearray(b"b"), 5, band(one)), (bytearray(b"c"), 8, band(two))],
                                  "node binary, n bigint, bands array<bigint>")
    pairs = spark.createDataFrame([(bytearray(x), bytearray(y)) for x, y in [(b"a", b"b"), (b"a", b"c"), (b"b", b"c")]],
                                  "a binary, b binary")
    got = neardup.likely(pairs, nodes).collect()
    assert [(bytes(r.a), bytes(r.b)) for r in got] == [(b"a", b"b")] and abs(got[0].est - 1) < 1e-9


def test_estimate_as_by_hand():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (50, 128)).astype(np.uint16)
    y = rng.integers(0, 3, (50, 128)).astype(np.uint16)
    x[x == 2], y[y == 2] = neardup.EMPTY, neardup.EMPTY
    est, error = neardup.estimate(x.view(np.int64), y.view(np.int64))
    for i in range(50):
        used = [(a, b) for a, b in zip(x[i].tolist(), y[i].tolist()) if not a == b == neardup.EMPTY]
        share = sum(a == b for a, b in used) / len(used)
        assert abs(est[i] - (share - 1 / 3072) / (1 - 1 / 3072)) < 1e-12 and abs(error[i] - (0.16 / len(used)) ** 0.5) < 1e-12


def test_word_hashes(monkeypatch):
    words = ["ab", "AB", "ba", "é", "É", "a" * 70_000, "a" * 69_999, "b", "\x00", "\x00\x00"]
    h = shingles.word_hashes(pa.array(words))
    assert h[0] == h[1] and len(set(h.tolist())) == len(words) - 1
    monkeypatch.setattr(shingles, "HASHED", 3)
    assert (shingles.word_hashes(pa.array(["zz", *words]).slice(1)) == h).all()
    assert not len(shingles.word_hashes(pa.array([], pa.string())))
