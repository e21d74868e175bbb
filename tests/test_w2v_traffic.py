"""Word2Vec between its rounds: vectors in 8 bits, no table left but the result."""

import os

import numpy as np
import pyarrow as pa
import pytest

from reviewlens import session
from reviewlens.operators import embed as EM


def test_vectors_travel_in_a_quarter_of_single_precision():
    rows = np.random.default_rng(5).normal(size=(40, 2 * 8)).astype(np.float32) * np.repeat(10.0 ** np.arange(-2, 2), 10)[:, None]
    rows[3], rows[4, 8:] = 0, 0
    sent = EM._packed(rows, 8)
    assert {len(x) for x in sent} == {2 * (4 + 8)}
    got = EM._unpacked(pa.chunked_array([pa.array(sent[:7], pa.binary()), pa.array(sent[7:], pa.binary())]), 8)
    top = np.abs(rows.reshape(-1, 2, 8)).max(axis=2, keepdims=True)
    assert (np.abs(got - rows).reshape(-1, 2, 8) <= top / 127 * 0.5001 + 1e-12).all() and not got[3].any()


def test_rounds_leave_the_last_table_alone(spark):
    texts = [" ".join(f"w{(i * j) % 9}" for j in range(12)) for i in range(40)]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    before = list(session._STAGES)
    model = EM.train_word2vec(d, "text", numPartitions=4, vectorSize=6)
    left = [x for x in session._STAGES if x not in before]
    assert left == [model.table._stage_path] and os.path.isdir(left[0].removeprefix("file:"))
    got = {r.word: np.array(r.vector) for r in model.table.collect()}
    assert got.keys() == {f"w{i}" for i in range(9)} and all(len(v) == 6 and np.isfinite(v).all() and v.any() for v in got.values())
    again = {r.word: np.array(r.vector) for r in EM.train_word2vec(d.repartition(3), "text", numPartitions=4, vectorSize=6).table.collect()}
    assert all(again[w] == pytest.approx(v) for w, v in got.items())
