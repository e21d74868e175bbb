"""Grams of a part: numbers against plain Python, and plans without rows of (document, term) in the JVM's sorts."""

import collections

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reviewlens.functions.columns import rounded
from reviewlens.operators import features as FT
from reviewlens.operators import grams as G

TEXTS = ["aa bb aa bb", None, "cc", "aa bb cc dd aa bb", None, "bb bb bb"]


def test_grams_as_by_hand():
    for lo, hi in [(1, 1), (1, 2), (2, 3), (3, 3)]:
        row, gram, texts = G.grams_of([pa.array(TEXTS[:2], pa.string()), pa.array(["zz"] + TEXTS[2:]).slice(1)], lo, hi)
        assert len(set(texts.to_pylist())) == len(texts)
        got = collections.Counter((r, texts[g].as_py()) for r, g in zip(row.tolist(), gram.tolist()))
        words = [(t or "").split() for t in TEXTS]
        want = collections.Counter((r, " ".join(w[i:i + n])) for r, w in enumerate(words) for n in range(lo, hi + 1)
                                   for i in range(len(w) - n + 1))
        assert got == want
    assert [len(x) for x in G.grams_of([pa.array([None], pa.string())], 1, 2)] == [0, 0, 0]


def test_groups_of_equal_values():
    a, b = pa.array([1, None, 1, None, 2]), pa.array([float("nan"), 1.0, float("nan"), 1.0, 1.0])
    assert G.groups_of(a, b).tolist() == [0, 1, 0, 1, 2]


def test_tfidf_sorts_no_document_rows(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for out in (FT.tfidf(d, "text", numbered=False)[0], FT.bow(d, "text", numbered=False)[0]):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Generate" not in plan and "Aggregate(keys=[_part" not in plan


def test_repeated_and_null_keys_are_one_document(spark):
    d = spark.createDataFrame([(1, "aa bb"), (1, "bb cc"), (None, "aa"), (None, "aa"), (2, None)], "doc_id long, text string")
    tf = {(r.doc_id, r.term): r.tf for r in FT.bow(d, "text", numbered=False)[0].collect()}
    assert tf == {(1, "aa"): 1, (1, "bb"): 2, (1, "cc"): 1, (None, "aa"): 2}
    w = {(r.doc_id, r.term): r.weight for r in FT.tfidf(d, "text", numbered=False)[0].collect()}
    assert np.isclose(sum(x * x for (k, _), x in w.items() if k == 1), 1) and (1, "bb cc") in w and ("bb bb" not in {t for _, t in w})


def test_rounded_is_round(spark):
    rng = np.random.default_rng(1)
    x = [*rng.random(20_000).tolist(), *((rng.integers(-9, 10 ** 9, 3_000) + 0.5) / 1e6).tolist(), 1e300, -1e9, 0.0, -0.1234565, float("nan"),
         float("inf"), None]
    d = spark.createDataFrame([(v,) for v in x], "x double")
    assert d.where(~rounded(F.col("x")).eqNullSafe(F.round("x", 6))).count() == 0
