"""Local explanations: a planted model gives its words back, long texts stay small, odd texts do not crash."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import explain as XP

PLANTED = {"superb": 3.0, "awful": -2.0, "fine": 1.2, "broken": -0.7}


def planted(text_col):
    """Score of a linear model over the presence of words, as two class probabilities."""
    def score(d):
        words = F.split(F.trim(text_col), r"\s+")
        total = sum((F.when(F.array_contains(words, w), F.lit(c)).otherwise(0.0) for w, c in PLANTED.items()), F.lit(10.0))
        return d.withColumn("probability", F.array(F.lit(0.0), total))
    return score


@pytest.mark.parametrize("k", [4, 10])
def test_planted_words_come_back_in_order(spark, k):
    filler = [f"w{i}" for i in range(30)]
    texts = [" ".join(filler[:12] + ["superb", "awful", "superb"] + filler[12:] + ["fine", "broken", "awful"]),
             " ".join(["fine", "superb", *filler])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in XP.local_explanations(planted("text"), d, "text", 500, k).orderBy("doc_id", "rank").collect():
        assert r.predicted == 1
        got.setdefault(r.doc_id, []).append((r.word, r.weight))
    assert [w for w, _ in got[0]][:4] == ["superb", "awful", "fine", "broken"]
    assert [w for w, _ in got[1]][:2] == ["superb", "fine"]
    for w, c in got[0][:4]:
        assert np.sign(c) == np.sign(PLANTED[w]) and abs(c) <= abs(PLANTED[w]) * 1.05


def test_masks_are_uniform_in_number_and_remove_all_places(spark):
    sizes = [int((~XP.keep_mask(10, s, "d", 42)).sum()) for s in range(1, 2001)]
    assert min(sizes) == 1 and max(sizes) == 10
    assert all(150 < sizes.count(n) < 250 for n in range(1, 11))
    d = spark.createDataFrame([(1, "a b a c"), (2, None), (3, "  ")], "doc_id long, text string")
    rows = {(r.doc_id, r.sample): r.text for r in XP.perturb(d, "text", 40).collect()}
    assert len(rows) == 120 and rows[1, 0] == "a b a c" and rows[2, 5] == ""
    assert {t.split().count("a") for (k, _), t in rows.items() if k == 1} == {0, 2}


def test_ridge_leaves_the_intercept_free_and_both_forms_agree():
    rng = np.random.default_rng(1)
    x, w = rng.integers(0, 2, (30, 8)).astype(float), rng.random(30) + 0.1
    y = x @ rng.normal(size=8) + 100.0
    full = np.hstack([np.ones((30, 1)), x])
    want = np.linalg.solve(full.T @ (w[:, None] * full) + 0.7 * np.diag([0.0] + [1.0] * 8), full.T @ (w * y))[1:]
    assert XP.ridge(x, y, w, 0.7) == pytest.approx(want)
    wide = np.hstack([x, rng.integers(0, 2, (30, 50))])
    c = (wide - w @ wide / w.sum()) * np.sqrt(w)[:, None]
    b = (y - w @ y / w.sum()) * np.sqrt(w)
    assert XP.ridge(wide, y, w, 0.7) == pytest.approx(np.linalg.solve(c.T @ c + 0.7 * np.eye(58), c.T @ b))


def test_long_document_stays_small():
    text = " ".join(f"w{i}" for i in range(20_000)) + " superb"
    p = np.array([2.0 * XP.keep_mask(20_001, s, 7, 42)[-1] for s in range(500)])
    for k in (3, 10):
        tracemalloc.start()
        got = XP.explain_one(text, 7, np.arange(500), p, k)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got[0][0] == "superb" and peak < 100_000_000


def test_words_that_say_nothing(spark):
    d = spark.createDataFrame([(1, ""), (2, None), (3, "one"), (4, "same same")], "doc_id long, text string")
    got = XP.local_explanations(planted("text"), d, "text", 20, 3).collect()
    assert {r.doc_id for r in got} <= {3, 4} and all(abs(r.weight) < 1e-9 for r in got)
    assert XP.local_explanations(planted("text"), d.limit(0), "text", 20, 3).count() == 0
