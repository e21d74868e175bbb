"""Findings of run_eda that share one count of grams and words."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import eda as E

ROWS = [(1, "the cat sat the cat", "positive"), (2, "a dog sat A dog", "negative"), (3, "the dog ran ran", None),
        (4, "Cat and  dog", "neutral"), (5, "ties: b c d e f g h", "positive"), (6, "the cat", "positive")]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def work(spark):
    return spark.createDataFrame(ROWS, "doc_id long, clean_text string, sentiment string").cache()


@pytest.mark.parametrize("k", [1, 3, 100])
def test_shared_counts_give_the_same_rows(work, k):
    grams, words = E.shared_grams(work), E.shared_words(work)
    for n in (1, 2):
        assert rows(E.top_ngrams(work, n, k, grams=grams)) == rows(E.top_ngrams(work, n, k))
    assert rows(E.top_ngrams_by_class(work, (1, 2), k, grams=grams)) == rows(E.top_ngrams_by_class(work, (1, 2), k))
    assert rows(E.cloud_terms(work, k=k, words=words)) == rows(E.cloud_terms(work, k=k))
    assert rows(E.vocab_stats(work, words=words)) == rows(E.vocab_stats(work))


def test_enough_keeps_few_grams(spark):
    text = " ".join(["often"] * 64 + ["some"] * 8 + [f"w{i}" for i in range(500)])
    w = spark.createDataFrame([(1, text, "positive")], "doc_id long, clean_text string, sentiment string")
    words = E.shared_words(w)
    assert words.by_class(2).count() == 2 and words.by_class(3).count() == 502


def test_run_eda_cuts_texts_into_tokens_once(spark, monkeypatch):
    from reviewlens.functions import text as X
    from reviewlens.plans.catalog import QUERIES
    seen = []
    for name in ("word_tokens", "ws_tokens"):
        real = getattr(X, name)
        monkeypatch.setattr(X, name, lambda c, real=real, name=name: seen.append(name) or real(c))
    out = QUERIES["run_eda"](spark, "/root/testdata/sf0.001")
    assert seen.count("word_tokens") == 1 and seen.count("ws_tokens") <= 2  # one of them counts words a text
    assert out.where(F.col("finding") == "top_2_grams").count() == 20
