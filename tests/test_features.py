"""Feature operators: L2 norms, padding/truncation, duplicates, vocabulary ids, scaling."""

import math

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import eda as E
from reviewlens.operators import features as FT


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_tfidf_rows_unit_norm_and_smooth_idf(spark):
    d = docs(spark, ["good good movie", "bad movie", "movie", "great film good"])
    out, vocab = FT.tfidf(d, "text", ngram_range=(1, 1))
    norms = out.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(r.n == pytest.approx(1.0) for r in norms)
    idf = {r.term: r.idf for r in vocab.collect()}
    assert idf["movie"] == pytest.approx(math.log(5 / 4) + 1)  # in 3 of 4 docs: still > 0


def test_encode_pad_truncate_unknown(spark):
    d = docs(spark, ["a b", "a b c d e f", "zzz"])
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), ("d", 5)], "term string, id int")
    enc = {r.doc_id: (r.length, r.ids) for r in FT.encode_sequences(d, vocab, "text", max_len=4).collect()}
    assert enc[0] == (2, [2, 3, 0, 0])
    assert enc[1] == (4, [2, 3, 4, 5])
    assert enc[2] == (1, [1, 0, 0, 0])


def test_duplicates_nulls_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "doc_id long, t string")
    assert E.duplicate_count(df, "t").first().n_duplicates == 2
    marks = {r.doc_id: r.is_duplicate for r in E.duplicate_marks(df, "t", "doc_id").collect()}
    assert marks == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_vocab_ids(spark):
    d = docs(spark, ["b a b c", "a b d d", "c"])
    v = {r.term: (r.freq, r.id) for r in FT.vocab_by_freq(d, "text").collect()}
    assert v == {"b": (3, 2), "a": (2, 3), "c": (2, 4), "d": (2, 5)}
    f = {r.term: r.id for r in FT.vocab_first_seen(d, "text").collect()}
    assert f == {"b": 2, "a": 3, "c": 4, "d": 5}


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    z = sorted(r.x for r in FT.standard_scale(df, df, ["x"]).collect())
    assert z == pytest.approx([-math.sqrt(1.5), 0.0, math.sqrt(1.5)])
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.x for r in FT.standard_scale(const, const, ["x"]).collect()] == [0.0, 0.0]


TEXTS = ["good good movie a", "bad movie, bad!", "movie", "", "great film good ünï ünï 漢字 x1", "good film " * 40]


def brute_tfidf(texts, fit, hi):
    """{doc: {gram: weight}} over the grams of the fit documents."""
    import collections
    import re
    grams = []
    for t in texts:
        toks = re.findall(r"\w{2,}", t.lower())
        grams.append(collections.Counter(" ".join(toks[i:i + n]) for n in range(1, hi + 1) for i in range(len(toks) - n + 1)))
    df = collections.Counter(g for d in fit for g in grams[d])
    out = {}
    for d, c in enumerate(grams):
        w = {g: k * (math.log((len(fit) + 1) / (df[g] + 1)) + 1) for g, k in c.items() if g in df}
        norm = math.sqrt(sum(x * x for x in w.values()))
        if w:
            out[d] = {g: x / norm for g, x in w.items()}
    return out


@pytest.mark.parametrize("head", [50_000, 2, 0])
def test_tfidf_keeps_all_terms_by_head_and_tail(spark, monkeypatch, head):
    monkeypatch.setattr(FT, "HEAD_TERMS", head)
    d = docs(spark, TEXTS)
    out, vocab = FT.tfidf(d, "text", fit=F.col("doc_id") != 2)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, {})[r.term] = r.weight
    want = brute_tfidf(TEXTS, [0, 1, 3, 4, 5], 2)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in want)
    rows = vocab.orderBy("term").collect()
    assert [r["index"] for r in rows] == list(range(len(rows)))


def test_no_exchange_of_document_terms_nor_wide_broadcast(spark):
    plan = FT.doc_terms(docs(spark, TEXTS), "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(doc_id" in plan


def test_capped_vocabulary_is_by_frequency_then_term(spark):
    d = docs(spark, ["b b b aa aa cc cc dd", "aa bb"])
    _, vocab = FT.bow(d, "text", max_features=2)
    assert [r.term for r in vocab.orderBy("index").collect()] == ["aa", "cc"]


def test_hashed_vectors_hold_all_terms(spark, monkeypatch):
    monkeypatch.setattr(FT, "SLOTS", 1 << 12)
    d = docs(spark, TEXTS)
    vec = {r.doc_id: r.features for r in FT.vectorize_hashed(d, "text", (1, 2), F.col("doc_id") != 2).collect()}
    long = {}
    for r in FT.hashed_tfidf(d, "text", (1, 2), F.col("doc_id") != 2).collect():
        long.setdefault(r.doc_id, {})[r["index"]] = r.value
    assert len(vec) == len(TEXTS)
    for i, v in vec.items():
        assert dict(zip(map(int, v.indices), v.values)) == pytest.approx(long.get(i, {}))


def test_windows_hold_every_token(spark):
    d = docs(spark, ["a b", "a b c d e f a a a", "zzz", "", "b " * 1000])
    vocab = spark.createDataFrame([("a", 2, 50), ("b", 3, 9), ("c", 4, 2), ("d", 5, 2)], "term string, id int, freq long")
    got = {}
    for r in FT.encode_windows(d, vocab, "text", max_len=4).orderBy("doc_id", "window").collect():
        assert len(r.ids) == 4 and all(i == 0 for i in r.ids[r.length:])
        got.setdefault(r.doc_id, []).extend(r.ids[:r.length])
    assert got == {0: [2, 3], 1: [2, 3, 4, 5, 1, 1, 2, 2, 2], 2: [1], 3: [], 4: [3] * 1000}


def test_density_equals_the_sum_over_rows(spark):
    import random
    rng = random.Random(1)
    lens = [rng.randint(1, 400) for _ in range(300)] + [9_000]
    w = spark.createDataFrame([(n,) for n in lens], "char_len int")
    n, mean = len(lens), sum(lens) / len(lens)
    bw = math.sqrt(sum((x - mean) ** 2 for x in lens) / (n - 1)) * n ** -0.2
    lo, step = min(lens), (max(lens) - min(lens)) / 99
    for r in E.length_kde(w).collect():
        want = sum(math.exp(-0.5 * ((lo + r.grid * step - x) / bw) ** 2) for x in lens) / (n * bw * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want, abs=1e-9)
