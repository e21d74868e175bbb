"""Stemming / lemma jobs, the embedding cache, and word-vector averaging."""

import pytest
from pyspark.sql import functions as F

from porter_by_hand import stem
from reviewlens.functions import text as X
from reviewlens.functions.stemming import stemmed
from reviewlens.operators import embed as EM
from reviewlens.operators import lexical as LX


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("agreed", "agre"), ("motoring", "motor"), ("hopping", "hop"),
    ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("generalization", "gener"),
    ("adjustment", "adjust"), ("controll", "control"), ("running", "run")])
def test_porter(word, expected):
    assert stem(word) == expected


ODD_WORDS = """syzygy toying playyy yyyed tyyyying ss s ing ed eed feed sky skies naïve ÿing étés oed rolled fizzed conflated
troubled sized failing adoption rational conditional probate cease hopefulness sensibiliti feudalism irritant ion""".split()


def test_native_stems_equal_those_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = docs.select(F.explode(X.word_tokens(X.clean_text(F.col("text")))).alias("term"))
    words = words.union(spark.createDataFrame([(w,) for w in [*ODD_WORDS, ""]], "term string")).distinct()
    got = stemmed(words, "term", "stem").collect()
    assert len(got) > 500 and [r for r in got if r.stem != stem(r.term)] == []
    assert stemmed(spark.createDataFrame([(None,)], "term string"), "term", "stem").first().stem is None


def test_word2vec_partitions_keep_neighbours(spark):
    groups = [[f"{c}{i}" for i in range(6)] for c in "abc"]
    rows = [(i, " ".join(groups[i % 3][(i // 3 * 5 + j * j) % 6] for j in range(12))) for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, t string").repartition(4, "doc_id")
    assert EM.w2v_partitions(0) == 1 and EM.w2v_partitions(EM.TOKENS_A_PARTITION + 1) == 2
    for parts in (1, 4):
        m = EM.train_word2vec(d, "t", vectorSize=16, numPartitions=parts)
        assert m.getVectors().count() == 18
        for g in groups:
            near = [r.word for r in m.findSynonyms(g[0], 5).collect()]
            assert sum(w in g for w in near) >= 4


def test_word_vectors_are_rows_and_agree_between_runs(spark):
    d = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c a{i % 3}" + " rare" * (i == 3)) for i in range(200)] + [(900, ""), (901, None)],
                              "doc_id long, t string").repartition(5)
    m = EM.train_word2vec(d, "t", vectorSize=8, numPartitions=3)
    plan = m.getVectors()._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "LocalTableScan" not in plan  # no vector came from the driver
    vec = {r.word: r.vector for r in m.table.collect()}
    assert set(vec) == {*(f"a{i}" for i in range(7)), *(f"b{i}" for i in range(5)), "c"}
    assert all(len(v) == 8 and any(v) for v in vec.values())
    again = EM.train_word2vec(d.repartition(2), "t", vectorSize=8, numPartitions=3)
    assert {r.word: r.vector for r in again.table.collect()} == vec
    assert EM.train_word2vec(d.where("doc_id > 800"), "t").getVectors().count() == 0
    assert EM.w2v_partitions(10 ** 9, 12) == 252 and EM.w2v_partitions(10 ** 6, 12) == 4


def test_averages_weigh_by_count_over_any_batches(spark):
    import numpy as np
    rows = [(p, f"w{w}", p + 1, 0, np.array([w, p], np.float32).tobytes()) for w in range(5) for p in range(w + 1)]
    d = spark.createDataFrame(rows, "part int, word string, n long, h long, vec binary").coalesce(1).sortWithinPartitions("word")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {r.word: r.vector for r in d.mapInArrow(EM._averaged(2, True), "word string, vector array<float>").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {f"w{w}": [w, sum(p * (p + 1) for p in range(w + 1)) / sum(p + 1 for p in range(w + 1))] for w in range(5)}
    assert got.keys() == want.keys() and all(got[w] == pytest.approx(want[w]) for w in want)


def test_weighted_vectors_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(EM, "ROWS_A_PART", 4)
    rows = [(i % 17 if i % 11 else None, f"t{i % 13}" + " x" * (i % 10 == 0), (i % 4) / 4) for i in range(150)]
    rows = list({(k, t): (k, t, w) for k, t, w in rows}.values())
    vec = {f"t{j}": [float(j), 1.0, -j / 2] for j in range(11)}
    docs = spark.createDataFrame([(i,) for i in range(19)] + [(3,), (None,)], "doc_id long")
    long = spark.createDataFrame(rows, "doc_id long, term string, weight double")
    vecs = spark.createDataFrame(list(vec.items()), "term string, vec array<float>")
    out = EM.weighted_doc_vectors(docs, long, vecs, 3)
    assert "Summarizer" not in out._jdf.queryExecution().toString()  # no vector a (document, term) row
    out = out.collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(map(str, [*range(19), 3, None]))
    for r in out:
        mine = [(w, vec[t]) for k, t, w in rows if k is not None and k == r.doc_id and w > 0 and t in vec]
        total = sum(w for w, _ in mine)
        want = [sum(w * v[j] for w, v in mine) / total for j in range(3)] if mine else [0.0] * 3
        assert r.vec == pytest.approx(want, abs=1e-6)


def test_stem_and_lemma_jobs(spark):
    d = spark.createDataFrame([(1, "Running dogs ran"), (2, ""), (3, "the cats")], "doc_id long, t string")
    s = {r.doc_id: r.stem for r in LX.stem_text(d, "t").collect()}
    assert s == {1: "run dog ran", 2: "", 3: "the cat"}
    dic = spark.createDataFrame([("ran", "run"), ("dogs", "dog")], "form string, lemma string")
    lm = {r.doc_id: r.lemma for r in LX.lemmatize_text(d, "t", dic).collect()}
    assert lm == {1: "running dog run", 2: "", 3: "the cats"}
    plain = {r.doc_id: r.lemma for r in LX.lemmatize_text(d, "t").collect()}
    assert plain[1] == "running dogs ran"


def test_embedding_cache_hits(spark, tmp_path):
    d = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "a b")], "doc_id long, t string")
    path = str(tmp_path / "cache")
    first = {r.doc_id: r.from_cache for r in EM.embed_with_cache(spark, d.where("doc_id < 3"), "t", path).collect()}
    assert first == {1: False, 2: False}
    second = EM.embed_with_cache(spark, d, "t", path).collect()
    assert {r.doc_id: r.from_cache for r in second} == {1: True, 2: True, 3: True}
    assert all(len(r.embedding) == EM.ENCODER_DIM for r in second)
    assert spark.read.parquet(path).count() == 2  # one row per distinct text


def test_weighted_vectors_zero_when_no_shared_term(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    long = spark.createDataFrame([(1, "good", 0.5), (1, "bad", 0.5), (2, "zzz", 1.0)],
                                 "doc_id long, term string, weight double")
    vecs = spark.createDataFrame([("good", [1.0, 0.0]), ("bad", [0.0, 1.0])], "term string, vec array<float>")
    out = {r.doc_id: r.vec for r in EM.weighted_doc_vectors(docs, long, vecs, 2).collect()}
    assert out[1] == pytest.approx([0.5, 0.5])
    assert out[2] == [0.0, 0.0]


def test_dictionary_with_several_lemmas_takes_the_least(spark):
    d = spark.createDataFrame([(1, "Dogs dogs ran")], "doc_id long, t string")
    dic = spark.createDataFrame([("DOGS", "hound"), ("dogs", "dog"), ("cats", "cat")], "form string, lemma string")
    assert [r.processed_text for r in LX.preprocess_for_ml(d, "t", dictionary=dic).collect()] == ["dog dog ran"]
    assert [r.processed_text for r in LX.preprocess_for_ml(d, "t", use_lemma=False).collect()] == ["dog dog ran"]
