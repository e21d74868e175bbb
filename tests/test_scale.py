"""Traffic of the feature and learner steps: rows that are many stay where they are, passes send a bounded number of parts."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import closed as CF
from reviewlens.operators import features as FT
from test_learn import long_rows

TEXTS = ["good good movie a", "bad movie, bad!", "movie", "", "great film good", None, "good film " * 40]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tfidf_moves_texts_and_terms_of_a_part_but_no_document_rows(spark, monkeypatch):
    monkeypatch.setattr(FT, "PART_CHARS", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = spark.createDataFrame([(i % 5, "x", t) for i, t in enumerate(TEXTS)], "doc_id long, kind string, text string")
        out, none = FT.tfidf(d, "text", fit=F.col("doc_id") != 2, numbered=False, carry=["kind"])
        plan = plan_of(out)
        assert none is None and plan.count("Exchange") == 4 and "hashpartitioning(doc_id" not in plan
        numbered, vocab = FT.tfidf(d, "text", fit=F.col("doc_id") != 2)
        rows = lambda t: sorted((r.doc_id, r.term, round(r.weight, 9)) for r in t.collect())
        assert rows(out) == rows(numbered) and {r.kind for r in out.collect()} == {"x"}
        assert vocab.count() == vocab.select("index").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hashed_vectors_need_no_join_of_texts(spark, monkeypatch):
    monkeypatch.setattr(FT, "SLOTS", 1 << 10)
    texts = [t or "" for t in TEXTS]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    from reviewlens import session
    real = session.stage
    monkeypatch.setattr(session, "stage", lambda df, name: seen.append(plan_of(df)) or real(df, name))
    assert FT.vectorize_hashed(d, "text").count() == len(texts)
    assert len(seen) == 1 and "Exchange" not in seen[0]
    # Of a repeated key every pair of rows counts, as before; a null key has none.
    twice = d.unionByName(d.where("doc_id < 2")).unionByName(spark.createDataFrame([(None, "good")], "doc_id long, text string"))
    assert FT.vectorize_hashed(twice, "text").count() == 2 * 4 + len(texts) - 2


def test_learners_read_as_many_parts_as_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    d = spark.range(1000).repartition(4 * cores + 3)
    assert FT.few_parts(d).rdd.getNumPartitions() == cores and FT.few_parts(d).count() == 1000


def test_carried_labels_give_the_same_bayes(spark):
    _, _, long, lab = long_rows(spark, 11)
    carried = long.join(lab, "doc_id").where("doc_id < 50").unionByName(  # documents without a label count as terms only
        long.where("doc_id >= 50"), allowMissingColumns=True)
    train, test = lab.where("doc_id < 30"), lab.where("doc_id >= 30 and doc_id < 50")
    a = CF.fit_complement_nb(long, train)
    b = CF.fit_complement_nb(carried, train, rows=F.col("doc_id") < 30)
    of = lambda w: {(r.term, c): r[f"w{c}"] for r in w.collect() for c in range(3)}
    assert of(b) == pytest.approx(of(a))
    inside = (F.col("doc_id") >= 30) & (F.col("doc_id") < 50)
    got = [{r.doc_id: r.prediction for r in p.collect()} for p in (
        CF.predict_nb(a, long, test), CF.predict_nb(b, carried, test, rows=inside))]
    assert got[0] == got[1] and len(got[0]) == 20
    x, y = ({(r.alpha, r.fold): r.macro_f1 for r in t.collect()} for t in (
        CF.cross_validate_nb(long, train, [0.5]),
        CF.cross_validate_nb(carried.where("doc_id < 50"), train, [0.5], inside=F.col("doc_id") < 30)))
    assert x.keys() == y.keys() and len(x) == 4


def test_bayes_fits_of_one_pass_equal_single_fits(spark):
    _, _, long, lab = long_rows(spark, 12)
    carried = long.join(lab, "doc_id")
    test, inside = lab.where("doc_id >= 40").select("doc_id", "label"), F.col("doc_id") >= 40
    parts = {"a": (F.col("doc_id") < 15, [0, 1, 2]), "b": (F.col("doc_id") < 40, [0, 1, 2])}
    assert all(CF.classes_of(lab.where(c)) == k for c, k in parts.values())
    fits = {"x": ("a", 1.0), "y": ("b", 1.0), "z": ("b", 0.1)}
    got = CF.predict_nb_fits(carried, parts, fits, test, inside).collect()
    assert len(got) == 20
    for name, (part, alpha) in fits.items():
        p = CF.predict_nb(CF.fit_complement_nb(long, lab.where(parts[part][0]), alpha), long, test)
        assert {r.doc_id: r[name] for r in got} == {r.doc_id: r.prediction for r in p.collect()}


def test_hashed_entries_stay_where_their_texts_are(spark, monkeypatch):
    monkeypatch.setattr(FT, "SLOTS", 1 << 10)
    rows = [(i, "train" if i != 2 else "test", t) for i, t in enumerate(TEXTS)]
    d = spark.createDataFrame(rows, "doc_id long, split string, text string")
    fit = F.col("split") == "train"
    once = FT.hashed_tfidf(d, "text", (1, 2), fit)
    assert "Exchange" not in plan_of(once)
    # An empty text more of a document outside ``fit`` changes nothing; a repeated key is one document.
    twice = FT.hashed_tfidf(d.unionByName(spark.createDataFrame([(2, "test", "")], d.schema)), "text", (1, 2), fit)
    a, b = ({(r.doc_id, r["index"]): r.value for r in t.collect()} for t in (once, twice))
    assert len(a) > 10 and a == pytest.approx(b)


def test_a_split_writes_its_texts_once(spark, tmp_path, monkeypatch):
    from reviewlens import session
    from reviewlens.plans import catalog as K
    spark.createDataFrame([(i, f"text {i}", "en", "s") for i in range(50)], "doc_id long, text string, lang string, source string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, i % 3) for i in range(50)], "doc_id long, toxic int, quality int").write.parquet(
        str(tmp_path / "labels.parquet"))
    seen = []
    real = session.stage
    monkeypatch.setattr(session, "stage", lambda df, name: seen.append(name) or real(df, name))
    sp = K.learn_split(spark, str(tmp_path))
    assert seen == ["learn-class"]
    assert {r.split: r["count"] for r in sp.groupBy("split").count().collect()} == {"train": 35, "val": 5, "test": 10}
