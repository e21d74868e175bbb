"""Learners on separable synthetic data: beat the majority baseline, seed-stable, macro-F1 evaluator, model paths."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import closed as CF
from reviewlens.operators import features as FT
from reviewlens.operators import learn as ML
from reviewlens.operators import metrics as M

WORDS = {0: "awful broken refund", 1: "okay average fine", 2: "great lovely superb"}


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, float(i % 3), f"{WORDS[i % 3]} filler{i % 7} words") for i in range(90)]
    d = spark.createDataFrame(rows, "doc_id long, label double, clean_text string")
    d = d.withColumn("split", F.when(F.col("doc_id") < 60, "train").otherwise("test"))
    _, vocab = FT.tfidf(d, "clean_text", fit=F.col("split") == "train", ngram_range=(1, 1))
    return FT.vectorize(d, "clean_text", vocab, (1, 1)).cache()


def test_beats_majority_and_seed_stable(spark, data):
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    _, nb, _ = ML.train_and_evaluate(ML.build_pipeline(ML.build("complement_nb", "classification", 60)), train, test)
    majority = M.metrics_basic(test.select(F.col("label").cast("int").alias("y_true"), F.lit(0).alias("y_pred")))
    assert nb.first().macro_f1 > majority.first().macro_f1
    assert nb.first().accuracy == 1.0
    p1 = ML.build("random_forest", "classification", 60, numTrees=10).fit(train).transform(test).select("doc_id", "prediction")
    p2 = ML.build("random_forest", "classification", 60, numTrees=10).fit(train).transform(test).select("doc_id", "prediction")
    assert sorted(map(tuple, p1.collect())) == sorted(map(tuple, p2.collect()))


def test_macro_f1_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "label double, prediction double")
    # classes 0,1,2: f1 = 2/3, 0, 1 -> macro 5/9
    assert ML.MacroF1Evaluator().evaluate(df) == pytest.approx(5 / 9)


def test_model_paths_and_random_candidates(spark):
    p = ML.model_path("/base", "classification", "Logistic Regression", "tfidf_stats")
    assert p == "/base/classification/lr_tfidf_stats"
    assert ML.representation_of(p) == "tfidf_stats"
    est = ML.build("random_forest", "classification", 10)
    grid = ML.param_grid("random_forest", est)
    cands = ML.random_candidates(grid, 10)
    assert len(cands) == min(10, 1 + 2 + 2 + 2, 8)
    assert cands == ML.random_candidates(grid, 10)


def test_registry_paths_round_trip_and_names_are_exact(spark):
    for task, found in ML.LEARNERS.items():
        for name, one in found.items():
            est = ML.build(name, task, 10, n_features=4)
            assert type(est) is type(ML.build(one.title, task, 10, n_features=4))
            for rep in ("tfidf", "bow", "text_stats", "tfidf_stats"):
                path = ML.model_path("/m", task, name, rep)
                assert path == ML.model_path("/m", task, one.title, rep) and ML.representation_of(path) == rep
            assert all(len(v) > 1 for v in ML.param_grid(name, est, task).values())
    for wrong in ("logistic regression", "nb", "forest"):
        with pytest.raises(ValueError):
            ML.build(wrong, "classification", 10)
    assert len(ML.expand_grid(ML.param_grid("gbt", ML.build("gbt", "classification", 10)))) == 8


def long_rows(spark, seed=4, n=60):
    import random
    rng = random.Random(seed)
    rows, labels = [], []
    for d in range(n):
        y = rng.choice([0, 1, 1, 2])
        labels.append((d, float(y), d % 4))
        for t in rng.sample(range(25), rng.randint(0, 6)):
            rows.append((d, f"t{t}", rng.random() + (t % 3 == y)))
    return (rows, labels, spark.createDataFrame(rows, "doc_id long, term string, value double"),
            spark.createDataFrame(labels, "doc_id long, label double, fold int"))


def brute_nb(rows, train, alpha, doc):
    import math
    label = {d: y for d, y, _ in train}
    terms = sorted({t for _, t, _ in rows})
    out = {}
    for c in sorted(set(label.values())):
        comp = {t: alpha for t in terms}
        for d, t, v in rows:
            if d in label and label[d] != c:
                comp[t] += v
        total = sum(comp.values())
        out[c] = sum(-v * math.log(comp[t] / total) for d, t, v in rows if d == doc)
    return min(c for c in out if out[c] == max(out.values()))


def test_complement_nb_equals_brute_force(spark):
    rows, labels, long, lab = long_rows(spark)
    train = [x for x in labels if x[0] < 40]
    w = CF.fit_complement_nb(long, lab.where("doc_id < 40"), 0.5)
    got = {r.doc_id: r.prediction for r in CF.predict_nb(w, long, lab.where("doc_id >= 40")).collect()}
    assert got == {d: brute_nb(rows, train, 0.5, d) for d in range(40, 60)}


def test_complement_nb_folds_equal_refits(spark):
    rows, labels, long, lab = long_rows(spark, 9)
    got = {(r.alpha, r.fold): r.macro_f1 for r in CF.cross_validate_nb(long, lab, [0.1, 1.0]).collect()}
    assert len(got) == 8
    for (alpha, fold), f1 in got.items():
        train = lab.where(f"fold <> {fold}")
        p = CF.predict_nb(CF.fit_complement_nb(long, train, alpha), long, lab.where(f"fold = {fold}"))
        assert f1 == pytest.approx(M.summary(CF.scored(p)).first().macro_f1)


def test_normal_equations_and_folds(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=80) * 0.1
    df = spark.createDataFrame([(*map(float, a), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))],
                               "a double, b double, c double, label double, fold int")
    cols = ["a", "b", "c"]
    full = np.hstack([np.ones((80, 1)), x])
    for alpha in (0.0, 2.0):
        want = np.linalg.solve(full.T @ full + alpha * np.diag([0, 1, 1, 1]), full.T @ y)
        assert CF.solve(CF.gram(df, cols), alpha) == pytest.approx(want)
    for r in CF.cross_validate_ridge(df, cols, [0.0, 5.0]).collect():
        out = np.arange(80) % 4 == r.fold
        a = full[~out]
        beta = np.linalg.solve(a.T @ a + r.alpha * np.diag([0, 1, 1, 1]), a.T @ y[~out])
        assert r.rmse == pytest.approx(np.sqrt(np.mean((full[out] @ beta - y[out]) ** 2)))
    twice = df.withColumn("b", F.col("a"))  # dependent columns share the weight
    beta = CF.solve(CF.gram(twice, ["a", "b"]))
    assert beta[1] == pytest.approx(beta[2])


def test_comparison_unites_tables_of_different_columns(spark):
    a = spark.createDataFrame([("m1", "tfidf", 0.5, 0.4), (None, None, None, 0.9)],
                              "model string, representation string, accuracy double, macro_f1 double")
    b = spark.createDataFrame([("r", 2.0), ("q", 1.0)], "model string, rmse double")
    got = [(r.model_type, r.model, r.representation, r.accuracy, r.macro_f1, r.rmse) for r in CF.comparison(Classical_ML=a, Regression=b).collect()]
    assert got == [("Classical ML", "Unknown", "Unknown", 0.0, 0.9, None), ("Classical ML", "m1", "tfidf", 0.5, 0.4, None),
                   ("Regression", "q", "Unknown", None, None, 1.0), ("Regression", "r", "Unknown", None, None, 2.0)]


def test_batch_scores_equal_transform(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = [(i, float(i % 3), float(i % 3) + (i % 7) / 10, float((i * 5) % 11)) for i in range(90)]
    d = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "doc_id long, label double, a double, b double"))
    model = ML.build("logistic", "classification", 90, maxIter=20).fit(d)
    score = ML.linear_batches(model.coefficientMatrix.toArray(), model.interceptVector.toArray(), classify=True, batch_size=7)
    got = model.transform(d).select("prediction", score(F.array("a", "b")).alias("batch")).collect()
    assert len(got) == 90 and all(r.prediction == r.batch for r in got)
    assert d.limit(0).select(score(F.array("a", "b"))).count() == 0
