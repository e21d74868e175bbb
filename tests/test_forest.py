"""Forest over the non-zero slots: the same trees as MLlib's, from rows that hold no more than their own slots."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlens.operators import forest as FO
from reviewlens.operators import learn as ML

WIDTH = 1 << 16


def sparse_rows(spark, n=400, seed=3, width=WIDTH, whole=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.choice([0, 1, 2, 2])
        slots = {rng.randrange(40) * 1600: 0.0 for _ in range(rng.randint(0, 9))}
        if rng.random() < 0.6:
            slots[5 + y] = 0.0
        values = {s: float(rng.randint(1, 3)) if whole else rng.random() + 0.2 * (s % 3 == y) for s in slots}
        rows.append((i, float(y), Vectors.sparse(width, values)))
    return spark.createDataFrame(
        rows, ["doc_id", "label", "features"]).repartition(4, "doc_id").cache()


def answers(model, d):
    return {r.doc_id: (r.prediction, r.probability.toArray().tolist(), r.rawPrediction.toArray().tolist())
            for r in model.transform(d).select("doc_id", "prediction", "probability", "rawPrediction").collect()}


@pytest.mark.parametrize("whole", [False, True])
def test_one_tree_over_all_slots_is_mllibs(spark, monkeypatch, whole):
    d = sparse_rows(spark, width=2000 * 40, whole=whole)
    fixed = dict(numTrees=1, bootstrap=False, seed=1, maxDepth=6, minInstancesPerNode=2)
    monkeypatch.setattr(FO, "ENTRIES", 50)
    mine = FO.SlotForest(**fixed).fit(d)
    theirs = RandomForestClassifier(**fixed).fit(d)
    assert isinstance(mine, FO.SlotForestModel)
    got, want = answers(mine, d), answers(theirs, d)
    assert len({tuple(v[1]) for v in want.values()}) > 3
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1]) and got[k][2] == pytest.approx(want[k][2])


def test_wide_rows_are_not_made_dense_and_groups_of_nodes_change_nothing(spark, monkeypatch):
    d = sparse_rows(spark)
    seen, real = [], FO.stage
    monkeypatch.setattr(FO, "stage", lambda df, name: seen.append(real(df, name)) or seen[-1])
    monkeypatch.setattr(FO, "drop", lambda *x: None)
    build = lambda: ML.build("random_forest", "classification", 400, numTrees=20)
    one = build().fit(d)
    assert seen[0].agg(F.max(F.size("bins"))).first()[0] <= 10
    monkeypatch.setattr(FO, "CELLS", 1)  # a pass a node
    monkeypatch.setattr(FO, "ROWS", 7)
    short = ML.build("random_forest", "classification", 400, numTrees=20, maxDepth=2)
    a = answers(short.fit(d), d)
    monkeypatch.setattr(FO, "CELLS", 1 << 23)
    assert a == answers(short.fit(d), d)
    assert answers(one, d) == answers(build().fit(d), d)


def test_bootstrap_weights_and_split_candidates():
    w = FO.poisson(np.random.default_rng(1).integers(-2**62, 2**62, 4000), 50)
    assert w.mean() == pytest.approx(1, abs=0.02) and w.var() == pytest.approx(1, abs=0.03)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.06
    assert FO.candidates(np.array([1.0, 3.0]), np.array([2, 2]), 4.0, 31) == [2.0]
    assert FO.candidates(np.array([1.0, 3.0]), np.array([2, 2]), 9.0, 31) == [0.5, 2.0]
    many = FO.candidates(np.arange(1, 101.0), np.ones(100, int), 100.0, 3)
    assert many == [25.5, 50.5, 75.5]


def test_narrow_or_dense_vectors_stay_with_mllib(spark):
    rows = [(i, float(i % 2), Vectors.dense([float(i % 2), float(i % 5)])) for i in range(40)]
    d = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    model = ML.build("random_forest", "classification", 40, numTrees=3).fit(d)
    assert not isinstance(model, FO.SlotForestModel) and model.getNumTrees == 3


def test_learners_of_a_representation_share_its_tables(spark, monkeypatch):
    from reviewlens.plans import catalog as C

    rows = [(i, float(i % 2), Vectors.dense([float(i % 2), float(i % 5)]), "train" if i < 30 else "test") for i in range(40)]
    d = spark.createDataFrame(rows, ["doc_id", "label", "features", "split"])
    built = []
    monkeypatch.setattr(C, "learn_split", lambda *a: d)
    monkeypatch.setattr(C, "represent", lambda sp, rep, slots: built.append(rep) or sp)
    monkeypatch.setattr(C, "_REPRESENTED", {}, raising=False)
    monkeypatch.setattr(C, "_FITTED", {})
    for name in ("random_forest", "complement_nb"):
        row = C._fit_one(spark, "x", name, "bow")[1].first()
        assert (row.model, row.accuracy) == (name, 1.0 if name == "random_forest" else row.accuracy)
    C._fit_one(spark, "x", "random_forest", "tfidf")
    assert built == ["bow", "tfidf"]
