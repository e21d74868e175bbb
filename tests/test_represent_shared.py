"""run_features: representations that share hashed TF-IDF or scaled statistics take them once."""

from pyspark.sql import functions as F

from reviewlens.operators import features as FT
from reviewlens.plans import catalog as C


def test_shared_inputs_are_made_once(spark, monkeypatch):
    monkeypatch.setattr(FT, "SLOTS", 64)
    calls = []
    for name in ("vectorize_hashed", "text_stats"):
        monkeypatch.setattr(FT, name, lambda *a, f=getattr(FT, name), n=name, **k: calls.append(n) or f(*a, **k))
    rows = [(i, f"aa b{i % 5} cc. D{i}", ("train", "val", "test")[i % 3], 0.0) for i in range(30)]
    sp = spark.createDataFrame(rows, "doc_id long, text string, split string, label double").withColumn("clean_text", F.lower("text"))
    reps, made = ("tfidf", "text_stats", "tfidf_stats"), {}
    alone = [C.represent(sp, r, 64) for r in reps]
    assert len(calls) == 4
    calls.clear()
    together = [C.represent(sp, r, 64, made) for r in reps]
    assert sorted(calls) == ["text_stats", "vectorize_hashed"]
    for a, b in zip(alone, together):
        of = lambda d: sorted((r.doc_id, str(r.features)) for r in d.select("doc_id", "features").collect())
        assert of(a) == of(b)
