"""Metric edge rules (zero division, union class set) and properties against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import metrics as M


def scored_df(spark, rows):
    return spark.createDataFrame(rows, "y_true int, y_pred int, p0 double, p1 double, p2 double")


def test_zero_division_and_union_classes(spark):
    # class 2 is never predicted; class 1 only appears in predictions
    rows = [(0, 0, .8, .1, .1), (0, 1, .2, .7, .1), (2, 0, .6, .2, .2), (0, 0, .9, .05, .05)]
    pc = {r.cls: r for r in M.per_class(scored_df(spark, rows)).collect()}
    assert set(pc) == {0, 1, 2}
    assert pc[2].precision == 0.0 and pc[2].f1 == 0.0 and pc[2].support == 1
    assert pc[1].support == 0 and pc[1].f1 == 0.0
    m = M.metrics_basic(scored_df(spark, rows)).first()
    f1_0 = 2 * 2 / (3 + 3)
    assert m.macro_f1 == pytest.approx(round(f1_0 / 3, 6))
    assert m.accuracy == 0.5


def test_confusion_sums_to_n(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(3), rnd.randrange(3), .3, .3, .4) for _ in range(300)]
    cm = M.confusion(scored_df(spark, rows))
    assert cm.agg(F.sum("cnt")).first()[0] == 300
    assert cm.count() == 9


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y]
    neg = [s for y, s in zip(ys, ss) if not y]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_brute_force_and_monotone_invariance(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(200):
        y = rnd.randrange(3)
        p = [round(rnd.random(), 2) for _ in range(3)]
        p[y] += 0.3
        t = sum(p)
        rows.append((y, max(range(3), key=lambda i: p[i]), p[0] / t, p[1] / t, p[2] / t))
    df = scored_df(spark, rows)
    got = {r.cls: r.auc for r in M.roc_auc(df).collect()}
    for c in range(3):
        exp = brute_auc([r[0] == c for r in rows], [r[2 + c] for r in rows])
        assert got[str(c)] == pytest.approx(exp, abs=1e-6)
    sq = df.select("y_true", "y_pred", *[(F.col(f"p{c}") ** 3).alias(f"p{c}") for c in range(3)])
    got2 = {r.cls: r.auc for r in M.roc_auc(sq).collect()}
    assert got == got2


def test_roc_curve_ends_at_one(spark):
    rows = [(0, 0, .7, .2, .1), (1, 1, .2, .7, .1), (2, 2, .1, .2, .7), (0, 1, .4, .5, .1)]
    roc = M.roc_curve(scored_df(spark, rows))
    last = roc.groupBy("cls").agg(F.max("tpr").alias("t"), F.max("fpr").alias("f")).collect()
    assert all(r.t == 1.0 and r.f == 1.0 for r in last)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y_true double, y_pred double")
    r = M.regression_metrics(df).first()
    assert r.mse == pytest.approx(2 / 3, abs=1e-6) and r.mae == pytest.approx(2 / 3, abs=1e-6)
    assert r.r2 == pytest.approx(0.0, abs=1e-9)


def test_further_classes_get_their_columns(spark):
    df = spark.createDataFrame([(0, 0), (3, 3), (3, 7), (1, 0)], "y_true int, y_pred int")
    m = M.metrics_basic(df).first()
    assert m.f1_class_3 == pytest.approx(2 / 3, abs=1e-6) and m.f1_class_7 == 0.0 and m.f1_class_2 is None
    assert m.macro_f1 == pytest.approx((2 / 3 + 0 + 2 / 3 + 0) / 4, abs=1e-6)


def test_curve_starts_at_zero_and_takes_any_score(spark):
    """Scores far outside [0, 1] and nine tenths of them equal to three digits: points equal a plain running count."""
    rows = []
    for i in range(2000):
        s = 0.900 + i * 1e-7 if i % 10 else -5.0 + i
        rows.append((i, i % 2, s, 1.0 - s, 0.5))
    df = spark.createDataFrame(rows, "doc_id bigint, y_true int, p0 double, p1 double, p2 double")
    got = [(r.threshold, r.tpr, r.fpr) for r in M.roc_curve(df).where("cls = 0").orderBy(F.desc("tpr"), F.desc("fpr")).collect()]
    want = [(float("inf"), 0.0, 0.0)]
    tp = fp = 0
    for s in sorted({r[2] for r in rows}, reverse=True):
        tp += sum(1 for r in rows if r[2] == s and r[1] == 0)
        fp += sum(1 for r in rows if r[2] == s and r[1] != 0)
        want.append((round(s, 6), round(tp / 1000, 6), round(fp / 1000, 6)))
    got, want = (sorted(rows, key=lambda x: (x[1], x[2])) for rows in (got, want))
    assert [x[1:] for x in got] == [x[1:] for x in want]
    assert all(a[0] == b[0] or abs(a[0] - b[0]) < 2e-6 for a, b in zip(got, want))


def test_buckets_of_close_scores_are_small(spark):
    from reviewlens.operators.features import quantile_bucket
    n = 20_000
    df = spark.range(n).select((F.when(F.col("id") % 10 > 0, 0.9 + F.col("id") * 1e-8).otherwise(F.col("id") / n)).alias("score"))
    most = quantile_bucket(df, "score", "b").groupBy("b").count().agg(F.max("count")).first()[0]
    assert most < 0.01 * n
