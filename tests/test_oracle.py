"""Catalogue queries against their DuckDB twins on the smallest scale factor."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from reviewlens.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"
NAMES = ["top_ngrams_by_class", "clean_reviews", "length_summary", "duplicate_marks", "split_exact", "split_stratified",
         "metrics_basic", "roc_auc", "class_report", "vocab_by_freq", "tfidf", "text_stats_scaled", "confusion_norm"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    got = Counter(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in sorted(cols)]
    exp = Counter(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sentiment", "n", "rnk", "ngram", "cnt"]
