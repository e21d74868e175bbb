"""Streaming extension: clean over a file stream equals the batch clean; windowed counts equal a batch group-by."""

import datetime as dt

from pyspark.sql import functions as F

from reviewlens.functions import text as X
from reviewlens.streaming import streams as ST


def test_clean_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [(1, "Don't <br>go!!", 5.0), (2, None, 1.0), (3, "Fine 42 times", 3.0)]
    spark.createDataFrame(rows, "doc_id long, text string, overall double").write.json(src)
    out = {r.doc_id: (r.clean_text, r.sentiment)
           for r in ST.clean_stream(spark, src, "doc_id long, text string, overall double").collect()}
    assert out == {1: ("do not go", "positive"), 3: ("fine times", "neutral")}


def test_windowed_counts(spark, tmp_path):
    src = str(tmp_path / "ev")
    t0 = dt.datetime(2024, 1, 1, 5)
    rows = [(i, t0 + dt.timedelta(hours=7 * i), "a" if i % 3 else "b") for i in range(20)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string")
    df.write.parquet(src)
    got = {(r.window_start, r.event_type): r.cnt
           for r in ST.windowed_counts(spark, src, "event_id long, ts timestamp, event_type string").collect()}
    exp = {(r.d, r.event_type): r.c for r in df.groupBy(
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("d"), "event_type")
        .agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == exp
