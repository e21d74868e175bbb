"""File-format fixtures (FIXTURES.md): JSON lines with junk, gzip, JSON array, CSV with quotes/newlines."""

import gzip
import json
import os

from reviewlens.sources import readers as IO

GOOD = [{"text": "great album", "overall": 5.0, "extra": 1}, {"text": "meh", "overall": 3.0},
        {"text": "no rating here"}]
BAD = ["", '{"text": "trunc', "[1]"]


def write_jsonl(path, gz=False):
    lines = [json.dumps(r) for r in GOOD] + BAD
    data = "\n".join(lines) + "\n"
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(data)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(data)


def check(df):
    rows = sorted((r.review_text, r.rating) for r in df.select("review_text", "rating").collect())
    assert rows == sorted([("great album", 5.0), ("meh", 3.0), ("no rating here", None)])


def test_jsonl_and_gzip(spark, tmp_path):
    p = str(tmp_path / "r.jsonl")
    write_jsonl(p)
    check(IO.read_reviews(spark, p))
    g = str(tmp_path / "r.jsonl.gz")
    write_jsonl(g, gz=True)
    df = IO.read_reviews(spark, g)
    check(df)
    assert "extra" in df.columns  # unknown keys pass through


def test_json_array_document(spark, tmp_path):
    p = str(tmp_path / "r.json")
    with open(p, "w") as f:
        json.dump(GOOD, f, indent=2)
    check(IO.read_reviews(spark, p))


def test_csv_quotes_newlines(spark, tmp_path):
    p = str(tmp_path / "r.csv")
    with open(p, "w") as f:
        f.write('text,overall\n"line one\nline two, ""quoted""",4.0\n"   ",2.0\n')
    rows = sorted((r.review_text, r.rating) for r in IO.read_reviews(spark, p, schema="text string, overall double")
                  .collect())
    assert rows == sorted([('line one\nline two, "quoted"', 4.0), ("   ", 2.0)])


def test_unknown_suffix_falls_back(spark, tmp_path):
    p = str(tmp_path / "r.data")
    write_jsonl(p)
    check(IO.read_reviews(spark, p))
    c = str(tmp_path / "c.data")
    with open(c, "w") as f:
        f.write("review_text,rating\nfine,4.0\n")
    assert IO.read_reviews(spark, c).count() == 1


def test_stage_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,\"b\"\nc", 1.0)], "doc_id long, t string, r double")
    out = str(tmp_path / "stage")
    IO.write_stage(df, out, fmt="csv")
    back = IO.read_stage(spark, out, fmt="csv", schema="doc_id long, t string, r double").collect()
    assert [tuple(r) for r in back] == [(1, "a,\"b\"\nc", 1.0)]
    assert os.path.isdir(out)


def test_corrupt_count(spark, tmp_path):
    p = str(tmp_path / "r.jsonl")
    write_jsonl(p)
    assert IO.corrupt_count(spark, p) == 2  # truncated object and the non-object line; blank lines are skipped
