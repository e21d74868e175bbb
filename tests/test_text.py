"""Golden rows for the native text functions (FIXTURES edge rows) and properties."""

import re

from pyspark.sql import functions as F

from reviewlens.functions import labels as L
from reviewlens.functions import text as X


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_clean_golden(spark):
    assert one(spark, X.clean_text, "Don't <br>visit http://x.y/1 2day_ OK!!") == "do not visit day_ ok"


def test_clean_contractions_and_html(spark):
    assert one(spark, X.clean_text, "I won't go, it's late &amp; they're <b>tired</b>") == \
        "i will not go it is late they are tired"
    assert one(spark, X.clean_text, "<script>var a='<p>';</script>a<br>b") == "a b"


def test_clean_references_and_typographic_apostrophes(spark):
    assert one(spark, X.clean_text, "I don\u2019t, a < b and c > d &eacute; &#8217;") == "i do not a b and c d \u00e9"
    assert one(spark, X.clean_text, "It\u2019s &Eacute;t&#233; &#xE9;t&#XE9 won\u2019t John\u2019s") == \
        "it is \u00e9t\u00e9 \u00e9t\u00e9 will not john s"


def test_references_decode_once(spark):
    import html
    cases = ["&amp;lt;", "&amp;amp;", "&zzname; &", "a&nbsp;b", "&#0;&#55296;&#1114112;", "&#128;&#146;&#x97;",
             "&NotEqualTilde;x", "", "&;&#;&#x;", "&lt;b&gt;&quot;&apos;&#39;", "\U0001F600&#128512;"]
    for v in cases:
        assert one(spark, X.decode_references, v) == html.unescape(v), v
    assert one(spark, X.strip_html, None) is None
    assert one(spark, X.strip_html, "1 < 2 <!doctype x><?pi?></p>3") == "1 < 2    3"


def test_references_match_twin(spark):
    import duckdb
    from reviewlens.plans import sqltext as S
    v = "x &eacute;&#233;&#xE9;&#128;&#0; &amp;lt; &unknown; &NotEqualTilde; < 3 <b>y</b> don\u2019t"
    got = duckdb.execute(f"select {S.clean_text('v')}, {S.strip_html('v')} from (select ? as v)", [v]).fetchone()
    assert got == (one(spark, X.clean_text, v), one(spark, X.strip_html, v))


def test_cleaners_are_plug_ins(spark):
    assert one(spark, lambda c: X.clean_text(c, html=lambda x: x, contractions=F.upper), "<B>don't</B>") == "b don't b"


def test_clean_idempotent(spark):
    df = spark.createDataFrame([("Ça   va? Très\tbien!! 42 www.x.org",), ("  ",), ("",)], "v string")
    once = df.select(X.clean_text("v").alias("c"))
    twice = once.select(X.clean_text("c").alias("c"))
    assert [r.c for r in once.collect()] == [r.c for r in twice.collect()]
    assert once.first().c == "ça va très bien"


def test_tokenise_unicode(spark):
    assert one(spark, X.word_tokens, "Été_1 déjà-vu") == ["été_1", "déjà", "vu"]


def test_tokens_match_python(spark):
    texts = ["Hello,  wörld_2   x\x0by", "ÀB-cd 12 e f", ""]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.t for r in df.select(X.word_tokens("v").alias("t")).collect()]
    assert got == [re.findall(r"\b\w+\b", t.lower()) for t in texts]
    ws = [r.t for r in df.select(X.ws_tokens(F.col("v")).alias("t")).collect()]
    assert ws == [t.split() for t in texts]


def test_bigrams_short_docs(spark):
    df = spark.createDataFrame([(["one"],), ([],), (["a", "b", "c"],)], "t array<string>")
    got = [r.g for r in df.select(X.ngrams("t", 2).alias("g")).collect()]
    assert got == [[], [], ["a b", "b c"]]


def test_rating_labels(spark):
    cases = [(1.0, "negative"), (2.0, "negative"), (3.0, "neutral"), (4.0, "positive"), (4.5, "positive"),
             (5.0, "positive"), (0.0, "neutral"), (6.0, "neutral"), (None, "neutral"), (float("nan"), "neutral"),
             (float("inf"), "neutral")]
    df = spark.createDataFrame([(v,) for v, _ in cases], "r double")
    assert [r.s for r in df.select(L.sentiment("r").alias("s")).collect()] == [s for _, s in cases]
    sdf = spark.createDataFrame([("4.0",), ("x",), ("4",)], "r string")
    assert [r.s for r in sdf.select(L.sentiment("r").alias("s")).collect()] == ["neutral", "neutral", "positive"]


def test_sentiment_codes(spark):
    df = spark.createDataFrame([("negative",), ("neutral",), ("positive",), ("other",)], "s string")
    rows = df.select(L.sentiment_code("s", 1).alias("a"), L.sentiment_code("s", None).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(0, 0), (1, 1), (2, 2), (1, None)]
