"""Feature operators (X-01, X-02, X-06, X-09, X-11, X-12, F-20, F-21, A-13, A-14).

Sparse features stay in long form ``(doc_id, term, value)`` for SQL work, over
all terms unless the caller asks for a cap.  A vocabulary grows with the
data, so only its head is broadcast: at most ``HEAD_TERMS`` of the most
frequent terms, counted before (``lookup``); the tail meets its terms in a
hash join.  Learners read all terms through a fixed number of hashed slots
(``vectorize_hashed``), built in the JVM.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import text as X
from reviewlens.functions.columns import with_computed
from reviewlens.operators import rank as R

# Vectoriser defaults (CountVectorizer / TfidfVectorizer).
MIN_TOKEN = r"([\p{L}\p{N}_]{2,})"  # tokens of at least two word characters
MAX_LEN = 256
MIN_FREQ = 2
PAD, UNK = 0, 1

#: Rows of a vocabulary's head that may be broadcast, each term at most so many characters.
HEAD_TERMS, HEAD_CHARS = 50_000, 128
#: Slots that learners see.
SLOTS = 1 << 16


def vec_tokens(c) -> Column:
    """Vectoriser tokens: lowercased runs of >= 2 word characters."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(MIN_TOKEN), 1)


def doc_grams(docs: DataFrame, text_col: str, ngram_range=(1, 1), key: str = "doc_id",
              carry: list[str] | None = None) -> DataFrame:
    """(key, carry.., _g): every n-gram of each document, one array per row (evaluated once per row)."""
    lo, hi = ngram_range
    carry = list(carry or [])
    d = with_computed(docs.select(key, *carry, text_col), _t=vec_tokens(text_col)).select(key, *carry, "_t")
    return d.select(key, *carry, F.concat(*[X.ngrams("_t", n) for n in range(lo, hi + 1)]).alias("_g"))


def doc_terms(docs: DataFrame, text_col: str, ngram_range=(1, 1), key: str = "doc_id") -> DataFrame:
    """(key, term, tf): how often each document has each of its terms.

    Documents are dealt out by key before their terms are unrolled, so the count
    needs no exchange of (key, term) rows: text moves once, narrow.
    """
    d = docs.select(key, text_col).repartition(key)
    g = doc_grams(d, text_col, ngram_range, key).select(key, F.explode("_g").alias("term"))
    return g.groupBy(key, "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))


def term_stats(docs: DataFrame, text_col: str, ngram_range=(1, 1), key: str = "doc_id") -> DataFrame:
    """(term, freq, df): corpus frequency and document frequency of every term, combined map-side."""
    return doc_terms(docs, text_col, ngram_range, key).groupBy("term").agg(
        F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df"))


def top_vocabulary(stats: DataFrame, max_features: int | None = None) -> DataFrame:
    """Vocabulary with freq, df and a 0-based ``index`` in ascending order of the terms; written.

    ``max_features`` keeps the most frequent terms (ties: term ascending) by an exact
    distributed rank over buckets of (-freq, first two characters); None keeps all.
    """
    from reviewlens.session import stage
    st = stats.select("term", "freq", "df")
    if max_features is not None:
        st = stage(st, "term-stats")
        bucket = F.struct((-F.col("freq")).alias("f"), F.substring("term", 1, 2).alias("p"))
        r = R.prefix_sums(st, bucket, [F.col("freq").desc(), F.col("term")], {"_r": F.lit(1).cast("bigint")},
                          coarse=lambda b: b.getField("f"))
        st = r.where(F.col("_r") <= max_features).drop("_r")
    return stage(R.sorted_index(st, "term", "index"), "vocabulary")


def lookup(rows: DataFrame, vocab: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """``rows`` (with ``term``) joined with ``cols`` of a written vocabulary (term, freq, ...).

    The head of the vocabulary, found by counting terms of at least 2**k occurrences, holds most of the rows and
    is broadcast: at most ``HEAD_TERMS`` rows.  What it does not know meets the rest in a hash join, where no term is
    frequent enough to be a hot key.  ``how`` is inner or left.
    """
    short = F.length("term") <= HEAD_CHARS
    sizes = vocab.agg(F.count(F.lit(1)), *[F.count_if(short & (F.col("freq") >= 2 ** k)) for k in range(48)]).first()
    if sizes[0] <= HEAD_TERMS and sizes[1] == sizes[0]:
        return rows.join(F.broadcast(vocab.select("term", *cols)), "term", how)
    k = next((i for i, n in enumerate(sizes[1:]) if n <= HEAD_TERMS), 48)
    is_head = short & (F.col("freq") >= 2 ** k)
    head = vocab.where(is_head).select("term", *cols, F.lit(True).alias("_head"))
    j = rows.join(F.broadcast(head), "term", "left")
    rest = j.where(F.col("_head").isNull()).select(*rows.columns).join(
        vocab.where(~is_head).select("term", *cols), "term", how)
    return j.where(F.col("_head")).drop("_head").unionByName(rest)


def _fit(docs: DataFrame, fit: Column | None) -> DataFrame:
    return docs if fit is None else docs.where(fit)


#: Characters of text in one part of the documents, whose terms are counted and looked up together.
PART_CHARS = 16_000_000


def known_terms(docs: DataFrame, text_col: str, fit: Column | None, max_features: int | None, ngram_range, key: str,
                numbered: bool, carry: list[str] | None = None, weight: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(key, carry.., term[, index], value) of all documents for the terms that ``fit`` documents have; vocabulary.

    ``value`` is the term's count in the document or, with a ``weight`` of ``df``, the count times the weight over the norm of the key's
    rows.  Documents are dealt into parts of ``PART_CHARS`` characters.  What leaves a part is one row for each distinct term in it,
    with its counts; the totals come back the same way and meet the part's documents where they are: (document, term) rows
    never move.  Within a part grams are numbers (``grams``).  ``numbered`` adds the terms' ``index`` and gives the written
    vocabulary, else None.  ``carry`` are columns that the key determines.
    """
    from reviewlens.operators import grams as G
    from reviewlens.session import ship_package
    ship_package(docs.sparkSession)
    carry = list(carry or [])
    lo, hi = ngram_range
    chars = docs.agg(F.sum(F.length(text_col).cast("bigint"))).first()[0] or 0
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-chars // PART_CHARS))
    in_fit = F.lit(True) if fit is None else F.coalesce(fit, F.lit(False))
    d = docs.select(key, *carry, text_col, in_fit.alias("_fit"), F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("_part"))
    own = [key, *carry]
    # As one string: a list a row, null in the rows of terms, costs the writer of Arrow batches more than all that follows.
    tokens = F.nullif(F.array_join(vec_tokens(text_col), " "), F.lit("")).alias("_t")
    local = d.repartitionById(n, F.col("_part")).select("_part", "_fit", *own, tokens).mapInArrow(
        G.part_terms(own, lo, hi), "_part int, term string, freq double, df bigint")
    vocab = None
    numbered = numbered or max_features is not None
    if numbered:
        stats = local.groupBy("term").agg(F.sum("freq").alias("freq"), F.sum("df").alias("df")).where("df > 0")
        vocab = top_vocabulary(stats, max_features)
        known = local.select("_part", "term").join(vocab, "term")
    else:
        known = local.drop("freq").repartition(n, "term").mapInArrow(G.totals, "_part int, term string, df bigint")
    known = known.select("_part", "term", "df", *(["index"] if numbered else []))
    # A part's documents and its terms go to one task; texts are cut into tokens there.
    rows = d.drop("_fit").unionByName(known, allowMissingColumns=True).repartitionById(n, F.col("_part"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*own).schema)
    w = F.lit(1.0) if weight is None else weight
    out = rows.select("_part", *own, tokens, "term", w.alias("_w"), *(["index"] if numbered else [])).mapInArrow(
        G.part_rows(key, carry, lo, hi, weight is not None, numbered),
        f"{kinds}, term string, {'index bigint, ' if numbered else ''}value double")
    return out, vocab


def bow(docs: DataFrame, text_col: str, fit: Column | None = None, max_features: int | None = None,
        key: str = "doc_id", numbered: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """X-01: counts over the vocabulary of the ``fit`` documents (train only). Returns (long, vocabulary).

    Without ``numbered`` terms have no ``index`` and no vocabulary table is written.
    """
    out, vocab = known_terms(docs, text_col, fit, max_features, (1, 1), key, numbered)
    return out.select(key, "term", *(["index"] if numbered else []), F.col("value").alias("tf")), vocab


def tfidf(docs: DataFrame, text_col: str, fit: Column | None = None, max_features: int | None = None,
          ngram_range=(1, 2), key: str = "doc_id", numbered: bool = True,
          carry: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """X-02: smooth idf = ln((1+n)/(1+df)) + 1 from the fit documents; rows L2-normalised.

    Spark's ``IDF`` omits the ``+1`` (a term in every document weighs 0), so
    the weights are computed here from the terms' totals.  Without ``numbered`` terms have no ``index`` and no vocabulary
    table is written; ``carry`` are columns that the key determines.
    """
    n = _fit(docs, fit).agg(F.count(F.lit(1))).scalar()
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    rows, vocab = known_terms(docs, text_col, fit, max_features, ngram_range, key, numbered, carry, idf)
    out = rows.select(key, *(carry or []), "term", *(["index"] if numbered else []), F.col("value").alias("weight"))
    return out, None if vocab is None else vocab.withColumn("idf", idf)


def slot_of(term, slots: int | None = None) -> Column:
    """Hashed slot of a term."""
    return F.pmod(F.xxhash64(term), F.lit(slots or SLOTS)).cast("int")


def vectorize_hashed(docs: DataFrame, text_col: str, ngram_range=(1, 2), fit: Column | None = None, idf: bool = True,
                     out_col: str = "features", slots: int | None = None) -> DataFrame:
    """MLlib SparseVector per document over all its terms, in ``SLOTS`` hashed slots, built in the JVM.

    No term is left out and no vocabulary is taken to the driver; terms that share a slot (one in ``SLOTS`` for any two) are
    counted together.  With ``idf``: smooth idf by slot from the ``fit`` documents (one number a slot on the driver), rows
    L2-normalised; else plain counts.
    """
    import math

    from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    from reviewlens.session import stage
    slots = slots or SLOTS
    key = next(c for c in docs.columns if c != text_col)
    carry = [c for c in docs.columns if c not in (key, text_col)]
    lo, hi = ngram_range
    d = with_computed(docs, _t=vec_tokens(text_col))
    d = d.select(key, *carry, text_col, F.concat(*[X.ngrams("_t", n) for n in range(lo, hi + 1)]).alias("_g"))
    d = with_computed(d, _s=F.transform("_g", lambda g: slot_of(g, slots).cast("string"))).drop("_g")
    # A repeated key stands for every pair of its rows; with unique keys, the rule, no text moves.
    repeated = not docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    d = d.drop(text_col).join(docs.select(key, text_col), key) if repeated else d.where(F.col(key).isNotNull())
    # The slots' names cross to the JVM as one string: from_vocabulary sends them one by one.
    names = d.sparkSession.sparkContext._jvm.org.apache.commons.lang3.StringUtils.split(",".join(map(str, range(slots))), ",")
    cv = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", names)
    cv = cv.setInputCol("_s").setOutputCol("_tf" if idf else out_col)
    out = stage(cv.transform(d).drop("_s"), "slot-counts")  # read by the fit of the weights and by every pass of a learner
    if not idf:
        return out
    train = _fit(out, fit)
    n = train.count()
    # One number a slot: summed over as many parts as there are cores, whatever the rows.
    df = IDF(inputCol="_tf").fit(few_parts(train.select("_tf"))).docFreq if n else [0] * slots
    weights = [math.log((n + 1) / (x + 1)) + 1 for x in df]
    out = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_tf", outputCol="_w").transform(out)
    return Normalizer(p=2.0, inputCol="_w", outputCol=out_col).transform(out).drop("_tf", "_w")


def few_parts(df: DataFrame) -> DataFrame:
    """``df`` in at most as many parts as there are cores, without a shuffle.

    A pass of an iterative fit sends one dense gradient a part and one result a task, so its traffic grows with the parts:
    this bounds it whatever the rows.  Parts are streamed, none is held whole.
    """
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def vectorize(docs: DataFrame, text_col: str, vocab: DataFrame, ngram_range=(1, 2), idf: bool = True,
              out_col: str = "features") -> DataFrame:
    """MLlib SparseVector per document over a fitted capped vocabulary, built in the JVM.

    ``CountVectorizerModel.from_vocabulary`` counts terms in vocabulary-index
    order; for TF-IDF an ``ElementwiseProduct`` by the idf vector and a
    ``Normalizer(p=2)`` follow.  The vocabulary (<= max_features terms) is the
    only thing taken to the driver.
    """
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    rows = vocab.orderBy("index").select("term", *(["idf"] if idf else [])).collect()
    lo, hi = ngram_range
    d = with_computed(docs, _t=vec_tokens(text_col))
    d = d.withColumn("_grams", F.concat(*[X.ngrams("_t", n) for n in range(lo, hi + 1)])).drop("_t")
    cv = CountVectorizerModel.from_vocabulary([r.term for r in rows], inputCol="_grams",
                                              outputCol="_tf" if idf else out_col)
    out = cv.transform(d).drop("_grams")
    if not idf:
        return out
    out = ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]), inputCol="_tf",
                             outputCol="_w").transform(out)
    return Normalizer(p=2.0, inputCol="_w", outputCol=out_col).transform(out).drop("_tf", "_w")


def hashed_tfidf(docs: DataFrame, text_col: str, ngram_range=(1, 2), fit: Column | None = None,
                 key: str = "doc_id") -> DataFrame:
    """(key, index, value): the entries of ``vectorize_hashed``'s vectors in long form; written.

    With unique keys they are unrolled from the vectors where these are, without an exchange.  The texts of a repeated or null
    key are one document.
    """
    from reviewlens.session import stage
    if docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).isEmpty():
        others = [c for c in docs.columns if c not in (key, text_col)]
        d = docs.select(key, *others, F.coalesce(text_col, F.lit("")).alias(text_col))
        v = vectorize_hashed(d, text_col, ngram_range, fit, out_col="_vector")
        entries = F.unwrap_udt("_vector")
        return v.select(key, F.inline(F.arrays_zip(entries["indices"].alias("index"), entries["values"].alias("value")))).where(
            F.col("value") != 0)
    counts = doc_terms(docs, text_col, ngram_range, key).groupBy(key, slot_of(F.col("term")).alias("index")).agg(
        F.sum("tf").alias("tf"))
    fit_docs = _fit(docs, fit)
    n = fit_docs.agg(F.count(F.lit(1))).scalar()
    df = doc_terms(fit_docs, text_col, ngram_range, key).select(key, slot_of(F.col("term")).alias("index")).distinct().groupBy(
        "index").agg(F.count(F.lit(1)).alias("df"))  # at most SLOTS rows
    w = counts.join(F.broadcast(df), "index", "left").withColumn(
        "w", F.col("tf") * (F.log((n + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return stage(w.select(key, "index", (F.col("w") / norm).alias("value")), "hashed")


# X-06 ----------------------------------------------------------------------------------
def text_stats(df: DataFrame, text_col: str, key: str = "doc_id") -> DataFrame:
    """Char count, whitespace word count, mean word length, punctuation count, capital ratio (raw text)."""
    d = with_computed(df.select(key, text_col), _w=X.ws_tokens(F.col(text_col)))
    words = F.size("_w")
    word_chars = F.aggregate("_w", F.lit(0), lambda acc, t: acc + F.length(t))
    chars = F.length(text_col)
    return d.select(key, chars.cast("double").alias("char_count"), words.cast("double").alias("word_count"),
                    F.when(words > 0, word_chars / words).otherwise(0.0).alias("avg_word_len"),
                    X.punct_count(text_col).cast("double").alias("punct_count"),
                    F.when(chars > 0, X.upper_count(text_col) / chars).otherwise(0.0).alias("capital_ratio"))


STAT_COLS = ["char_count", "word_count", "avg_word_len", "punct_count", "capital_ratio"]


def standard_scale(df: DataFrame, fit: DataFrame, cols: list[str]) -> DataFrame:
    """X-09: (x - mean) / population std from ``fit`` (std 0 -> 1), as sklearn's StandardScaler."""
    st = fit.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                          *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])).scalar()
    out = df
    for i, c in enumerate(cols):
        s = st.getField(f"s{i}")
        out = out.withColumn(c, (F.col(c) - st.getField(f"m{i}")) / F.when(s == 0, 1.0).otherwise(s))
    return out


# X-11 / X-12 / A-13 / A-14 ---------------------------------------------------------------
def term_freq(df: DataFrame, text_col: str, min_freq: int = MIN_FREQ) -> DataFrame:
    """A-13: corpus frequency of word tokens, kept when >= min_freq (partial aggregation map-side)."""
    return (df.select(F.explode(X.word_tokens(F.col(text_col))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_freq))


def vocab_by_freq(df: DataFrame, text_col: str, min_freq: int = MIN_FREQ) -> DataFrame:
    """X-11 / W-06: ids 2.. by descending frequency, ties by term (0 = PAD, 1 = UNK).

    Exact distributed rank: buckets (-freq, first two characters) coarsen the
    order, so even a frequency shared by a third of the terms is spread.
    """
    from reviewlens.session import stage
    tf = stage(term_freq(df, text_col, min_freq), "term-freq")  # read by the bucket totals and the ranking
    bucket = F.struct((-F.col("freq")).alias("f"), F.substring("term", 1, 2).alias("p"))
    r = R.prefix_sums(tf, bucket, [F.col("freq").desc(), F.col("term")], {"_r": F.lit(1).cast("bigint")},
                      coarse=lambda b: b.getField("f"))
    return r.select("term", "freq", (F.col("_r") + 1).cast("int").alias("id"))


def quantile_bucket(df: DataFrame, col: str, out: str, n: int = 1024, rel_err: float = 0.001) -> DataFrame:
    """Range buckets from approximate quantiles (a bounded list on the driver), monotone in ``col``."""
    qs = df.approxQuantile(col, [i / n for i in range(1, n)], rel_err)
    splits = [float("-inf")] + sorted(set(float(q) for q in qs)) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol="_qb_in", outputCol=out)
    return b.transform(df.withColumn("_qb_in", F.col(col).cast("double"))).drop("_qb_in")


def vocab_first_seen(df: DataFrame, text_col: str, key: str = "doc_id", min_freq: int = MIN_FREQ) -> DataFrame:
    """X-12: ids 2.. in order of first occurrence (document key, then token position)."""
    toks = with_computed(df.select(key, text_col), _t=X.word_tokens(F.col(text_col)))
    ex = toks.select(key, F.posexplode("_t").alias("pos", "term"))
    first = (ex.groupBy("term").agg(F.count(F.lit(1)).alias("freq"), F.min(F.struct(key, "pos")).alias("_f"))
             .where(F.col("freq") >= min_freq).select("term", "freq", F.col(f"_f.{key}").alias("first_doc"),
                                                     F.col("_f.pos").alias("first_pos")))
    from reviewlens.session import stage
    first = stage(first, "first-seen")  # read by the quantiles, the bucket totals and the ranking
    b = quantile_bucket(first, "first_doc", "_qb")
    r = R.prefix_sums(b, F.col("_qb"), [F.col("first_doc"), F.col("first_pos")], {"_r": F.lit(1).cast("bigint")})
    return r.select("term", "freq", "first_doc", "first_pos", (F.col("_r") + 1).cast("int").alias("id"))


def encode_windows(df: DataFrame, vocab: DataFrame, text_col: str, key: str = "doc_id",
                   max_len: int = MAX_LEN) -> DataFrame:
    """F-20 / F-21 / J-03: ``key, window, length, ids``: all token ids of a text, ``max_len`` to a window.

    Unknown tokens are 1; the last window is padded on the right with 0, ``length`` counts its tokens.  A text
    without tokens has one window of padding.  Ids come from ``lookup``; a group is one window, so a text of any length is
    gathered in bounded pieces.
    """
    toks = with_computed(df.select(key, text_col), _t=X.word_tokens(F.col(text_col)))
    ex = toks.select(key, F.posexplode_outer("_t").alias("pos", "term"))
    empty = ex.where(F.col("pos").isNull()).select(
        key, F.lit(0).alias("window"), F.lit(0).alias("length"), F.array_repeat(F.lit(PAD), max_len).alias("ids"))
    j = lookup(ex.where(F.col("pos").isNotNull()), vocab, ["id"], "left")
    g = j.groupBy(key, F.floor(F.col("pos") / max_len).cast("int").alias("window")).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(UNK)).alias("id")))).alias("_p"))
    ids = F.transform("_p", lambda s: s.getField("id"))
    padded = F.concat(ids, F.array_repeat(F.lit(PAD), F.lit(max_len) - F.size(ids)))
    return g.select(key, "window", F.size("_p").alias("length"), padded.alias("ids")).unionByName(empty)


def encode_sequences(df: DataFrame, vocab: DataFrame, text_col: str, key: str = "doc_id",
                     max_len: int = MAX_LEN) -> DataFrame:
    """The first window alone: ``key, length, ids`` with at most ``max_len`` tokens, for models of one fixed length."""
    w = encode_windows(df, vocab.withColumn("freq", F.lit(1)) if "freq" not in vocab.columns else vocab, text_col, key, max_len)
    return w.where("window = 0").drop("window")


def token_stats(df: DataFrame, text_col: str, min_freq: int = MIN_FREQ) -> DataFrame:
    """A-14: vocabulary size incl. PAD and UNK, documents, mean tokens per document."""
    n_vocab = term_freq(df, text_col, min_freq).agg(F.count(F.lit(1))).scalar()
    return df.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size(X.word_tokens(F.col(text_col)))).alias("avg")).select(
        (n_vocab + 2).alias("vocab_size"), "n_docs", F.round("avg", 6).alias("avg_tokens_per_doc"))
