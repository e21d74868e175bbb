"""Corpus profiling (A-01..A-14, W-01..W-04, D-01..D-03, P-15, R-01..R-03).

Every finding is one aggregate job over a shared working set.  Group-bys use
partial (map-side) aggregation, so a class or rating holding a third of the
rows costs one partial row per task, not one hot reducer.  Top-k per group
uses ``row_number() <= k``, which Spark plans as a partial WindowGroupLimit
before the shuffle (at most k rows per group leave each task).
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import text as X
from reviewlens.functions.columns import with_computed
from reviewlens.functions.labels import sentiment
from reviewlens.operators import clean as C
from reviewlens.operators import rank as R

SENTIMENT_ORDER = {"negative": 0, "neutral": 1, "positive": 2}
N_BINS = 50


def english_stop_words() -> list[str]:
    """R-01: Spark's built-in English stop-word list (``StopWordsRemover`` default).

    Kept as a fixed-value file so the SQL oracle can use it without a JVM.
    """
    with open(os.path.join(os.path.dirname(X.__file__), "stopwords_english.txt"), encoding="utf-8") as f:
        return [w for w in f.read().split("\n") if w]


# A-01 / A-02 -------------------------------------------------------------------
def inspect_nulls(df: DataFrame) -> DataFrame:
    """Per column: dtype, null count, null % (2 dp; NULL for an empty frame), row count.

    One aggregate pass, unpivoted with ``stack``.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    pairs = ", ".join(f"'{c}', '{dtypes[c]}', _z{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_n", f"stack({len(cols)}, {pairs}) as (column_name, dtype, null_count)")
    pct = F.when(F.col("_n") > 0, F.round(F.col("null_count") * 100.0 / F.col("_n"), 2))
    return long.select("column_name", "dtype", F.col("null_count").cast("bigint").alias("null_count"),
                       pct.alias("null_pct"), F.col("_n").alias("n_rows"))


# A-03 / W-04 -----------------------------------------------------------------
def duplicate_count(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` repeats an earlier row's (nulls equal each other, first kept)."""
    c = F.col(col)
    return df.agg((F.count(F.lit(1)) - F.count_distinct(c) - F.max(c.isNull().cast("int"))).alias("n_duplicates"),
                  F.count(F.lit(1)).alias("n_rows"))


def duplicate_marks(df: DataFrame, col: str, key: str) -> DataFrame:
    """Each row with ``is_duplicate`` = its key is not the smallest among equal ``col`` values.

    A group-by on the value (partial min map-side) joined back; not a window
    partitioned by the value, which would put a hot text in one task.  The
    join key is the value itself; AQE's skew join splits a hot partition.
    """
    firsts = df.groupBy(col).agg(F.min(key).alias("_first"))
    j = df.join(firsts, df[col].eqNullSafe(firsts[col]), "inner")
    return j.select(df[key], (df[key] != F.col("_first")).alias("is_duplicate"))


# D-01 -------------------------------------------------------------------------
def work_set(df: DataFrame, text_col: str = "clean_text", sentiment_col: str = "sentiment",
             rating_col: str = "rating", key: str | None = "doc_id", max_sample: int | None = None,
             seed: int = R.DEFAULT_SEED) -> DataFrame:
    """P-04 + P-05 + F-09 (+ T-01 if ``max_sample``)."""
    keep = ([key] if key else []) + [text_col, sentiment_col, rating_col]
    w = C.non_blank(C.keep_columns(df, keep), text_col)
    w = w.withColumn("char_len", X.char_len(text_col)).withColumn("word_len", X.word_len(text_col))
    if max_sample:
        w = R.sample_exact(w, max_sample, key, seed)
    return w


# A-04 / A-05 --------------------------------------------------------------------
def class_distribution(work: DataFrame, sentiment_col: str = "sentiment") -> DataFrame:
    order = F.coalesce(*[F.when(F.col(sentiment_col) == k, F.lit(v)) for k, v in SENTIMENT_ORDER.items()],
                       F.lit(len(SENTIMENT_ORDER)))
    return (work.groupBy(sentiment_col).agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("class_order", order.cast("int")))


def rating_distribution(work: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Counts per rating value (nulls dropped, as value_counts does)."""
    return work.where(F.col(rating_col).isNotNull()).groupBy(rating_col).agg(F.count(F.lit(1)).alias("cnt"))


# A-06 / P-15 ---------------------------------------------------------------------
def length_summary(work: DataFrame) -> DataFrame:
    """min, max, mean (1 dp), exact median and display cap max(p99, floor) for chars and words.

    One pass computes both kinds, then ``stack`` makes two rows.  ``percentile``
    keeps a value->count map per task; lengths are integers with few distinct
    values, so the partial buffers stay small.
    """
    aggs = []
    for c, floor in (("char_len", 100.0), ("word_len", 50.0)):
        aggs += [F.min(c).cast("bigint").alias(f"{c}_min"), F.max(c).cast("bigint").alias(f"{c}_max"),
                 F.round(F.avg(c), 1).alias(f"{c}_mean"), F.percentile(F.col(c), F.lit(0.5)).alias(f"{c}_med"),
                 F.greatest(F.percentile(F.col(c), F.lit(0.99)), F.lit(floor)).alias(f"{c}_cap")]
    wide = work.agg(*aggs)
    parts = ", ".join(f"'{k}', {c}_min, {c}_max, {c}_mean, {c}_med, {c}_cap"
                      for k, c in (("char", "char_len"), ("word", "word_len")))
    return wide.selectExpr(f"stack(2, {parts}) as (kind, min_len, max_len, mean_len, median_len, display_cap)")


def length_by_rating(work: DataFrame, rating_col: str = "rating") -> DataFrame:
    """A-07: words per rating (null rating dropped)."""
    return (work.where(F.col(rating_col).isNotNull()).groupBy(rating_col)
            .agg(F.avg("word_len").alias("mean_words"), F.percentile(F.col("word_len"), F.lit(0.5)).alias("median_words"),
                 F.count(F.lit(1)).alias("cnt")))


# A-09 / A-10 ---------------------------------------------------------------------
def length_counts(work: DataFrame, col: str) -> DataFrame:
    """The one heavy pass: rows per distinct length (partial aggregation; few distinct values)."""
    return work.groupBy(F.col(col).alias("len")).agg(F.count(F.lit(1)).alias("n"))


def _histogram(lens: DataFrame, n_bins: int):
    spark = lens.sparkSession
    st = lens.agg(F.struct(F.min("len").alias("lo"), F.max("len").alias("hi"))).scalar()
    lo, hi = st.getField("lo"), st.getField("hi")
    width = (hi - lo).cast("double")
    pos = F.when(width > 0, F.floor((F.col("len") - lo) / width * n_bins) + 1).otherwise(F.lit(1))
    binned = (lens.select(F.least(pos, F.lit(n_bins)).cast("int").alias("bin"), "n")
              .groupBy("bin").agg(F.sum("n").alias("cnt")))
    grid = spark.range(1, n_bins + 1).select(F.col("id").cast("int").alias("bin"))
    w = width / n_bins
    hist = (grid.join(binned, "bin", "left")
            .select("bin", F.round(lo + (F.col("bin") - 1) * w, 6).alias("bin_start"),
                    F.round(lo + F.col("bin") * w, 6).alias("bin_end"),
                    F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint").alias("cnt")))
    return hist, lo, hi


def length_histogram(work: DataFrame, col: str = "char_len", n_bins: int = N_BINS) -> DataFrame:
    """50 equal-width bins over [min, max], right edge in the last bin, empty bins kept."""
    return _histogram(length_counts(work, col), n_bins)[0]


def length_kde(work: DataFrame, col: str = "char_len", n_grid: int = 100) -> DataFrame:
    """A-10: Gaussian KDE (Scott bandwidth) over all lengths, on a grid of ``n_grid`` points from least to greatest.

    Equal lengths count together: each distinct length adds its kernel, times its count, to every grid point, and a
    group-by on the grid point sums them map-side.  Two lengths or more are needed; one has no spread.
    """
    lens = length_counts(work, col)
    x = F.col("len").cast("double")
    mom = lens.agg(F.struct(F.sum("n").alias("n"), F.sum(F.col("n") * x).alias("s1"),
                            F.sum(F.col("n") * x * x).alias("s2"), F.min("len").alias("lo"), F.max("len").alias("hi"))).scalar()
    n, s1, s2, lo, hi = (mom.getField(f) for f in ("n", "s1", "s2", "lo", "hi"))
    bw = F.sqrt((s2 - s1 * s1 / n) / (n - 1)) * F.pow(n.cast("double"), F.lit(-0.2))
    step = (hi - lo).cast("double") / (n_grid - 1)
    d = lens.select("n", x.alias("_x"), lo.cast("double").alias("_lo"), step.alias("_step"), bw.alias("_bw"),
                    n.cast("double").alias("_all"))
    at = F.col("_lo") + F.col("grid") * F.col("_step")
    kernel = F.exp(F.lit(-0.5) * F.pow((at - F.col("_x")) / F.col("_bw"), 2)) / (F.col("_bw") * math.sqrt(2 * math.pi))
    each = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))).alias("grid"))
    return each.groupBy("grid").agg(F.sum(F.col("n") * kernel / F.col("_all")).alias("_d")).select(
        F.col("grid").cast("int").alias("grid"), F.round(lo + F.col("grid") * step, 6).alias("x"),
        F.round(F.col("_d"), 9).alias("density"))


# Counts that several findings read -----------------------------------------------------
def _bits(c: str) -> Column:
    """Class of counts, the greater the higher; null for none."""
    return F.floor(F.log2(F.col(c).cast("double"))).cast("int")


@dataclass(frozen=True)
class Counts:
    """How often each gram occurs, from one pass over the texts, for several findings.

    ``table`` is written: ``ngram, n, cnt`` and for each class its own count, in a column of ``columns``.  ``sizes`` has the
    number of grams by column, n and class of counts: at most 64 numbers each, on the driver.
    """

    table: DataFrame
    columns: dict[str, str]
    sizes: dict

    def enough(self, column: str, k: int) -> Column:
        """Holds for the k most frequent grams of each n, with ties, and for few others, so that those alone are sorted."""
        found = F.lit(False)
        for n in {n for c, n in self.sizes if c == column}:
            above = 0
            for floor, grams in sorted(self.sizes[column, n].items(), reverse=True):
                above += grams
                if above >= k:
                    break
            found = found | ((F.col("n") == n) & (_bits(column) >= floor))
        return F.coalesce(found, F.lit(False))

    def by_class(self, k: int, sentiment_col: str = "sentiment") -> DataFrame:
        """``sentiment, n, ngram, cnt``: at least the k most frequent grams of each class and n."""
        some = reduce(lambda x, y: x | y, [self.enough(c, k) for c in self.columns.values()])
        each = F.array(*[F.struct(F.lit(name).alias(sentiment_col), F.col(c).alias("cnt")) for name, c in self.columns.items()])
        return self.table.where(some).select("n", "ngram", F.explode(each).alias("_e")).select(
            f"_e.{sentiment_col}", "n", "ngram", "_e.cnt").where("cnt > 0")


def _counts(tokens: DataFrame, name: str, sentiment_col: str) -> Counts:
    """``Counts`` of ``tokens`` (sentiment, ngram, one row an occurrence): one shuffle, by the gram, for all rows and every class."""
    from reviewlens.session import stage
    columns = {c: f"in_{i}" for i, c in enumerate(SENTIMENT_ORDER)}
    table = stage(tokens.groupBy("ngram").agg(
        F.count(F.lit(1)).alias("cnt"), *[F.count_if(F.col(sentiment_col) == c).alias(i) for c, i in columns.items()]).withColumn(
        "n", F.size(F.split("ngram", " "))), name)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _bits(c).alias("bits")) for c in ("cnt", *columns.values())]))
    sizes: dict = {}
    for r in table.select("n", each.alias("_e")).where("_e.bits is not null").groupBy("_e.column", "n", "_e.bits").count().collect():
        sizes.setdefault((r.column, r.n), {})[r.bits] = r["count"]
    return Counts(table, columns, sizes)


def shared_grams(work: DataFrame, ns=(1, 2), text_col: str = "clean_text", sentiment_col: str = "sentiment") -> Counts:
    """Counts of word n-grams of all orders; classes are those of ``SENTIMENT_ORDER``."""
    toks = with_computed(work.select(sentiment_col, text_col), _toks=X.word_tokens(F.col(text_col)))
    return _counts(toks.select(sentiment_col, F.explode(F.concat(*[X.ngrams("_toks", n) for n in ns])).alias("ngram")),
                   "grams", sentiment_col)


def shared_words(work: DataFrame, text_col: str = "clean_text", sentiment_col: str = "sentiment") -> Counts:
    """Counts of whitespace tokens."""
    return _counts(work.select(sentiment_col, F.explode(X.ws_tokens(F.col(text_col))).alias("ngram")), "words", sentiment_col)


# A-08 / A-14 -----------------------------------------------------------------------
def vocab_stats(work: DataFrame, text_col: str = "clean_text", words: Counts | None = None) -> DataFrame:
    """Whitespace tokens of the lowercased text: distinct, total, per doc (1 dp), in one pass.

    ``posexplode_outer`` keeps one row for a token-less document, so documents
    are counted as rows with position 0 or no position.  ``words`` are the text's ``shared_words``, else they are counted here.
    """
    if words is not None:
        tokens = words.table.agg(F.count_distinct(F.lower("ngram")).alias("vocab_size"),
                                 F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_tokens"))
        return tokens.crossJoin(work.agg(F.count(F.lit(1)).alias("n_docs"))).withColumn(
            "avg_tokens_per_doc", F.round(F.col("total_tokens") / F.col("n_docs"), 1))
    toks = work.select(F.posexplode_outer(X.ws_tokens(F.lower(F.col(text_col)))).alias("pos", "tok"))
    return (toks.agg(F.count_distinct("tok").alias("vocab_size"), F.count("tok").alias("total_tokens"),
                     F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("n_docs"))
            .withColumn("avg_tokens_per_doc", F.round(F.col("total_tokens") / F.col("n_docs"), 1)))


# A-11 / A-12 / W-01 / W-02 --------------------------------------------------------------
def ngram_counts(work: DataFrame, n: int, text_col: str = "clean_text", by: list[str] | None = None) -> DataFrame:
    # Tokens get their own projection: ngrams() reads the array several times
    # and Catalyst keeps a multiply-referenced expensive column materialised.
    toks = with_computed(work.select(*(by or []), text_col), _toks=X.word_tokens(F.col(text_col)))
    return (toks.select(*(by or []), F.explode(X.ngrams("_toks", n)).alias("ngram"))
            .groupBy(*(by or []), "ngram").agg(F.count(F.lit(1)).alias("cnt")))


def top_ngrams(work: DataFrame, n: int, k: int = 20, text_col: str = "clean_text", grams: Counts | None = None) -> DataFrame:
    """T-03: corpus top-k n-grams, ties by n-gram ascending; of ``grams``, if they are counted already (``shared_grams``)."""
    if grams is not None:
        counts = grams.table.where(F.col("n") == n).where(grams.enough("cnt", k)).select("ngram", "cnt")
    else:
        counts = ngram_counts(work, n, text_col)
    return counts.orderBy(F.col("cnt").desc(), F.col("ngram")).limit(k)


def top_k_per_group(counts: DataFrame, group: str, k: int, value: str = "ngram") -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col("cnt").desc(), F.col(value))
    return counts.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= k)


def top_ngrams_by_class(work: DataFrame, ns=(1, 2), k: int = 5, text_col: str = "clean_text",
                        sentiment_col: str = "sentiment", grams: Counts | None = None) -> DataFrame:
    """A-12 + W-01: per class and n, the k most frequent n-grams, all n in one pass.

    Grams of every order go through one ``explode``; the order of a gram is
    its number of spaces + 1 (tokens never contain a space), so no per-gram
    struct is built.  ``grams`` are the ``shared_grams`` of the same orders, else they are counted here.
    """
    if grams is not None:
        counts = grams.by_class(k, sentiment_col).where(F.col("n").isin(*ns))
    else:
        toks = with_computed(work.where(F.col(sentiment_col).isNotNull()).select(sentiment_col, text_col),
                             _toks=X.word_tokens(F.col(text_col)))
        every = F.concat(*[X.ngrams("_toks", n) for n in ns])
        counts = (toks.select(sentiment_col, F.explode(every).alias("ngram"))
                  .groupBy(sentiment_col, "ngram").agg(F.count(F.lit(1)).alias("cnt"))
                  .withColumn("n", (F.size(F.split(F.col("ngram"), " ")) ).cast("int")))
    w = Window.partitionBy(sentiment_col, "n").orderBy(F.col("cnt").desc(), F.col("ngram"))
    return (counts.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= k)
            .select(sentiment_col, "n", "rnk", "ngram", "cnt"))


def cloud_terms(work: DataFrame, per_class: int | None = None, k: int = 100, text_col: str = "clean_text",
                sentiment_col: str = "sentiment", key: str = "doc_id", seed: int = R.DEFAULT_SEED,
                words: Counts | None = None) -> DataFrame:
    """W-02/W-03/R-01: top-k non-stop words per class, over all docs or a seeded sample of <= per_class docs a class.

    Over all docs, ``words`` may be their ``shared_words``; stop words take at most their own number of places there.
    """
    sample = work.where(F.col(sentiment_col).isNotNull())
    if per_class is not None:
        sample = R.exact_rank(sample, key, seed, partition_by=[sentiment_col], rank_col="_r").where(F.col("_r") <= per_class)
    stop_words = english_stop_words()
    stops = work.sparkSession.createDataFrame([(w,) for w in stop_words], "ngram string")
    if words is not None and per_class is None:
        counts = words.by_class(k + len(stop_words), sentiment_col).join(F.broadcast(stops), "ngram", "left_anti")
        return top_k_per_group(counts, sentiment_col, k).select(sentiment_col, "rnk", "ngram", "cnt")
    toks = sample.select(sentiment_col, F.explode(X.ws_tokens(F.col(text_col))).alias("ngram"))
    toks = toks.join(F.broadcast(stops), "ngram", "left_anti")  # fixed 181-word list
    counts = toks.groupBy(sentiment_col, "ngram").agg(F.count(F.lit(1)).alias("cnt"))
    return top_k_per_group(counts, sentiment_col, k).select(sentiment_col, "rnk", "ngram", "cnt")


def cloud_doc_counts(work: DataFrame, per_class: int | None = None, sentiment_col: str = "sentiment") -> DataFrame:
    """D-03: docs per class that the cloud reads: the class size, or least(class size, per_class)."""
    n = F.count(F.lit(1)) if per_class is None else F.least(F.count(F.lit(1)), F.lit(per_class))
    return work.where(F.col(sentiment_col).isNotNull()).groupBy(sentiment_col).agg(n.alias("n_docs"))


# R-02 / R-03 --------------------------------------------------------------------
def length_rating_corr(work: DataFrame, rating_col: str = "rating") -> DataFrame:
    return work.where(F.col(rating_col).isNotNull()).agg(
        F.round(F.corr(F.col("word_len").cast("double"), F.col(rating_col)), 6).alias("corr_words_rating"),
        F.round(F.corr(F.col("char_len").cast("double"), F.col(rating_col)), 6).alias("corr_chars_rating"))


def data_quality(reviews: DataFrame, text_col: str = "review_text", rating_col: str = "rating") -> DataFrame:
    """Per label: rows, null texts, blank texts, texts with a contraction, mean raw length."""
    lab = F.coalesce(F.col("sentiment"), F.lit("unknown"))
    t = F.col(text_col)
    has_contr = F.coalesce(t.rlike(X.CONTRACTION_PROBE), F.lit(False))
    blank = t.isNotNull() & (F.length(F.regexp_replace(t, X.WS_RUN, "")) == 0)
    return (reviews.withColumn("sentiment", sentiment(F.col(rating_col))).groupBy(lab.alias("sentiment"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(t.isNull()).alias("null_texts"),
                 F.count_if(blank).alias("blank_texts"), F.count_if(has_contr).alias("with_contraction"),
                 F.round(F.avg(F.length(t)), 4).alias("mean_chars")))
