"""Named queries over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole tables (or views Spark derives from them); row
limits appear only where a top-k or a sample is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import labels as L
from reviewlens.functions import text as X
from reviewlens.operators import clean as C
from reviewlens.operators import eda as E
from reviewlens.operators import rank as R
from reviewlens.plans import fixtures as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def reviews(spark, sf) -> DataFrame:
    return C.canonicalize(V.reviews(spark, sf))


def cleaned(spark, sf) -> DataFrame:
    return C.clean_reviews(reviews(spark, sf))


def work(spark, sf) -> DataFrame:
    return E.work_set(cleaned(spark, sf))


def work_staged(spark, sf) -> DataFrame:
    """The working set written once, for queries that read it in several passes."""
    from reviewlens.session import stage
    return stage(work(spark, sf).select("doc_id", "clean_text", "sentiment", "rating", "char_len", "word_len"), "work")


# ------------------------------------------------------------------ EDA core
@query
def top_ngrams_by_class(spark, sf):
    """Flagship: top-5 words and bigrams per sentiment class (A-12, W-01)."""
    return E.top_ngrams_by_class(work(spark, sf), (1, 2), 5)


@query
def inspect_nulls(spark, sf):
    return E.inspect_nulls(reviews(spark, sf))


@query
def preview_rows(spark, sf):
    return (reviews(spark, sf).orderBy("doc_id").limit(10)
            .select("doc_id", X.truncate("review_text").alias("text_200"), "rating"))


@query
def sample_exact(spark, sf):
    s = R.sample_exact(reviews(spark, sf), 100, "doc_id")
    return s.select("doc_id", "rating", X.truncate("review_text").alias("text_200"))


@query
def null_drop(spark, sf):
    return C.drop_null_text(reviews(spark, sf)).select("doc_id", "review_text")


@query
def null_fill(spark, sf):
    return C.fill_null_text(reviews(spark, sf)).select("doc_id", "review_text")


@query
def clean_text(spark, sf):
    return cleaned(spark, sf).select("doc_id", "clean_text")


@query
def strip_html(spark, sf):
    pages = V.table(spark, sf, "pages")
    return pages.select("page_id", X.normalize_ws(X.strip_html("html")).alias("page_text"))


@query
def clean_reviews(spark, sf):
    return cleaned(spark, sf).select("doc_id", "rating", "clean_text", "sentiment")


@query
def sentiment_label(spark, sf):
    r = reviews(spark, sf)
    s = L.sentiment("rating")
    return r.select("doc_id", "rating", s.alias("sentiment"), L.sentiment_code(s, 1).alias("sentiment_code"))


@query
def sentiment_code(spark, sf):
    r = reviews(spark, sf)
    label = F.when(F.col("doc_id") % 5 == 0, F.lit("unknown")).otherwise(L.sentiment("rating"))
    return r.select("doc_id", label.alias("label")).select(
        "doc_id", L.sentiment_code("label", 1).alias("code_default"), L.sentiment_code("label", None).alias("code_strict"))


@query
def label_defaults(spark, sf):
    r = reviews(spark, sf)
    d = C.with_label_defaults(r.select("doc_id", F.col("rating").cast("float").alias("rating_f")))
    return d.select("doc_id", "sentiment", "rating", "rating_f")


@query
def text_lengths(spark, sf):
    return work(spark, sf).select("doc_id", "char_len", "word_len")


@query
def eda_work(spark, sf):
    return work(spark, sf).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("char_len").cast("bigint").alias("chars"),
                               F.sum("word_len").cast("bigint").alias("words"),
                               F.count_distinct("sentiment").alias("n_classes"))


@query
def class_distribution(spark, sf):
    return E.class_distribution(work(spark, sf))


@query
def rating_distribution(spark, sf):
    return E.rating_distribution(work(spark, sf))


@query
def length_summary(spark, sf):
    return E.length_summary(work(spark, sf))


@query
def length_by_rating(spark, sf):
    return E.length_by_rating(work(spark, sf))


@query
def length_histogram(spark, sf):
    return E.length_histogram(work_staged(spark, sf), "char_len")


@query
def length_kde(spark, sf):
    return E.length_kde(work_staged(spark, sf), "char_len")


@query
def duplicates(spark, sf):
    return E.duplicate_count(reviews(spark, sf), "review_text")


@query
def duplicate_marks(spark, sf):
    return E.duplicate_marks(reviews(spark, sf), "review_text", "doc_id")


@query
def top_unigrams(spark, sf):
    return E.top_ngrams(work(spark, sf), 1, 20)


@query
def top_bigrams(spark, sf):
    return E.top_ngrams(work(spark, sf), 2, 20)


@query
def cloud_terms(spark, sf):
    return E.cloud_terms(work_staged(spark, sf))


@query
def cloud_doc_counts(spark, sf):
    return E.cloud_doc_counts(work(spark, sf))


@query
def vocab_stats(spark, sf):
    return E.vocab_stats(work(spark, sf))


@query
def length_rating_corr(spark, sf):
    return E.length_rating_corr(work(spark, sf))


@query
def data_quality(spark, sf):
    return E.data_quality(reviews(spark, sf))


# ------------------------------------------------------------------ splits
def labelled(spark, sf):
    return V.labelled(spark, sf)


@query
def split_exact(spark, sf):
    return R.split_exact(labelled(spark, sf).select("doc_id", "y"), "doc_id")


@query
def split_holdout(spark, sf):
    return R.split_holdout(labelled(spark, sf).select("doc_id", "y"), "doc_id")


@query
def split_stratified(spark, sf):
    return R.split_stratified(labelled(spark, sf).select("doc_id", "y"), "doc_id", "y")


@query
def kfold(spark, sf):
    return R.kfold(labelled(spark, sf).select("doc_id", "y"), "doc_id", "y", 5)


# ------------------------------------------------------------------ evaluation
from reviewlens.operators import metrics as M  # noqa: E402


def scored(spark, sf):
    return V.scored(spark, sf)


def model_results(spark, sf):
    """V5: V3 metrics per language; language stands for the model."""
    m = M.metrics_basic(scored(spark, sf), by=["lang"])
    rep = F.when(F.col("lang").isin("en", "fr"), "classical").otherwise("deep")
    return m.select(F.col("lang").alias("model"), rep.alias("representation"), "accuracy", "macro_f1",
                    F.lit(0.0).alias("train_time"),
                    *[F.round(f"f1_class_{c}", 4).alias(f"f1_class_{c}") for c in range(3)])


@query
def metrics_basic(spark, sf):
    return M.metrics_basic(scored(spark, sf))


@query
def metrics_full(spark, sf):
    s = scored(spark, sf)
    auc = M.roc_auc(s).where(F.col("cls") == "macro").select("auc").scalar()
    return M.summary(s).select(F.round("accuracy", 6).alias("accuracy"),
                               F.round("precision_macro", 6).alias("precision_macro"),
                               F.round("recall_macro", 6).alias("recall_macro"),
                               F.round("macro_f1", 6).alias("f1_macro"), auc.alias("roc_auc"))


@query
def class_report(spark, sf):
    return M.class_report(scored(spark, sf))


@query
def error_count(spark, sf):
    return scored(spark, sf).agg(F.count_if(F.col("y_true") != F.col("y_pred")).alias("n_errors"))


@query
def confusion(spark, sf):
    return M.confusion(scored(spark, sf))


@query
def confusion_norm(spark, sf):
    return M.confusion(scored(spark, sf), normalize=True)


@query
def roc_curve(spark, sf):
    return M.roc_curve(scored(spark, sf))


@query
def roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf))


@query
def error_samples(spark, sf):
    return M.error_samples(scored(spark, sf))


@query
def error_stats(spark, sf):
    return M.error_stats(scored(spark, sf))


@query
def regression_metrics(spark, sf):
    return M.regression_metrics(V.scored_reg(spark, sf))


@query
def pred_vs_actual(spark, sf):
    return M.pred_vs_actual(V.scored_reg(spark, sf)).withColumnRenamed("bx", "bin_true").withColumnRenamed("by", "bin_pred")


@query
def results_table(spark, sf):
    return model_results(spark, sf).drop("train_time")


@query
def comparison(spark, sf):
    r = model_results(spark, sf)
    kind = F.when(F.col("representation") == "classical", "Classical ML").otherwise("Deep Learning")
    return (r.select(kind.alias("model_type"), F.coalesce("model", F.lit("Unknown")).alias("model"),
                     F.coalesce("representation", F.lit("Unknown")).alias("representation"),
                     F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
                     F.coalesce("macro_f1", F.lit(0.0)).alias("macro_f1"),
                     F.coalesce("train_time", F.lit(0.0)).alias("train_time"))
            .orderBy(F.col("macro_f1").desc(), "model"))


@query
def best_models(spark, sf):
    return (model_results(spark, sf).orderBy(F.col("macro_f1").desc(), "model", "representation").limit(5)
            .select("model", "representation", "accuracy", "macro_f1"))


@query
def best_lift(spark, sf):
    """A-17 / A-18 / E-14 / J-08: best row, table aggregates and the deep-over-classical lift."""
    r = model_results(spark, sf)
    best = r.orderBy(F.col("macro_f1").desc(), "model").limit(1)
    best_model = best.select("model").scalar()
    best_cls = r.where(F.col("representation") == "classical").agg(F.max("macro_f1")).scalar()
    best_deep = r.where(F.col("representation") == "deep").agg(F.max("macro_f1")).scalar()
    return r.agg(F.max("accuracy").alias("best_accuracy"), F.max("macro_f1").alias("best_macro_f1"),
                 F.avg("train_time").alias("mean_train_time")).select(
        best_model.alias("best_model"), "best_accuracy", "best_macro_f1", "mean_train_time",
        F.round((best_deep - best_cls) * 100, 4).alias("lift_pp"))


@query
def baseline_majority(spark, sf):
    """A-15 / M-11: majority class of the train split predicted for the test split."""
    sp = R.split_exact(labelled(spark, sf).select("doc_id", "y"), "doc_id")
    maj = (sp.where(F.col("split") == "train").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), "y").limit(1).select("y").scalar())
    test = sp.where(F.col("split") == "test").select(F.col("y").alias("y_true"), maj.alias("y_pred"))
    m = M.metrics_basic(test)
    return m.select(maj.alias("majority_class"), "accuracy", "macro_f1")


@query
def baseline_mean(spark, sf):
    """A-16 / M-13: mean train value predicted for every test event; RMSE and MAE."""
    ev = V.table(spark, sf, "events").select("event_id", "value")
    sp = R.split_exact(ev, "event_id")
    mean = sp.where(F.col("split") == "train").agg(F.avg("value")).scalar()
    test = sp.where(F.col("split") == "test").select(F.col("value").alias("y_true"), mean.alias("y_pred"))
    m = M.regression_metrics(test)
    return m.select(F.round(mean, 6).alias("train_mean"), "rmse", "mae")


@query
def label_encode(spark, sf):
    """X-10 / U-04: class names -> codes in sorted order (StringIndexer, alphabetAsc)."""
    from pyspark.ml.feature import StringIndexer
    from reviewlens.functions.labels import class_name
    v = labelled(spark, sf).select("doc_id", class_name(F.col("y")).alias("label"))
    model = StringIndexer(inputCol="label", outputCol="_code", stringOrderType="alphabetAsc").fit(v)
    return model.transform(v).select("doc_id", "label", F.col("_code").cast("int").alias("code"))


# ------------------------------------------------------------------ features
from reviewlens.operators import features as FT  # noqa: E402


def work_split(spark, sf):
    """Work set with an exact seeded train/val/test split (fit on train only)."""
    from reviewlens.session import stage
    # read by the fit count, the fit statistics and the per-document counts: ranked once, written once
    return stage(R.split_exact(work_staged(spark, sf).select("doc_id", "clean_text", "sentiment"), "doc_id"),
                 "work-split")


@query
def bow(spark, sf):
    w = work_split(spark, sf)
    out, _ = FT.bow(w, "clean_text", fit=F.col("split") == "train", numbered=False)
    return out.select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"))


@query
def tfidf(spark, sf):
    w = work_split(spark, sf)
    out, _ = FT.tfidf(w, "clean_text", fit=F.col("split") == "train", numbered=False)
    return out.select("doc_id", "term", rounded(F.col("weight")).alias("weight"))


def _stats(spark, sf):
    return FT.text_stats(C.drop_null_text(reviews(spark, sf)), "review_text")


@query
def text_stats(spark, sf):
    return _stats(spark, sf).select("doc_id", *[F.round(c, 6).alias(c) for c in FT.STAT_COLS])


@query
def text_stats_scaled(spark, sf):
    from reviewlens.session import stage
    # statistics read by the count, the rank and the scaler fit: computed once, written once
    st = stage(R.split_exact(stage(_stats(spark, sf), "text-stats"), "doc_id"), "text-stats-split")
    z = FT.standard_scale(st, st.where(F.col("split") == "train"), FT.STAT_COLS)
    return z.select("doc_id", "split", *[F.round(c, 6).alias(f"z_{c}") for c in FT.STAT_COLS])


@query
def vocab_by_freq(spark, sf):
    return FT.vocab_by_freq(work_staged(spark, sf), "clean_text")


@query
def vocab_first_seen(spark, sf):
    return FT.vocab_first_seen(work_staged(spark, sf), "clean_text")


@query
def encode_sequences(spark, sf):
    """F-20 / F-21: every token of every text, 256 to a window."""
    from reviewlens.session import stage
    w = work_staged(spark, sf)
    enc = FT.encode_windows(w, stage(FT.vocab_by_freq(w, "clean_text"), "vocab"), "clean_text")
    return enc.select("doc_id", "window", "length", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


@query
def token_stats(spark, sf):
    return FT.token_stats(work_staged(spark, sf), "clean_text")


# ------------------------------------------------------------------ sources and sinks
from reviewlens.session import scratch_dir  # noqa: E402
from reviewlens.sources import readers as IO  # noqa: E402

# Fixed junk lines appended to the JSON-lines fixture: blank, truncated, non-object, non-JSON.
JUNK_LINES = ["", '{"text": "truncated', "[1]", "not json at all"]
V1_COLS = ["doc_id", "review_text", "rating", "lang", "source"]
OLD_NAMES_SCHEMA = "doc_id long, text string, overall double, lang string, source string"


def _v1_old_names(spark, sf):
    """V1 with the legacy column names ``text`` / ``overall`` (exercises P-01)."""
    return V.reviews(spark, sf).withColumnRenamed("review_text", "text").withColumnRenamed("rating", "overall")


@query
def ingest_jsonl(spark, sf):
    """S-01/S-04/S-05/P-01: gzip JSON lines plus junk lines, read back and canonicalised."""
    base = scratch_dir(spark, "ingest-jsonl")
    _v1_old_names(spark, sf).write.option("compression", "gzip").json(base)
    spark.createDataFrame([(x,) for x in JUNK_LINES], "value string").coalesce(1).write.mode("append").text(base)
    return IO.read_reviews(spark, base, fmt="jsonl", key="doc_id").select(*V1_COLS)


@query
def ingest_csv(spark, sf):
    """S-03: CSV with quotes, embedded newlines and blank-only fields, read back exactly."""
    base = scratch_dir(spark, "ingest-csv")
    IO.write_stage(_v1_old_names(spark, sf), base, fmt="csv")
    return IO.read_reviews(spark, f"{base}", fmt="csv", schema=OLD_NAMES_SCHEMA, key="doc_id").select(*V1_COLS)


ROWS_A_DOCUMENT = 2_000


@query
def ingest_json(spark, sf):
    """S-02: one JSON array document per file (multiLine), one file per hash bucket of about ROWS_A_DOCUMENT rows."""
    base = scratch_dir(spark, "ingest-json")
    v = _v1_old_names(spark, sf)
    buckets = max(1, -(-v.count() // ROWS_A_DOCUMENT))
    docs = (v.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket"))
            .agg(F.to_json(F.collect_list(F.struct(*v.columns))).alias("value")))
    docs.write.partitionBy("bucket").text(base)
    return IO.read_reviews(spark, base, fmt="json", key="doc_id").select(*V1_COLS)


@query
def stage_roundtrip(spark, sf):
    """S-07/S-08: cleaned stage written as Parquet and read back."""
    base = scratch_dir(spark, "stage-02_cleaned")
    IO.write_stage(cleaned(spark, sf).select("doc_id", "clean_text", "sentiment"), base)
    return IO.read_stage(spark, base)


# ------------------------------------------------------------------ learners (rows-only checks)
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.functions import array_to_vector  # noqa: E402

from reviewlens.functions.columns import rounded, with_computed  # noqa: E402
from reviewlens.operators import closed as CF  # noqa: E402
from reviewlens.operators import learn as ML  # noqa: E402


def learn_split(spark, sf, target: str = "class"):
    """Labelled docs (class task: V2 y) or rated reviews (regression: V1 rating), cleaned and split exactly."""
    if target == "class":
        base = V.labelled(spark, sf).select("doc_id", F.col("y").cast("double").alias("label"), "text")
    else:
        base = (reviews(spark, sf).where(F.col("rating").isNotNull() & F.col("review_text").isNotNull())
                .select("doc_id", F.col("rating").alias("label"), F.col("review_text").alias("text")))
    from reviewlens.session import stage
    d = stage(with_computed(base, clean_text=X.clean_text(F.col("text"))).select("doc_id", "label", "text", "clean_text"),
              f"learn-{target}")
    return R.split_exact(d, "doc_id")  # two cut values: a comparison a row, so the texts are written once


def represent(sp, rep: str = "tfidf", slots: int = FT.SLOTS, made: dict | None = None):
    """X-08: features column for a representation; fit on the train split only.

    ``made`` keeps hashed TF-IDF and scaled statistics of ``sp`` for the representations that share them.
    """
    made = {} if made is None else made
    train = sp.where(F.col("split") == "train")

    def tfidf():
        k = ("tfidf", slots)
        if k not in made:
            made[k] = FT.vectorize_hashed(sp, "clean_text", (1, 2), F.col("split") == "train", slots=slots)
        return made[k]

    def scaled():
        if "scaled" not in made:
            st = FT.text_stats(sp, "text")
            made["scaled"] = FT.standard_scale(st, st.join(train.select("doc_id"), "doc_id"), FT.STAT_COLS)
        return made["scaled"]

    if rep in ("tfidf", "bow", "tfidf_stats"):
        if rep == "bow":
            out = FT.vectorize_hashed(sp, "clean_text", (1, 1), idf=False, slots=slots)
        else:
            out = tfidf()
        if rep == "tfidf_stats":  # J-01: equi-join on doc_id + assembler, stays sparse
            out = out.withColumnRenamed("features", "tfidf").join(scaled(), "doc_id")
            out = VectorAssembler(inputCols=["tfidf"] + FT.STAT_COLS, outputCol="features").transform(out)
        return out
    if rep == "text_stats":
        return sp.join(VectorAssembler(inputCols=FT.STAT_COLS, outputCol="features").transform(scaled()), "doc_id")
    if rep == "w2v":
        long, _ = FT.tfidf(sp, "clean_text", fit=F.col("split") == "train", numbered=False)
        v = EM.weighted_doc_vectors(sp, long, w2v_vectors(train), EM.W2V["vectorSize"])
        return sp.join(v.select("doc_id", array_to_vector("vec").alias("features")), "doc_id")
    if rep == "sbert":
        v = EM.embed_with_cache(sp.sparkSession, sp.select("doc_id", "clean_text"), "clean_text",
                                scratch_dir(sp.sparkSession, "embed-cache"))
        return sp.join(v.select("doc_id", array_to_vector("embedding").alias("features")), "doc_id")
    raise ValueError(rep)


def w2v_vectors(train):
    """X-03 on the train split: ``term, vec``."""
    model = EM.train_word2vec(train, "clean_text")
    return model.getVectors().select(F.col("word").alias("term"), EM.vector_array("vector").alias("vec"))


def nb_input(spark, sf, folds: bool = False):
    """Labelled documents with their split, and (doc_id, term, value) TF-IDF of all terms fitted on train; both written.

    Where doc_ids are unique, the rows of TF-IDF carry the document's label and split (and fold of train): learners then
    choose rows by a condition, and none is moved to find out whose it is.
    """
    from reviewlens.session import stage
    sp = learn_split(spark, sf)
    carry = []
    if sp.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        carry = ["label", "split"]
        if folds:
            sp = stage(sp.join(nb_folds(sp).select("doc_id", "fold"), "doc_id", "left"), "learn-folds")
            carry.append("fold")
    long, _ = FT.tfidf(sp, "clean_text", fit=F.col("split") == "train", numbered=False, carry=carry)
    return sp, stage(long.select("doc_id", *carry, "term", F.col("weight").alias("value")), "tfidf-long")


def nb_folds(sp):
    """Stratified folds of the train split: ``doc_id, label, fold``."""
    from reviewlens.session import stage
    return stage(R.kfold(sp.where(F.col("split") == "train").select("doc_id", "label"), "doc_id", "label", 5), "folds")


def rows_of(long, split: str):
    """Condition that a row of ``nb_input``'s long table is of a split, or None where the rows do not carry it."""
    return F.col("split") == split if "split" in long.columns else None


MLP_SLOTS = 1024
_FITTED: dict = {}


def _fit_one(spark, sf, name: str, rep: str = "tfidf", task: str = "classification", **over):
    """Fit + evaluate once per (session, scale, model, representation, task); later queries reuse the fit."""
    k = (id(spark), sf, name, rep, task, tuple(sorted(over.items())))
    if k not in _FITTED:
        _FITTED[k] = _fit_new(spark, sf, name, rep, task, **over)
    return _FITTED[k]


_REPRESENTED: dict = {}


def _represented(spark, sf, rep: str, task: str, slots: int):
    """``doc_id, label, features, split`` of a representation, once per (session, scale): all learners of it read the same tables."""
    k = (id(spark), sf, rep, task, slots)
    if k not in _REPRESENTED:
        sp = learn_split(spark, sf, "class" if task == "classification" else "rating")
        data = represent(sp, rep, slots).select("doc_id", "label", "features", "split")
        if rep == "text_stats":  # reused by fit and score; the others are written as counts by slot
            from reviewlens.session import stage
            data = stage(data, "features")
        _REPRESENTED[k] = FT.few_parts(data)
    return _REPRESENTED[k]


def _fit_new(spark, sf, name: str, rep: str = "tfidf", task: str = "classification", **over):
    # The perceptron's first layer is dense: all terms in MLP_SLOTS slots instead of SLOTS.
    from reviewlens.session import stage
    data = _represented(spark, sf, rep, task, MLP_SLOTS if name == "mlp" else FT.SLOTS)
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    n_train = train.count()
    pipe = ML.build_pipeline(ML.build(name, task, n_train, n_features=MLP_SLOTS, **over))
    model, m, secs = ML.train_and_evaluate(pipe, train, test, task)
    return model, stage(ML.result_row(m, name, rep, secs), "result"), data


def _learner(name, rep="tfidf", task="classification"):
    def q(spark, sf):
        return _fit_one(spark, sf, name, rep, task)[1]
    return q


for _qname, _m, _rep, _task in [
        ("train_lr", "logistic", "tfidf", "classification"),
        ("train_rf", "random_forest", "tfidf", "classification"), ("train_gbt", "gbt", "tfidf", "classification"),
        ("train_mlp", "mlp", "tfidf", "classification"), ("train_svm", "linear_svm", "tfidf", "classification"),
        ("baseline_tfidf_lr", "logistic", "tfidf", "classification"),
        ("train_linear", "linear", "tfidf", "regression"), ("train_ridge", "ridge", "tfidf", "regression"),
        ("train_rf_reg", "random_forest", "text_stats", "regression"),
        ("train_gbt_reg", "gbt", "text_stats", "regression")]:
    QUERIES[_qname] = _learner(_m, _rep, _task)


@query
def tfidf_stats_features(spark, sf):
    """J-01 / X-08: TF-IDF vectors joined on doc_id to scaled text stats and assembled (still sparse)."""
    d = represent(learn_split(spark, sf), "tfidf_stats")
    return d.select("doc_id", "split", "features")


@query
def train_history(spark, sf):
    """M-10: loss per iteration of the logistic regression fit."""
    model = _fit_one(spark, sf, "logistic")[0]
    return ML.training_history(spark, model.stages[-1])


@query
def nb_predictions(spark, sf):
    """M-03: complement naive Bayes on TF-IDF of all terms, fitted on train: predictions of the test split."""
    sp, long = nb_input(spark, sf)
    w = CF.fit_complement_nb(long, sp.where(F.col("split") == "train"), rows=rows_of(long, "train"))
    p = CF.predict_nb(w, long, sp.where(F.col("split") == "test").select("doc_id", "label"), rows=rows_of(long, "test"))
    return p.select("doc_id", F.col("label").cast("int").alias("y_true"), F.col("prediction").alias("y_pred"))


@query
def train_nb(spark, sf):
    """M-03 / M-14: the same model's result row."""
    import time
    t0 = time.perf_counter()
    m = M.metrics_basic(nb_predictions(spark, sf).select("y_true", "y_pred"))
    from reviewlens.session import stage
    m = stage(m, "result")
    return ML.result_row(m, "complement_nb", "tfidf", time.perf_counter() - t0)


def _nb_candidates(spark, sf):
    sp, long = nb_input(spark, sf, folds=True)
    carried = "fold" in long.columns
    folds = sp.where(F.col("split") == "train").select("doc_id", "label", "fold") if carried else nb_folds(sp)
    sums = CF.FoldSums(long, folds, inside=rows_of(long, "train"))
    by_fold = CF.cross_validate_nb(long, folds, ML.NB_SMOOTHING, inside=rows_of(long, "train"), sums=sums)
    return sp, long, CF.candidate_table(by_fold, "alpha", "macro_f1"), sums


@query
def tune_grid(spark, sf):
    """M-15 / M-16 / R-08: all smoothings of complement NB over 5 stratified folds, by macro F1."""
    t = _nb_candidates(spark, sf)[2]
    return t.select("alpha", F.round("mean_metric", 6).alias("mean_metric"), F.round("std_metric", 6).alias("std_metric"), "rank")


@query
def tune_random(spark, sf):
    """M-17: seeded draw of ridge penalties from a wide range, 5 folds, by RMSE."""
    sp, cols = stats_input(spark, sf)
    train = R.kfold(sp.where(F.col("split") == "train"), "doc_id", None, 5)
    t = CF.candidate_table(CF.cross_validate_ridge(train, cols, ML.drawn(ML.RIDGE_RANGE, 5)), "alpha", "rmse", True)
    return t.select("alpha", F.round("mean_metric", 6).alias("mean_metric"), F.round("std_metric", 6).alias("std_metric"), "rank")


@query
def save_load_score(spark, sf):
    """S-10 / S-11 / M-19: save under {task}/{slug}_{rep}, load, re-score, parse the representation back."""
    model, _, data = _fit_one(spark, sf, "logistic")
    path = ML.model_path(scratch_dir(spark, "models"), "classification", "logistic", "tfidf")
    ML.save_model(model, path)
    loaded = ML.load_model(path)
    pred = loaded.transform(data.where(F.col("split") == "test"))
    return pred.select("doc_id", F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
                       F.lit(ML.representation_of(path)).alias("representation"))


@query
def learning_curve(spark, sf):
    """R-04: complement NB refitted on nested seeded shares of train, scored on the same test."""
    sp, long = nb_input(spark, sf)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test").select("doc_id", "label")
    n = train.count()
    shares = (0.25, 0.5, 1.0)
    cuts = R.cut_points(train, "doc_id", {None: [round(f * n) for f in shares]}, seed=7)
    inside = [R.at_or_before("doc_id", cuts[None, round(f * n)], 7) for f in shares]
    if "split" in long.columns:
        parts = {str(i): (rows_of(long, "train") & c, CF.classes_of(train.where(c))) for i, c in enumerate(inside)}
        p = CF.predict_nb_fits(long, parts, {f"p{i}": (i, 1.0) for i in parts}, test, rows_of(long, "test"))
        predicted = [p.select("label", F.col(f"p{i}").alias("prediction")) for i in parts]
    else:
        predicted = [CF.predict_nb(CF.fit_complement_nb(long, train.where(c)), long, test) for c in inside]
    out = None
    for f, p in zip(shares, predicted):
        row = M.metrics_basic(CF.scored(p)).select(F.lit(f).alias("fraction"), "accuracy", "macro_f1")
        out = row if out is None else out.unionByName(row)
    return out


@query
def tuned_delta(spark, sf):
    """R-05: complement NB with the default and with the best cross-validated smoothing, on the same split."""
    sp, long, table, sums = _nb_candidates(spark, sf)
    best = table.where("rank = 1").first()["alpha"]
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test").select("doc_id", "label")
    alphas = {"default_f1": 1.0, "tuned_f1": best}
    if "split" in long.columns:
        parts = {"0": (rows_of(long, "train"), CF.classes_of(train))}
        # The fit's sums by class are those of the folds together.
        p = CF.predict_nb_fits(long, parts, {name: ("0", a) for name, a in alphas.items()}, test, rows_of(long, "test"),
                               every=sums.by_class("0"))
        predicted = {name: p.select("label", F.col(name).alias("prediction")) for name in alphas}
    else:
        predicted = {name: CF.predict_nb(CF.fit_complement_nb(long, train, a), long, test) for name, a in alphas.items()}
    f1 = [M.metrics_basic(CF.scored(p)).select(F.col("macro_f1").alias(name)) for name, p in predicted.items()]
    return f1[0].join(f1[1]).select("default_f1", "tuned_f1", F.round(F.col("tuned_f1") - F.col("default_f1"), 6).alias("delta"))


def stats_input(spark, sf):
    """Rated reviews with their split and text statistics, scaled on train; and the statistics' names."""
    from reviewlens.session import stage
    sp = learn_split(spark, sf, "rating")
    st = stage(FT.text_stats(sp, "text").join(sp.select("doc_id", "label", "split"), "doc_id"), "stats")
    return FT.standard_scale(st, st.where(F.col("split") == "train"), FT.STAT_COLS), FT.STAT_COLS


def _closed_regressions(spark, sf):
    d, cols = stats_input(spark, sf)
    g = CF.gram(d.where(F.col("split") == "train"), cols)
    return d, cols, {"linear": CF.solve(g), "ridge": CF.solve(g, 1.0)}


@query
def linear_coefficients(spark, sf):
    """M-07 / M-08: coefficients on the text statistics by normal equations, without and with a penalty of 1."""
    _, cols, fits = _closed_regressions(spark, sf)
    rows = [(n, *[float(b[i]) for b in fits.values()]) for i, n in enumerate(["intercept", *cols])]
    return spark.createDataFrame(rows, "feature string, linear double, ridge double").select(
        "feature", F.round("linear", 6).alias("linear"), F.round("ridge", 6).alias("ridge"))


@query
def stats_regressions(spark, sf):
    """M-07 / M-08 / E-08: RMSE and MAE of both on the test split."""
    d, cols, fits = _closed_regressions(spark, sf)
    out = None
    for name, beta in fits.items():
        p = CF.predicted(d.where(F.col("split") == "test"), cols, beta)
        row = M.regression_metrics(p.select(F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))).select(
            F.lit(name).alias("model"), F.lit("text_stats").alias("representation"), "rmse", "mae")
        out = row if out is None else out.unionByName(row)
    return out


@query
def batch_scoring(spark, sf):
    """M-19: ridge on the text statistics scores the test split through Spark's batch inference function."""
    d, cols, fits = _closed_regressions(spark, sf)
    beta = fits["ridge"]
    score = ML.linear_batches([beta[1:]], [beta[0]], classify=False)
    test = d.where(F.col("split") == "test").select("doc_id", "label", F.array(*cols).alias("x"))
    return test.select("doc_id", "label", F.round(score("x"), 6).alias("prediction"))


@query
def fitted_comparison(spark, sf):
    """U-03 / E-12: results of fitted classifiers and regressions, with different measures, as one sorted table."""
    nb = M.metrics_basic(nb_predictions(spark, sf).select("y_true", "y_pred")).select(
        F.lit("complement_nb").alias("model"), F.lit("tfidf").alias("representation"), "accuracy", "macro_f1")
    major = baseline_majority(spark, sf).select(F.lit("majority").alias("model"), "accuracy", "macro_f1")
    return CF.comparison(Classical_ML=nb, Baseline=major, Regression=stats_regressions(spark, sf))


@query
def model_matrix(spark, sf):
    """R-06: every classifier x representation; fits are shared with the single-model queries."""
    out = None
    for rep in ("tfidf", "bow", "text_stats"):
        for name in ("logistic", "complement_nb", "random_forest"):
            if name == "complement_nb" and rep == "text_stats":
                continue  # scaled stats can be negative: complement NB needs non-negative input
            row = _fit_one(spark, sf, name, rep)[1]
            out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ streaming extension
from reviewlens.streaming import streams as ST  # noqa: E402


@query
def clean_stream(spark, sf):
    """F-08 over a file stream of V1 JSON lines (legacy names, gzip parts)."""
    src = scratch_dir(spark, "stream-src")
    _v1_old_names(spark, sf).write.option("compression", "gzip").json(src)
    return ST.clean_stream(spark, src, OLD_NAMES_SCHEMA)


@query
def stream_event_counts(spark, sf):
    """Events per day and type from a Parquet file stream with a 1-hour watermark."""
    src = scratch_dir(spark, "stream-events")
    ev = V.table(spark, sf, "events").select("event_id", "ts", "event_type")
    ev.write.parquet(src)
    return ST.windowed_counts(spark, src, "event_id long, ts timestamp, event_type string")


# ------------------------------------------------------------------ lexical (F-15..F-19)
from reviewlens.operators import lexical as LX  # noqa: E402


@query
def stem_tokens(spark, sf):
    """F-15: Porter stems per document (each distinct token stemmed once)."""
    return LX.stem_text(work_staged(spark, sf), "clean_text")


@query
def lemma_text(spark, sf):
    """F-16 with the empty dictionary: lowercased word tokens (the reference's fallback)."""
    return LX.lemmatize_text(work(spark, sf), "clean_text")


def plural_dictionary(tokens):
    """``form, lemma`` of the words with an s at the end that occur without it too: a dictionary that the table itself gives."""
    t = tokens.select("term").distinct()
    forms = t.where(F.col("term").endswith("s")).select(
        F.col("term").alias("form"), F.expr("left(term, length(term) - 1)").alias("lemma"))
    return forms.join(t.select(F.col("term").alias("lemma")), "lemma", "left_semi")


@query
def lemma_dictionary(spark, sf):
    """F-16 / F-18 with a dictionary: forms with a plural s become the word without it, where the corpus has that word."""
    w = work_staged(spark, sf)
    words = w.select(F.explode(X.word_tokens(F.col("clean_text"))).alias("term"))
    return LX.preprocess_for_ml(w, "clean_text", True, dictionary=plural_dictionary(words))


@query
def preprocess_stems(spark, sf):
    """F-18 with stems: processed text of every document of the working set."""
    return LX.preprocess_for_ml(work_staged(spark, sf), "clean_text", use_lemma=False)


@query
def stem_vs_lemma(spark, sf):
    """F-17: text, stem and lemma side by side."""
    return LX.stem_vs_lemma(work_staged(spark, sf), "clean_text")


@query
def preprocess(spark, sf):
    """F-18 + F-19: processed text, its vocabulary (min freq 2, + PAD/UNK) and token stats."""
    from reviewlens.session import stage
    p = stage(LX.preprocess_for_ml(work(spark, sf), "clean_text", use_lemma=True), "processed")
    n_vocab = (p.select(F.explode(X.ws_tokens(F.col("processed_text"))).alias("t")).groupBy("t").count()
               .where(F.col("count") >= 2).agg(F.count(F.lit(1))).scalar())
    return p.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.size(X.ws_tokens(F.col("processed_text")))).alias("a")).select(
        (n_vocab + 2).alias("vocab_size"), "n_docs", F.round("a", 6).alias("avg_tokens_per_doc"))


# ------------------------------------------------------------------ explanations (E-15, E-16)
from reviewlens.operators import explain as XP  # noqa: E402


@query
def linear_attribution(spark, sf):
    """E-15: exact linear attribution over all rows for every class, top 20 features each (T-06 order).

    A feature is a hashed slot; it is named by its most frequent term in train.
    """
    from reviewlens.session import stage
    model = _fit_one(spark, sf, "logistic")[0]
    sp = learn_split(spark, sf)
    terms = FT.term_stats(sp.where(F.col("split") == "train"), "clean_text", (1, 2))
    names = stage(terms.groupBy(FT.slot_of(F.col("term")).alias("index")).agg(
        F.min(F.struct((-F.col("freq")).alias("f"), "term")).alias("m")).select("index", F.col("m.term").alias("term")), "names")
    coef = model.stages[-1].coefficientMatrix.toArray()  # classes x slots
    long = FT.hashed_tfidf(sp, "clean_text", (1, 2), F.col("split") == "train")
    n = sp.agg(F.count(F.lit(1))).first()[0]
    out = None
    for c, row in enumerate(coef):
        weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(row) if w], "index int, weight double")
        one = XP.linear_attribution(long, weights, n).join(names, "index").select(
            F.lit(c).alias("class"), "term", "weight", "mean_abs_phi")
        out = one if out is None else out.unionByName(one)
    return out


@query
def permutation_importance(spark, sf):
    """E-15 for any model: permutation importance of the five text statistics (random forest)."""
    sp = learn_split(spark, sf)
    st = FT.text_stats(sp, "text").join(sp.select("doc_id", "label", "split"), "doc_id").cache()
    asm = VectorAssembler(inputCols=FT.STAT_COLS, outputCol="features")
    train, test = st.where(F.col("split") == "train"), st.where(F.col("split") == "test")
    model = ML.build("random_forest", "classification", 1).fit(asm.transform(train))
    return XP.permutation_importance(model, test, FT.STAT_COLS, asm.transform)


@query
def local_explain(spark, sf):
    """E-16: 5 test documents x 500 word-mask perturbations, top 10 words each."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
    sp = learn_split(spark, sf)
    tok = RegexTokenizer(inputCol="clean_text", outputCol="tok", gaps=False, pattern=FT.MIN_TOKEN[1:-1])
    pipe = Pipeline(stages=[tok, HashingTF(inputCol="tok", outputCol="tf", numFeatures=1 << 18),
                            IDF(inputCol="tf", outputCol="features"),
                            ML.build("logistic", "classification", 1000, maxIter=100)])
    model = pipe.fit(sp.where(F.col("split") == "train"))
    docs = XP.explain_sample(spark, sp.where(F.col("split") == "test").select("doc_id", "clean_text"), 5)
    from pyspark.ml.functions import vector_to_array
    return XP.local_explanations(lambda d: model.transform(d).withColumn("probability", vector_to_array("probability")),
                                 docs, "clean_text", 500, 10)


@query
def local_explain_nb(spark, sf):
    """E-16 of complement naive Bayes, for five documents: perturbed texts are scored by joins, the words chosen one by one."""
    sp, long = nb_input(spark, sf)
    from reviewlens.session import stage
    train = sp.where(F.col("split") == "train")
    weights = stage(CF.fit_complement_nb(long, train, rows=rows_of(long, "train")), "nb-weights")
    docs = XP.explain_sample(spark, sp.where(F.col("split") == "test").select("doc_id", "clean_text"), 5)
    classes = sorted(c for c in weights.columns if c != "term")

    def score(d):
        terms = FT.doc_terms(d.withColumn("_k", F.struct("doc_id", "sample")), "clean_text", (1, 2), "_k")
        s = terms.join(weights, "term").groupBy("_k").agg(*[F.sum(F.col("tf") * F.col(c)).alias(c) for c in classes])
        out = d.select("doc_id", "sample").join(s.select("_k.*", *classes), ["doc_id", "sample"], "left").fillna(0.0, classes)
        top = F.greatest(*classes)
        each = F.array(*[F.exp(F.col(c) - top) for c in classes])
        total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
        return out.withColumn("probability", F.transform(each, lambda x: x / total))

    return XP.local_explanations(score, docs, "clean_text", 500, 5)


# ------------------------------------------------------------------ embeddings (X-03..X-05, X-07, S-09)
from reviewlens.operators import embed as EM  # noqa: E402


@query
def w2v_train(spark, sf):
    """X-03: Word2Vec (skip-gram, 128 dims, window 5, min count 2, 5 epochs, seed 42) on train tokens."""
    sp = learn_split(spark, sf)
    model = EM.train_word2vec(sp.where(F.col("split") == "train"), "clean_text")
    return model.getVectors().select("word", F.size(EM.vector_array("vector")).alias("dim"))


@query
def w2v_weighted(spark, sf):
    """X-04: TF-IDF-weighted mean of word vectors per document (zero vector when no shared term)."""
    sp = learn_split(spark, sf)
    long, _ = FT.tfidf(sp, "clean_text", fit=F.col("split") == "train", numbered=False)
    vecs = w2v_vectors(sp.where(F.col("split") == "train"))
    out = EM.weighted_doc_vectors(sp.select("doc_id"), long, vecs, 128)
    return out.select("doc_id", F.size("vec").alias("dim"),
                      F.round(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("norm"))


@query
def embed_cached(spark, sf):
    """X-05 / S-09 / J-06 / U-01 / V-03: content-keyed embedding cache; train first, then all splits."""
    sp = learn_split(spark, sf).select("doc_id", "split", "clean_text")
    cache = scratch_dir(spark, "embed-cache")
    EM.embed_with_cache(spark, sp.where(F.col("split") == "train"), "clean_text", cache)
    parts = [sp.where(F.col("split") == s) for s in ("train", "val", "test")]
    out = EM.embed_with_cache(spark, parts[0].unionByName(parts[1]).unionByName(parts[2]), "clean_text", cache)  # U-01
    return out.select("doc_id", "split", F.size("embedding").alias("dim"), "from_cache")


@query
def run_features(spark, sf):
    """X-07 / X-08: every representation fitted on train; documents and non-zero features of each split."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    sp = learn_split(spark, sf)
    rows, made = None, {}
    for rep in ("bow", "tfidf", "text_stats", "tfidf_stats", "w2v", "sbert"):
        d = represent(sp, rep, made=made)
        r = d.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"), Summarizer.numNonZeros(F.col("features")).alias("nz"))
        total = F.aggregate(vector_to_array("nz"), F.lit(0.0), lambda a, x: a + x).cast("bigint")
        r = r.select(F.lit(rep).alias("representation"), "split", "n_docs", total.alias("n_nonzero"))
        rows = r if rows is None else rows.unionByName(r)
    return rows


# ------------------------------------------------------------------ EDA driver (D-02)
@query
def run_eda(spark, sf):
    """D-02: every finding as (finding, key, value) over one written working set (A-02/A-03 on the full frame).

    Grams and words are counted in one pass each, for all findings that read them.
    """
    w = work_staged(spark, sf)
    grams, words = E.shared_grams(w), E.shared_words(w)
    parts = [
        E.class_distribution(w).select(F.lit("class_distribution").alias("finding"), F.col("sentiment").alias("key"),
                                       F.col("cnt").cast("double").alias("value")),
        E.rating_distribution(w).select(F.lit("rating_distribution"), F.col("rating").cast("string"),
                                        F.col("cnt").cast("double")),
        E.length_summary(w).select(F.lit("length_summary"), F.col("kind"), F.col("mean_len")),
        E.duplicate_count(reviews(spark, sf), "review_text").select(F.lit("duplicates"), F.lit("n_duplicates"),
                                                                    F.col("n_duplicates").cast("double")),
        E.vocab_stats(w, words=words).select(F.lit("vocab"), F.lit("vocab_size"), F.col("vocab_size").cast("double")),
        E.cloud_doc_counts(w).select(F.lit("cloud_docs"), F.col("sentiment"), F.col("n_docs").cast("double")),
        E.length_histogram(w, "char_len").select(F.lit("length_histogram"), F.col("bin").cast("string"), F.col("cnt").cast("double")),
        E.length_kde(w, "char_len").select(F.lit("length_density"), F.col("grid").cast("string"), F.col("density")),
        E.length_by_rating(w).select(F.lit("words_by_rating"), F.col("rating").cast("string"), F.round("mean_words", 6)),
        *[E.top_ngrams(w, n, 20, grams=grams).select(F.lit(f"top_{n}_grams"), F.col("ngram"), F.col("cnt").cast("double")) for n in (1, 2)],
        E.top_ngrams_by_class(w, (1, 2), 5, grams=grams).select(
            F.lit("ngrams_by_class"), F.concat_ws(":", "sentiment", "n", "ngram"), F.col("cnt").cast("double")),
        E.cloud_terms(w, words=words).select(F.lit("cloud_terms"), F.concat_ws(":", "sentiment", "ngram"), F.col("cnt").cast("double")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
