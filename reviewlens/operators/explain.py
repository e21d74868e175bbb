"""Explanations (E-15, E-16, T-06) as Spark jobs.

* Linear models: exact attribution ``phi_ij = w_j (x_ij - mean_j)``; the mean
  of ``|phi|`` per feature is computed from the sparse long table (zeros
  contribute ``|w_j| mean_j`` each), never densified, over **all** rows.
* Any model: permutation importance, each feature column permuted by a
  seeded exact rank (a one-to-one join on rank), then re-scored.
* Text models: local explanations from seeded sets of removed words, scored by any
  model, with a weighted ridge fit per document (a group is one number a
  perturbation, and the text once; masks are drawn again from the seed).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators import metrics as M
from reviewlens.operators import rank as R


def linear_attribution(long: DataFrame, weights: DataFrame, n_rows: int, key: str = "doc_id",
                       top: int = 20) -> DataFrame:
    """Mean |phi| per feature for one class from (key, index, value) and (index, weight).

    There are at most as many indices as weights (a model's slots, on the driver already), so their statistics are
    broadcast and the rows of ``long`` stay where they are.
    """
    st = long.groupBy("index").agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("df"))
    mean = F.col("s") / F.lit(n_rows)
    j = long.join(F.broadcast(st.select("index", mean.alias("mean"))), "index")
    nz = j.groupBy("index").agg(F.sum(F.abs(F.col("value") - F.col("mean"))).alias("nz"))
    out = (st.join(nz, "index").join(weights, "index")
           .select("index", F.col("weight"),
                   (F.abs("weight") * (F.col("nz") + (F.lit(n_rows) - F.col("df")) * F.col("s") / n_rows) / n_rows)
                   .alias("mean_abs_phi")))
    return out.orderBy(F.col("mean_abs_phi").desc(), "index").limit(top)


def permutation_importance(model, data: DataFrame, feature_cols: list[str], assemble, key: str = "doc_id",
                           label: str = "label", seed: int = R.DEFAULT_SEED) -> DataFrame:
    """Drop in macro F1 when one feature column is permuted (seeded, exact, distributed)."""
    def score(df: DataFrame):
        pred = model.transform(assemble(df))
        return M.summary(pred.select(F.col(label).cast("int").alias("y_true"),
                                     F.col("prediction").cast("int").alias("y_pred"))).select("macro_f1")

    base = score(data).first()[0]
    a = R.exact_rank(data, key, seed, rank_col="_ra")
    b = R.exact_rank(data, key, seed + 1, rank_col="_rb")
    rows = []
    for c in feature_cols:
        donor = b.select(F.col("_rb").alias("_ra"), F.col(c).alias("_v"))
        perm = a.join(donor, "_ra").withColumn(c, F.col("_v")).drop("_v", "_ra")
        rows.append((c, float(base), float(score(perm).first()[0])))
    spark = data.sparkSession
    return spark.createDataFrame(rows, "feature string, base_f1 double, permuted_f1 double").withColumn(
        "importance", F.col("base_f1") - F.col("permuted_f1"))


# E-16 ---------------------------------------------------------------------------------
#: Samples of a document that one task makes.
SAMPLES_A_TASK = 25
KERNEL_WIDTH = 25.0
#: Up to so many features are chosen one after the other; more by the weights of a fit on all.
FORWARD = 6


def _words(text: str) -> tuple[list[str], np.ndarray]:
    """Distinct words in order of first occurrence, and the number of each place's word."""
    places = text.split()
    number: dict[str, int] = {}
    at = np.array([number.setdefault(w, len(number)) for w in places], np.int64)
    return list(number), at


def keep_mask(n_words: int, sample: int, key, seed: int) -> np.ndarray:
    """Which distinct words sample ``sample`` of a document keeps: all for sample 0, else all but a uniformly drawn number."""
    if sample == 0 or n_words == 0:
        return np.ones(n_words, bool)
    draw = int.from_bytes(hashlib.md5(f"{seed}:{key}:{sample}".encode()).digest()[:8], "big")
    rng = np.random.default_rng(draw)
    keep = np.ones(n_words, bool)
    keep[rng.choice(n_words, rng.integers(1, n_words + 1), replace=False)] = False
    return keep


def perturb(docs: DataFrame, text_col: str, n_samples: int = 500, key: str = "doc_id", seed: int = R.DEFAULT_SEED):
    """(key, sample, text): ``n_samples`` copies of every document, each without a random set of its distinct words.

    A removed word goes from all its places; sample 0 is the whole text.  Null texts count as empty.  A document's samples are
    made in several tasks, a row at a time.
    """
    from reviewlens.session import ship_package
    ship_package(docs.sparkSession)
    step = SAMPLES_A_TASK
    d = docs.select(key, F.coalesce(text_col, F.lit("")).alias("_t"), F.explode(
        F.sequence(F.lit(0), F.lit(n_samples - 1), F.lit(step))).alias("_from")).repartition(key, "_from")

    def run(batches):
        for batch in batches:
            for name, text, first in zip(*[c.to_pylist() for c in batch.columns]):
                words, at = _words(text)
                places = np.array(text.split(), dtype=object)
                for sample in range(first, min(first + step, n_samples)):
                    kept = places[keep_mask(len(words), sample, name, seed)[at]] if len(at) else places
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], batch.schema.field(0).type), pa.array([sample], pa.int32()),
                         pa.array([" ".join(kept)], pa.string())], [key, "sample", text_col])

    kind = d.schema[key].dataType.simpleString()
    return d.mapInArrow(run, f"{key} {kind}, sample int, {text_col} string")


def ridge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, alpha: float) -> np.ndarray:
    """Coefficients of a weighted ridge whose intercept is free: in the smaller of both dimensions."""
    total = weight.sum()
    root = np.sqrt(weight).astype(x.dtype)
    a = x - (weight.astype(x.dtype) @ x / total).astype(x.dtype)
    a *= root[:, None]
    b = (y - weight @ y / total) * root
    if a.shape[1] <= a.shape[0]:
        return np.linalg.lstsq(a.T @ a + alpha * np.eye(a.shape[1]), a.T @ b, rcond=None)[0]
    return a.T @ np.linalg.lstsq((a @ a.T).astype(float) + alpha * np.eye(a.shape[0]), b, rcond=None)[0].astype(a.dtype)


def forward_choice(x: np.ndarray, y: np.ndarray, weight: np.ndarray, k: int) -> list[int]:
    """``k`` columns, each the one that leaves the least weighted error beside those before it."""
    total = weight.sum()
    root = np.sqrt(weight).astype(x.dtype)
    a = x - (weight.astype(x.dtype) @ x / total).astype(x.dtype)
    a *= root[:, None]
    rest = ((y - weight @ y / total) * root).astype(x.dtype)
    size = np.einsum("ij,ij->j", a, a)
    open_ = size > 1e-6 * max(float(size.max(initial=0)), 1e-12)
    chosen: list[int] = []
    basis: list[np.ndarray] = []
    for _ in range(min(k, int(open_.sum()))):
        gain = np.where(open_, (rest @ a) ** 2 / np.maximum(size, 1e-12), -1.0)
        j = int(gain.argmax())
        if gain[j] < 0:
            break
        q = a[:, j].astype(float)
        for p in basis:
            q -= (p @ q) * p
        q /= max(np.linalg.norm(q), 1e-12)
        chosen.append(j)
        basis.append(q)
        rest = rest - ((q @ rest) * q).astype(x.dtype)
        size = size - (q.astype(x.dtype) @ a) ** 2
        open_ &= size > 1e-5
        open_[j] = False
    return chosen


def explain_one(text: str, key, samples: np.ndarray, p: np.ndarray, k: int, alpha: float = 1.0,
                seed: int = R.DEFAULT_SEED) -> list[tuple[str, float]]:
    """(word, weight) of the ``k`` words that explain a document's scores ``p`` of its ``samples``, greatest weight first.

    Sample weights fall with the cosine distance to the whole text over its distinct words.  The masks are drawn
    again from the seed, one bit of information a word and sample, four bytes while they are fitted.
    """
    words, _ = _words(text)
    if not words:
        return []
    x = np.empty((len(samples), len(words)), np.float32)
    for row, sample in enumerate(samples):
        x[row] = keep_mask(len(words), int(sample), key, seed)
    distance = 1.0 - np.sqrt(x.sum(axis=1, dtype=float) / len(words))
    weight = np.sqrt(np.exp(-((distance * 100) ** 2) / KERNEL_WIDTH ** 2))
    if k <= FORWARD:
        chosen = forward_choice(x, p, weight, k)
    else:
        first = ridge(x, p, weight, 0.01)
        chosen = np.lexsort((np.arange(len(words)), -np.abs(first)))[:k].tolist()
    if not chosen:
        return []
    coef = ridge(x[:, chosen].astype(float), p, weight, alpha)
    return sorted(((words[j], float(c)) for j, c in zip(chosen, coef)), key=lambda wc: (-abs(wc[1]), wc[0]))


def local_explanations(score, docs: DataFrame, text_col: str, n_samples: int = 500, num_features: int = 10,
                       key: str = "doc_id", alpha: float = 1.0, seed: int = R.DEFAULT_SEED) -> DataFrame:
    """(key, predicted, rank, word, weight): the words that carry each document's predicted class.

    ``score`` takes (key, sample, text) rows and adds ``probability``, an array by class; any model will do.  The class is the
    one with the greatest probability on the whole text.  A document's group holds one number a sample and its text once.
    ``key`` is unique.  Documents without words have no rows.
    """
    scored = score(perturb(docs, text_col, n_samples, key, seed)).select(key, "sample", "probability")
    kind = docs.schema[key].dataType.simpleString()

    def fit(scores: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        columns = [key, "predicted", "rank", "word", "weight"]
        if not len(texts) or not len(scores):
            return pd.DataFrame(columns=columns)
        scores = scores.sort_values("sample")
        p = np.array(scores["probability"].tolist(), float)
        c = int(p[0].argmax())
        name = texts[key].iloc[0]
        found = explain_one(texts["_t"].iloc[0], name, scores["sample"].to_numpy(), p[:, c], num_features, alpha, seed)
        return pd.DataFrame([(name, c, i + 1, w, v) for i, (w, v) in enumerate(found)], columns=columns)

    texts = docs.select(key, F.coalesce(text_col, F.lit("")).alias("_t"))
    return scored.groupBy(key).cogroup(texts.groupBy(key)).applyInPandas(
        fit, f"{key} {kind}, predicted int, rank int, word string, weight double")


def explain_sample(spark: SparkSession, docs: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The documents to explain: a seeded exact sample (the feature is explaining a few documents)."""
    return R.sample_exact(docs, n, key)
