"""Dense text representations (X-03, X-04, X-05, S-09, J-02, J-06).

* Word2Vec: skip-gram with negative samples on whitespace tokens, trained in
  parts; words and vectors are rows of tables.  Vectors differ from other
  libraries', shape and vocabulary agree.
* TF-IDF-weighted document vectors: a part of the documents gets the vectors
  of its terms once and is summed in place.
* Sentence embeddings: a pluggable batch encoder called from ``mapInPandas``
  (one encoder load per task), behind a content-keyed Parquet cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlens.session import ship_package
from reviewlens.functions import text as X

W2V = {"vectorSize": 128, "windowSize": 5, "minCount": 2, "maxIter": 5, "seed": 42}
ENCODER_DIM = 64
ENCODER_NAME = "hashed-bow-64"


def vector_array(c) -> F.Column:
    return vector_to_array(F.col(c) if isinstance(c, str) else c, "float32")


#: (document, term) rows of one part of the documents, whose vectors are summed together.
ROWS_A_PART = 1_500_000
#: Tokens that one Word2Vec part trains on while there are cores for more parts, and at most.
TOKENS_A_PARTITION, MOST_TOKENS = 250_000, 4_000_000
#: Times that the parts' vectors are averaged.
ROUNDS = 3
#: Negative samples of a pair; tokens that are trained on at once, and the samples that they share.
NEGATIVES, BLOCK, SHARED = 5, 64, 64
#: Most that the steps of one word add up to in a block.
MOST_STEP = 0.5


def w2v_partitions(n_tokens: int, cores: int = 1 << 10) -> int:
    """Parts: one for every ``TOKENS_A_PARTITION`` tokens up to the cores, then equal parts of at most ``MOST_TOKENS``."""
    return max(1, min(-(-n_tokens // TOKENS_A_PARTITION), cores * max(1, -(-n_tokens // (cores * MOST_TOKENS)))))


def _first_vectors(hashes: np.ndarray, dim: int) -> np.ndarray:
    """Small random vectors, the same for a word wherever it is met (splitmix64 of its hash)."""
    out = np.empty((len(hashes), dim), np.float32)
    step = np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 4096):
        z = hashes[at:at + 4096].astype(np.int64).view(np.uint64)[:, None] + step
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[at:at + 4096] = ((z ^ (z >> np.uint64(31))) >> np.uint64(40)) / float(1 << 24) - 0.5
    return out / dim


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray, weight: np.ndarray, step: np.float32) -> None:
    """Add to each row number in ``at`` the sum of its gradients, with steps that add up to ``MOST_STEP`` at most."""
    order = at.argsort(kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    total = np.add.reduceat(weight[order], first)
    to[at[first]] += np.add.reduceat(rows[order], first, axis=0) * np.minimum(step, MOST_STEP / np.maximum(total, 1e-9))[:, None]


def skip_gram(ids: np.ndarray, doc: np.ndarray, counts: np.ndarray, words: np.ndarray, contexts: np.ndarray, window: int,
              steps: list[tuple[float, float]], seed: int) -> None:
    """Skip-gram passes with negative samples over a stream of word numbers, in place; a pass goes from one step size to the next.

    A centre looks at 1 to ``window`` words on each side, drawn each time, within its document.  ``BLOCK`` centres are one
    matrix product against their contexts and ``SHARED`` words drawn by count ** 0.75, whose gradients weigh as ``NEGATIVES``
    samples a pair do on average.
    """
    rng = np.random.default_rng(seed)
    noise = np.cumsum(counts.astype(float) ** 0.75)
    n, w = len(ids), window
    blocks = -(-n // BLOCK)
    ids = np.concatenate((np.zeros(w, np.int32), ids, np.zeros(blocks * BLOCK - n + w, np.int32)))
    doc = np.concatenate((np.full(w, -1, np.int32), doc, np.full(blocks * BLOCK - n + w, -1, np.int32)))
    away = np.abs(np.arange(BLOCK)[:, None] + w - np.arange(BLOCK + 2 * w))
    away[away == 0] = w + 1
    weight = np.empty((BLOCK, BLOCK + 2 * w + SHARED), np.float32)
    for start, end in steps:
        for block in range(blocks):
            at = block * BLOCK
            here, near = slice(at + w, at + w + BLOCK), slice(at, at + BLOCK + 2 * w)
            reach = rng.integers(1, w + 1, BLOCK) * (doc[here] >= 0)
            pairs = (away <= reach[:, None]) & (doc[here][:, None] == doc[near])
            drawn = np.minimum(np.searchsorted(noise, rng.random(SHARED) * noise[-1], "right"), len(counts) - 1)
            centre, other = ids[here], np.concatenate((ids[near], drawn))
            a, b = words[centre], contexts[other]
            g = np.float32(-1) / (1 + np.exp(-np.clip(a @ b.T, -30, 30)))
            g[:, :-SHARED] += 1
            weight[:, :-SHARED] = pairs
            weight[:, -SHARED:] = (pairs.sum(axis=1) * (NEGATIVES / SHARED))[:, None]
            g *= weight
            step = np.float32(start + (end - start) * block / blocks)
            _add_rows(words, centre, g @ b, weight.sum(axis=1), step)
            _add_rows(contexts, other, g.T @ a, weight.sum(axis=0), step)


def _matrix(column, dim: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float32)


def _packed(rows: np.ndarray, dim: int) -> list[bytes]:
    """Rows of word and context vectors in 8 bits a number, each vector with its scale: two floats, then the numbers."""
    both = rows.reshape(-1, 2, dim)
    scale = (np.abs(both).max(axis=2) / 127).astype(np.float32)
    numbers = np.rint(both / np.where(scale > 0, scale, 1)[..., None]).astype(np.int8).reshape(-1, 2 * dim)
    return [r.tobytes() for r in np.concatenate((scale.view(np.uint8), numbers.view(np.uint8)), axis=1)]


def _unpacked(column, dim: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 8 + 2 * dim)
    scale = np.ascontiguousarray(raw[:, :8]).view(np.float32)
    return (raw[:, 8:].view(np.int8).reshape(-1, 2, dim) * scale[..., None]).reshape(-1, 2 * dim)


def _trained(dim: int, window: int, steps: list[tuple[float, float]], seed: int, last: bool, single: bool = True):
    """One round of the parts in a task: rows of words (``n`` not null) and of documents (``tokens``) in any order.

    Vectors leave the ``last`` round in single or half precision, those before in 8 bits (``_packed``).
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        parts: dict[int, tuple[list, list]] = {}
        for batch in batches:
            table = pa.table(batch)
            for part in pc.unique(batch.column("part")).to_pylist():
                mine = table.filter(pc.equal(table["part"], part))
                is_word = pc.is_valid(mine["n"])
                words, docs = parts.setdefault(part, ([], []))
                found = mine.filter(is_word)
                if len(found):
                    sent = found["vec"]
                    both = None if sent.null_count else _unpacked(sent, dim)
                    words.append((found["word"].combine_chunks(), found["n"].to_numpy(), found["h"].to_numpy(), both))
                found = mine.filter(pc.invert(is_word))
                if len(found):
                    docs.append((pc.split_pattern(found["tokens"].combine_chunks(), " "), found["h"].to_numpy()))
        for part in sorted(parts):
            words, docs = parts.pop(part)
            if not words:
                continue
            name = pa.concat_arrays([c for x in words for c in (x[0].chunks if isinstance(x[0], pa.ChunkedArray) else [x[0]])])
            order = pc.sort_indices(name).to_numpy()  # rows arrive in any order, results do not depend on it
            name = name.take(pa.array(order))
            counts, hashes = (np.concatenate([x[i] for x in words])[order] for i in (1, 2))
            if words[0][3] is None:
                inner, outer = _first_vectors(hashes, dim), np.zeros((len(name), dim), np.float32)
            else:
                inner, outer = (np.concatenate([x[3][:, s] for x in words])[order] for s in (slice(dim), slice(dim, None)))
            words.clear()
            # Documents in order of their hash: reruns agree in whatever order the rows came.
            place = np.argsort(np.argsort(np.concatenate([h for _, h in docs]), kind="stable")).astype(np.int32)
            ids, doc, seen = [], [], 0
            for one, _ in docs:
                for piece in one.chunks if isinstance(one, pa.ChunkedArray) else [one]:
                    known = pc.index_in(piece.flatten(), value_set=name)
                    owner = pc.list_parent_indices(piece).to_numpy()
                    keep = pc.is_valid(known).to_numpy(zero_copy_only=False)
                    ids.append(pc.fill_null(known, 0).to_numpy()[keep].astype(np.int32))
                    doc.append(place[owner[keep] + seen])
                    seen += len(piece)
            docs.clear()
            doc = np.concatenate(doc)
            order = doc.argsort(kind="stable")
            skip_gram(np.concatenate(ids)[order], doc[order], counts, inner, outer, window, steps, seed + part)
            for at in range(0, len(name), 2048):
                s = slice(at, at + 2048)
                rows = ([r.tobytes() for r in inner[s].astype(np.float32 if single else np.float16)] if last
                        else _packed(np.concatenate((inner[s], outer[s]), axis=1), dim))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), name[s], pa.array(counts[s], pa.int64()),
                     pa.array(hashes[s], pa.int64()), pa.array(rows, pa.binary())],
                    ["part", "word", "n", "h", "vec"])

    return run


def _averaged(dim: int, last: bool, single: bool = True):
    """Rows sorted by word -> each row with the mean of its word's vectors by count; in the last round one row a word."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def means(table):
        word = table["word"].combine_chunks()
        new = np.concatenate(([True], pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False))).astype(bool)
        first = np.flatnonzero(new)
        n = table["n"].to_numpy().astype(np.float32)
        vec = _matrix(table["vec"], dim, np.float32 if single else np.float16) if last else _unpacked(table["vec"], dim)
        mean = np.add.reduceat(vec * n[:, None], first, axis=0) / np.add.reduceat(n, first)[:, None]
        if last:
            flat = pa.array(mean.ravel(), pa.float32())
            return pa.RecordBatch.from_arrays(
                [word.take(pa.array(first)), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(first) + 1) * dim, pa.int32()), flat)], ["word", "vector"])
        sent = _packed(mean, dim)
        which = np.cumsum(new) - 1
        return pa.RecordBatch.from_arrays(
            [*(table[c].combine_chunks() for c in ("part", "word", "n", "h")),
             pa.array([sent[i] for i in which], pa.binary())], ["part", "word", "n", "h", "vec"])

    def run(batches):
        held = None  # rows of the word that the last batch ended with: one a part
        for batch in batches:
            table = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            if not len(table):
                continue
            cut = pc.index(table["word"], table["word"][-1]).as_py()
            held = table.slice(cut)
            if cut:
                yield means(table.slice(0, cut))
        if held is not None:
            yield means(held)

    return run


class WordVectors:
    """Word vectors as a written table ``word, vector``."""

    def __init__(self, table: DataFrame):
        self.table = table

    def getVectors(self) -> DataFrame:
        return self.table.select("word", array_to_vector("vector").alias("vector"))

    def findSynonyms(self, word: str, num: int) -> DataFrame:
        """The ``num`` words of the greatest cosine to ``word``, without it."""
        own = [float(x) for x in self.table.where(F.col("word") == word).first()["vector"]]
        dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
        v, o = F.col("vector").cast("array<double>"), F.array(*map(F.lit, own))
        cosine = F.coalesce(F.try_divide(dot(v, o), F.sqrt(dot(v, v) * dot(o, o))), F.lit(0.0))
        return (self.table.where(F.col("word") != word).select("word", cosine.alias("similarity"))
                .orderBy(F.col("similarity").desc(), "word").limit(num))


def train_word2vec(docs: DataFrame, text_col: str, **over) -> WordVectors:
    """X-03: skip-gram vectors with negative samples, trained in parts whose words and vectors are rows.

    Documents are dealt into parts (``w2v_partitions``).  A task gets a part's documents and one row for each of its words with
    its vectors, and runs passes over them; a word's vectors are averaged over the parts that saw it, weighted by its count there, and go
    back to those parts for the next of ``ROUNDS`` rounds.  No table of all words is on the driver or in a task.  Vectors
    travel between rounds in 8 bits a number with a scale of their own, after the last in half precision (of one part: single);
    training and averages are in single.  Each half of a round is written and what it read is deleted, so no more than three tables of a
    round's vectors lie on disk.  Words of fewer than ``minCount`` tokens are skipped.  ``numPartitions`` and ``maxIter`` (passes) in ``over`` replace the computed ones.
    """
    from reviewlens.session import drop, stage
    spark = docs.sparkSession
    ship_package(spark)
    opt = {**W2V, "stepSize": 0.025, **over}
    dim, window = opt["vectorSize"], opt["windowSize"]
    toks = docs.select(X.ws_tokens(F.col(text_col)).alias("tokens")).where(F.size("tokens") > 0)
    n = toks.agg(F.sum(F.size("tokens"))).first()[0] or 0
    parts = opt.get("numPartitions", w2v_partitions(n, spark.sparkContext.defaultParallelism))
    # Tokens are sent as one string: a list a row, null in the rows of words, costs the writer of Arrow batches more than the rest.
    toks = stage(toks.select(F.pmod(F.xxhash64("tokens"), F.lit(parts)).cast("int").alias("part"), F.xxhash64("tokens").alias("h"),
                             F.array_join("tokens", " ").alias("tokens")), "w2v-tokens")
    passes = opt["maxIter"]
    every = Window.partitionBy("word")
    local = (toks.select("part", F.explode(F.split("tokens", " ")).alias("word")).groupBy("part", "word").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("_all", F.sum("n").over(every)).where(F.col("_all") >= opt["minCount"]))
    rows = local.select("part", "word", "n", F.xxhash64(F.lit(opt["seed"]), "word").alias("h"),
                        F.lit(None).cast("binary").alias("vec"))
    texts = toks.select("part", F.lit(None).cast("string").alias("word"), F.lit(None).cast("bigint").alias("n"),
                        "h", F.lit(None).cast("binary").alias("vec"), "tokens")
    kind = "part int, word string, n bigint, h bigint, vec binary"
    rounds = max(1, min(ROUNDS, passes)) if parts > 1 else 1
    size = lambda done: opt["stepSize"] * max(1 - done / passes, 1e-4)
    for r in range(rounds):
        last = r == rounds - 1
        steps = [(size(i), size(i + 1)) for i in range(passes * r // rounds, passes * (r + 1) // rounds)]
        both = rows.withColumn("tokens", F.lit(None).cast("string")).unionByName(texts)
        done = stage(both.repartitionById(parts, F.col("part")).mapInArrow(
            _trained(dim, window, steps, opt["seed"] + r * parts, last, parts == 1), kind), "w2v-trained")
        drop(rows)
        rows = stage(done.repartition(parts, "word").sortWithinPartitions("word", "part").mapInArrow(
            _averaged(dim, last, parts == 1), "word string, vector array<float>" if last else kind), "word-vectors" if last else "w2v-averaged")
        drop(done)
    drop(toks)
    return WordVectors(rows)


def _weighted_means(dim: int, schema):
    """Rows (part, term, vec) and (part, key, term, weight) in order of key, nulls first -> one (key, vec) a key."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def flush(table, name, vec):
        known = pc.index_in(table["term"], value_set=name).to_numpy()
        weight = table["weight"].to_numpy()
        doc = table["_key"].combine_chunks()
        first = np.flatnonzero(np.concatenate(([True], pc.not_equal(doc[1:], doc[:-1]).to_numpy(zero_copy_only=False))))
        total = np.add.reduceat(weight, first)
        sums = np.empty((len(first), dim))
        ends = np.append(first[1:], len(weight))
        for i, (lo, hi) in enumerate(zip(first, ends)):
            sums[i] = weight[lo:hi] @ vec[known[lo:hi]]
        mean = (sums / total[:, None]).astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * dim, pa.int32()), pa.array(mean.ravel()))
        return pa.RecordBatch.from_arrays([doc.take(pa.array(first)), lists], schema)

    def run(batches):
        names, vecs, name, vec, held = [], [], None, None, None
        for batch in batches:
            table = pa.table(batch)
            is_word = pc.is_null(table["_key"])
            words, rows = table.filter(is_word), table.filter(pc.invert(is_word))
            if len(words):
                names.append(words["term"])
                vecs.append(np.array(pc.list_flatten(words["vec"]), np.float32).reshape(-1, dim))
            if not len(rows):
                continue
            if name is None:
                name = pa.concat_arrays([c for x in names for c in x.chunks])
                vec = np.concatenate(vecs)
                names.clear(), vecs.clear()
            table = rows if held is None else pa.concat_tables([held, rows])
            cut = pc.index(table["_key"], table["_key"][-1]).as_py()
            held = table.slice(cut)
            if cut:
                yield flush(table.slice(0, cut), name, vec)
        if held is not None:
            yield flush(held, name, vec)

    return run


def weighted_doc_vectors(docs: DataFrame, tfidf_long: DataFrame, vectors: DataFrame, dim: int,
                         key: str = "doc_id") -> DataFrame:
    """X-04: sum(w * v) / sum(w) over terms with a vector and positive weight; zero vector otherwise.

    ``vectors`` has one row a term.  Documents are dealt into parts; a part gets the vector of each of its terms once, and its
    documents are summed where they are, one after the other: no vector is sent or sorted for a (document, term) row.
    Bigrams never have a word vector, so only unigram rows enter.
    """
    from reviewlens.session import stage
    uni = tfidf_long.where(~F.col("term").contains(" ") & (F.col("weight") > 0) & F.col(key).isNotNull())
    kept = stage(uni.select(F.col(key).alias("_key"), "term", F.col("weight").cast("double").alias("weight"))
                 .join(vectors.select("term"), "term", "left_semi"), "doc-terms")
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-kept.count() // ROWS_A_PART))
    rows = kept.withColumn("_part", F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int"))
    kind = rows.schema["_key"].dataType
    words = (rows.select("_part", "term").distinct().join(vectors.select("term", "vec"), "term")
             .select(F.lit(None).cast(kind).alias("_key"), "term", F.lit(None).cast("double").alias("weight"), "_part", "vec"))
    # Not null: the writer of Arrow batches goes through all null lists before a row again for each row.
    both = rows.withColumn("vec", F.array().cast("array<float>")).unionByName(words)
    # A task may hold several parts: terms of all of them come first, keys lie in one part each.
    vec = both.repartitionById(n, F.col("_part")).sortWithinPartitions(F.col("_key").asc_nulls_first()).mapInArrow(
        _weighted_means(dim, ["_key", "vec"]), f"_key {kind.simpleString()}, vec array<float>").withColumnRenamed("_key", key)
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return docs.select(key).join(vec, key, "left").select(key, F.coalesce("vec", zero).alias("vec"))


# X-05 -----------------------------------------------------------------------------------
def hashed_encoder(texts: pd.Series) -> list[np.ndarray]:
    """Test encoder: signed hashed bag of words, L2-normalised (no pre-trained model is installed)."""
    out = []
    for t in texts:
        v = np.zeros(ENCODER_DIM, dtype=np.float32)
        for w in (t or "").split():
            h = int.from_bytes(hashlib.md5(w.encode("utf-8")).digest()[:4], "little")
            v[h % ENCODER_DIM] += 1.0 if (h >> 31) & 1 else -1.0
        n = float(np.linalg.norm(v))
        out.append(v / n if n > 0 else v)
    return out


def _encode_batches(encoder: Callable[[pd.Series], list], text_col: str):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"text_md5": pdf["text_md5"], "embedding": [list(map(float, e)) for e in encoder(pdf[text_col])]})
    return run


def embed_with_cache(spark: SparkSession, docs: DataFrame, text_col: str, cache_path: str,
                     encoder: Callable[[pd.Series], list] = hashed_encoder, model: str = ENCODER_NAME,
                     key: str = "doc_id") -> DataFrame:
    """Content-keyed cache ``(model, text_md5, embedding)``: encode only the texts it lacks.

    Misses are found with a left-anti join, encoded once per distinct text in
    ``mapInPandas``, appended to the cache, and every document is joined back.
    """
    ship_package(spark)
    # A null text is encoded as the empty one; entries that two jobs wrote at once count once.
    d = docs.withColumn("text_md5", F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        cached = spark.read.parquet(cache_path).where(F.col("model") == model).dropDuplicates(["text_md5"])
    else:
        cached = spark.createDataFrame([], "model string, text_md5 string, embedding array<float>")
    misses = d.select("text_md5", F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).dropDuplicates(["text_md5"]).join(
        cached.select("text_md5"), "text_md5", "left_anti")
    fresh = misses.mapInPandas(_encode_batches(encoder, text_col), "text_md5 string, embedding array<float>")
    fresh.select(F.lit(model).alias("model"), "text_md5", "embedding").write.mode("append").parquet(cache_path)
    hit_keys = cached.select("text_md5", F.lit(True).alias("from_cache"))
    table = (spark.read.parquet(cache_path).where(F.col("model") == model).select("text_md5", "embedding")
             .dropDuplicates(["text_md5"]))
    return (d.join(table, "text_md5").join(hit_keys, "text_md5", "left")
            .select(*docs.columns, "embedding", F.coalesce("from_cache", F.lit(False)).alias("from_cache")))
