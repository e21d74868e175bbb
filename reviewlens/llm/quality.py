"""Quality rules: tokeniser fertility.

A public sentencepiece vocabulary measures each text: characters per token, share of byte-fallback tokens, and entropy of
its tokens.  For each language and size class (a power of two of tokens) the median and median deviation of the distinct
texts, with no source counted for more than the median source, set a band for each measure; texts outside a band are
rejected.  A class with too few texts takes the band of ever wider classes
of its language, at last of all of them; a language with too few texts takes the corpus' band of entropy and fixed
limits.  The base rules (too few words, too many repeated 5-word windows) reject on their own.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import drop, stage

from .common import arrow_ready, parts_of, ragged_take, split_words, text_key

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A band ends so many interquartile ranges (of at least that width) beyond the quartile on its bad side: few characters
#: a token, many bytes, little variety.  Quartile and range are those of an even spread with the group's median and median
#: deviation: one deviation from the median, and two wide.
BANDS = {"chars_per_token": (5.0, 0.02), "byte_share": (5.0, 0.02), "entropy": (2.0, 0.05)}
#: Groups of fewer distinct texts take the band of the next wider group in ``LEVELS``; the last serves at any size.
MIN_GROUP = 30
#: (of one language, size classes that are one group as a power of two), from the narrowest; 2^5 is all of them.
LEVELS = [(True, 0), (True, 1), (True, 2), (True, 5), (False, 0), (False, 1), (False, 2), (False, 5)]
#: Limits of these measures in place of a band over several languages: how well the vocabulary knows a script says nothing
#: of quality.  Four-byte characters, each a word, have 0.2 characters a token; three-byte ones 0.25.  Any script may be
#: all bytes.
FIXED = {"chars_per_token": 0.22, "byte_share": 1.0}
#: Measures enter bands in steps of one by so many.
STEPS = 200
#: Weights of texts are whole numbers, this for one.
WEIGHT = 1_000
#: Up to so many bands are broadcast (a few numbers each); more meet the documents in a shuffled join.
BROADCAST_BANDS = 10_000

#: Bytes that the cache of word tokens may take before it is emptied.
_CACHE = 32 << 20
_ASCII_WS = " \t\n\x0b\x0c\r"
MEASURES = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
            ("n_repeat_words", "long"), ("n_tokens", "long"), ("chars_per_token", "double"), ("byte_share", "double"),
            ("entropy", "double")]


class Pieces:
    """Token ids of single words, cached; a cache of more than ``_CACHE`` bytes is emptied before the next texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.reset()

    def reset(self) -> None:
        self.words: dict[str, int] = {}
        self.bytes = 0
        self.flat, self.starts, self.lens = array("I"), array("q"), array("q")

    def entries(self, words: list[str]) -> np.ndarray:
        if self.bytes > _CACHE:
            self.reset()
        known, out = self.words, []
        new = [w for w in words if w not in known]
        for w, ids in zip(new, self.model.encode(new, num_threads=1) if new else []):
            known[w] = len(self.starts)
            self.bytes += 150 + 4 * len(w) + 4 * len(ids)
            self.starts.append(len(self.flat))
            self.lens.append(len(ids))
            self.flat.extend(ids)
        out = [known[w] for w in words]
        return np.array(out, np.int64)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each text's stretch of ``values``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends[1:]] - total[ends[:-1]]


def repeated_words(index: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of five which the text has twice or more."""
    n = len(index)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    if n < WINDOW:
        return np.zeros(len(ends) - 1, np.int64)
    rolled = doc[:n - WINDOW + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(WINDOW):
        x = index[k:n - WINDOW + 1 + k].astype(np.uint64) + np.uint64((k + 1) * 0xC2B2AE3D27D4EB4F & (2**64 - 1))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        rolled = (rolled ^ x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    inside = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    _, which, times = np.unique(rolled[inside], return_inverse=True, return_counts=True)
    at = inside[times[which] > 1]
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return sums(np.cumsum(step[:-1]) > 0, ends)


def entropies(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bits a token of each text's own token distribution; 0 without tokens."""
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    key, times = np.unique(doc.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64), return_counts=True)
    n = np.diff(ends).astype(float)
    inner = np.bincount((key >> np.uint64(32)).astype(np.int64), times * np.log2(times), len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, np.maximum(np.log2(n) - inner / n, 0.0), 0.0)


def measure(texts: pa.Array, path: str) -> list[np.ndarray]:
    """The columns of ``MEASURES`` for every text; nulls count as empty."""
    words, index, ends = split_words(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    marks = pc.count_substring_regex(words, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)
    dup = []
    for text in texts.to_pylist():
        lines = [x for x in (text or "").split("\n") if x.strip(_ASCII_WS)]
        dup.append(len(lines) - len(set(lines)))
    p = pieces(path)
    entry = p.entries(words.to_pylist())[index] if len(index) else index
    size = np.array(p.lens, np.int64)[entry] if len(entry) else entry
    ids = ragged_take(np.array(p.flat, np.uint32), np.array(p.starts, np.int64)[entry], size) if len(entry) else \
        np.zeros(0, np.uint32)
    token_ends = np.concatenate([[0], np.cumsum(size)])[ends]
    n_tokens = np.diff(token_ends)
    n_chars = sums(chars[index], ends) if len(index) else np.zeros(len(texts), np.int64)
    n_marks = sums(marks[index], ends) if len(index) else np.zeros(len(texts), np.int64)
    some = np.maximum(n_tokens, 1)
    return [np.diff(ends), n_chars, n_marks, np.array(dup, np.int64), repeated_words(index, ends), n_tokens,
            n_chars / some, sums(p.is_byte[ids], token_ends) / some, entropies(ids, token_ends)]


def measured(df: DataFrame, keep: list[str], path: str | None = None) -> DataFrame:
    """``keep`` columns of ``df`` with the measures of its column ``text``."""
    arrow_ready(df.sparkSession)
    names = [n for n, _ in MEASURES]
    source = df.select(*[df[c] for c in keep], F.col("text").alias("_text"))

    def run(batches):
        import public_tokenizers

        file = path or public_tokenizers.path(VOCABULARY)
        for batch in batches:
            for part in parts_of(batch, "_text"):
                cols = measure(part.column("_text"), file)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *[pa.array(c) for c in cols]], [*keep, *names])

    schema = df.select(*[df[c] for c in keep]).schema
    for (_, kind), name in zip(MEASURES, names):
        schema = schema.add(name, kind)
    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    """The contract's base rules."""
    words = F.col("n_words")
    return (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)


def grouped(d: DataFrame) -> DataFrame:
    """Every row of ``d`` (columns _lang, _class) once for each of ``LEVELS``, with the group it has there."""
    at = [F.struct(F.lit(i).alias("_level"), (F.col("_lang") if own else F.lit("")).alias("_group"),
                   F.shiftright("_class", width).alias("_classes")) for i, (own, width) in enumerate(LEVELS)]
    return d.select("*", F.inline(F.array(*at)))


def bands_of(d: DataFrame, limits: dict) -> DataFrame:
    """``_lang, _class, _level`` and by measure its limit, for every language and size class of ``d``.

    Equal texts of a language count once, with the least of their sources.  In each group the median source (by its
    number of texts) is the most that a source weighs, so up to half of the weight may be junk before a band gives way.
    A histogram of each measure by source is all that is read of the texts, so a large group is aggregated before it is
    shuffled.
    """
    group = ["_level", "_group", "_classes"]
    texts = d.groupBy("_lang", "_class", "_hash", "n_tokens").agg(
        F.min("_source").alias("_source"), *[F.max(m).alias(m) for m in limits])
    melted = F.inline(F.array(*[F.struct(F.lit(m).alias("_measure"), F.round(F.col(m) * STEPS).cast("long").alias("_at"))
                                for m in limits]))
    bins = texts.select("_lang", "_class", "_source", F.log2(F.greatest("n_tokens", F.lit(1))).alias("_size"), melted)
    bins = stage(bins.groupBy("_lang", "_class", "_source", "_measure", "_at").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_size")), "bins")
    one = bins.where(F.col("_measure") == next(iter(limits))).groupBy("_lang", "_class", "_source").agg(
        F.sum("_n").alias("_n"), F.sum("_size").alias("_size"))
    sources = grouped(one).groupBy(*group, "_source").agg(F.sum("_n").alias("_of_source"), F.sum("_size").alias("_size"))
    most = sources.groupBy(*group).agg(
        F.percentile("_of_source", F.lit(0.5)).alias("_most"), F.sum("_of_source").alias("_texts"),
        (F.sum("_size") / F.sum("_of_source")).alias("_size"))
    most = stage(most, "sources")
    few = most.count() <= BROADCAST_BANDS
    weights = sources.drop("_size").join(F.broadcast(most) if few else most, group)
    weights = weights.withColumn("_share", F.least(F.lit(1.0), F.col("_most") / F.col("_of_source")))
    heavy = grouped(bins.drop("_size")).groupBy(*group, "_source", "_measure", "_at").agg(F.sum("_n").alias("_n")).join(
        weights.select(*group, "_source", "_share"), [*group, "_source"])
    heavy = heavy.groupBy(*group, "_measure", "_at").agg(
        F.ceil(F.sum(F.col("_n") * F.col("_share")) * WEIGHT).cast("long").alias("_w"))
    middle = heavy.groupBy(*group, "_measure").agg(
        F.percentile("_at", F.lit(0.5), F.col("_w")).alias("_median"), F.collect_list(F.struct("_at", "_w")).alias("_all"))
    wide = middle.select(*group, "_measure", "_median", F.inline("_all")).groupBy(*group, "_measure", "_median").agg(
        F.percentile(F.abs(F.col("_at") - F.col("_median")), F.lit(0.5), F.col("_w")).alias("_deviation"))
    wide = wide.join(F.broadcast(most) if few else most, group)
    reach = F.create_map(*[F.lit(x) for m, (r, _) in limits.items() for x in (m, r)])[F.col("_measure")]
    least = F.create_map(*[F.lit(x) for m, (_, w) in limits.items() for x in (m, w)])[F.col("_measure")]
    middle, deviation = F.col("_median") / STEPS, F.greatest(F.col("_deviation") / STEPS, least / 2)
    slack = deviation + reach * 2 * deviation
    wide = wide.withColumn("_limit", F.when(F.col("_measure") == "byte_share", middle + slack).otherwise(middle - slack))
    wide = wide.groupBy(*group).agg(F.max("_texts").alias("_texts"), F.max("_size").alias("_size"), *[
        F.max(F.when(F.col("_measure") == m, F.col("_limit"))).alias(f"_{m}") for m in limits])
    wide = wide.where((F.col("_texts") >= MIN_GROUP) | (F.col("_level") == len(LEVELS) - 1))
    first = F.min_by(F.struct("_level", "_size", *[f"_{m}" for m in limits]), "_level")
    pairs = grouped(bins.select("_lang", "_class").distinct())
    return pairs.join(wide, group).groupBy("_lang", "_class").agg(first.alias("_b")).select("_lang", "_class", "_b.*")


def judged(d: DataFrame, lang: Column, source: Column, limits: dict = BANDS) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to a written table of measures with the texts' hash in ``_hash``.

    The bands come from all distinct texts that the base rules leave, by language (null: one group) and size class, or the
    first wider group that has ``MIN_GROUP`` texts.  A null source is a source.  Every document is held against a limit of each measure.  In a wider
    group a text shorter than its mean has a limit of entropy that is lower in proportion to log2 of its tokens, which
    entropy cannot exceed.
    """
    size = F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))
    d = d.withColumns({"base_failed": base_failed(), "_lang": F.coalesce(lang.cast("string"), F.lit("")),
                       "_source": F.coalesce(source.cast("string"), F.lit("")), "_class": F.floor(size).cast("int")})
    bands = stage(bands_of(d.where(~F.col("base_failed")), limits), "bands")
    few = bands.count() <= BROADCAST_BANDS
    d = d.join(F.broadcast(bands) if few else bands, ["_lang", "_class"], "left")
    own = sum(of_one for of_one, _ in LEVELS)
    inside = F.lit(True)
    for m in limits:
        limit = F.when(F.col("_level") < own, F.col(f"_{m}")).otherwise(FIXED[m]) if m in FIXED else F.col(f"_{m}")
        if m == "entropy":
            limit = limit * F.when(F.col("_level") == 0, 1.0).otherwise(F.least(F.lit(1.0), size / F.col("_size")))
        inside = inside & (F.col(m) <= limit if m == "byte_share" else F.col(m) >= limit)
    return d.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop(
        "_lang", "_class", "_source", "_hash", "_level", "_size", *[f"_{m}" for m in limits])


def quality(df: DataFrame) -> DataFrame:
    """Measures and verdict of every row of ``df`` (columns doc_id, text, lang).

    Null, empty and wordless texts have zeros and fail the base rules.  A null language is a group of its own.  Repeated
    rows are judged each, alike.  An empty table gives no rows.
    """
    rows = df.select("doc_id", "lang", "text", F.col("source").alias("_s"), text_key().alias("_hash"))
    return judged(stage(measured(rows, ["doc_id", "lang", "_s", "_hash"]), "quality"), F.col("lang"), F.col("_s")).drop("_s")


def kept_documents(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that the rules keep, with their columns as they are.

    Texts go to Python once and do not come back: the verdict depends on the text and its language alone, so the rejected
    (doc_id, text hash, language) are dropped from ``df`` by an anti-join, broadcast where Spark finds the list small.
    Edge rows as in ``quality``; an empty table gives no rows.
    """
    rows = df.select("doc_id", df["lang"].alias("_l"), df["source"].alias("_s"), "text", text_key().alias("_hash"))
    d = stage(measured(rows.withColumn("_key", F.col("_hash")), ["doc_id", "_l", "_s", "_hash", "_key"]), "quality")
    gone = judged(d, F.col("_l"), F.col("_s")).where("not kept").select(
        F.col("doc_id").alias("_id"), F.col("_l").alias("_lang"), "_key").distinct()
    gone = stage(gone, "rejected")
    drop(d)
    same = df["doc_id"].eqNullSafe(gone["_id"]) & df["lang"].eqNullSafe(gone["_lang"]) & (
        F.xxhash64(F.coalesce(df["text"], F.lit(""))) == gone["_key"])
    return df.join(gone, same, "left_anti")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "entropy")
