"""Language identification by language-bitmask n-gram filters.

Character n-grams that are typical of a language enter its Bloom filter.  The filters are bit-sliced: place p of the table
holds a bitmask with one bit a language, so the masks at an n-gram's places, and-ed, name all languages that
contain it.  A text's n-grams are counted per language, each count is corrected for the filter's false positives, and
the greatest count decides.

Learned from the text and language of all training rows: n-grams are counted per language in Spark, and one is
typical where its relative frequency is at least ``MIN_FREQUENCY`` (so a language has at most 1 / MIN_FREQUENCY n-grams
an order, which bounds the table) and ``MIN_RATIO`` of the greatest among the languages.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import stage

from .common import arrow_ready, parts_of

ORDERS = (4,)
PLACES = 1 << 21
HASHES = 3
MIN_FREQUENCY = 2e-6
MIN_RATIO = 0.3
#: Languages a mask holds; further ones go to further tables.
MASK_BITS = 63
#: Characters handled at a time, and distinct n-grams a task gathers before it hands them on.
SLICE_BYTES = 2 << 20
GATHERED = 1 << 20

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams within words (a word's start and end count as characters), and the text of each."""
    joined = "\n\n".join(t.lower() if t else "" for t in texts)
    codes = np.frombuffer(("\n" + joined + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = letters()[np.minimum(codes, 0x10FFFF)]
    ends = np.cumsum([len(t.lower()) + 2 if t else 2 for t in texts])
    c = np.where(solid, codes, np.uint32(0)).astype(np.uint64)
    hashes, at = [], []
    for n in ORDERS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        inner = np.ones(m, bool)
        for k in range(n):
            x = c[k:m + k]
            h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                inner &= solid[k:m + k]
        places = np.flatnonzero(inner)
        hashes.append(h[places])
        at.append(places)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(at), side="right")


def places_of(h: np.ndarray) -> list[np.ndarray]:
    """The table's places of n-gram hashes, one array a hash function."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(PLACES - 1)).astype(np.int64) for i in range(HASHES)]


def _count(batches):
    """n-gram counts per language, merged within the task: ``lang, gram, n``."""
    held: dict[str, list] = {}

    def merge(pairs):
        h = np.concatenate([p[0] for p in pairs])
        g, which = np.unique(h, return_inverse=True)
        return g, np.bincount(which, np.concatenate([p[1] for p in pairs]), len(g)).astype(np.int64)

    def out():
        for lang, pairs in held.items():
            g, n = merge(pairs)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)],
                                             ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for part in parts_of(batch, max_bytes=SLICE_BYTES):
            langs = part.column("lang").to_pylist()
            texts = part.column("text").to_pylist()
            for lang in set(langs):
                h, _ = grams([t for t, x in zip(texts, langs) if x == lang])
                g, n = np.unique(h, return_counts=True)
                pairs = held.setdefault(lang, [])
                pairs.append((g, n))
                if len(pairs) >= 8:
                    held[lang] = [merge(pairs)]
            if sum(len(p[0]) for pairs in held.values() for p in pairs) > 8 * GATHERED:
                yield from out()
    yield from out()


def held_out(doc_id) -> bool:
    """Whether a row is kept from training; rows without a doc_id are in neither part."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def train(df: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages (most frequent first), bit-sliced filters (tables x places) and false-positive rates.

    Learns from rows with doc_id, text and lang whose crc32(doc_id) modulo 4 is not 2.
    """
    spark = df.sparkSession
    arrow_ready(spark)
    rows = df.where("doc_id is not null and text is not null and lang is not null")
    rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    counts = stage(rows.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        _count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    langs = [r["lang"] for r in totals.orderBy(F.col("total").desc(), "lang").collect()]
    tables = max(1, -(-len(langs) // MASK_BITS))
    number = spark.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, no int")
    freq = counts.join(totals, "lang").join(number, "lang").select("no", "gram", (F.col("n") / F.col("total")).alias("f"))
    greatest = freq.groupBy("gram").agg(F.max("f").alias("most"))
    typical = freq.where(F.col("f") >= MIN_FREQUENCY).join(greatest, "gram").where(F.col("f") >= MIN_RATIO * F.col("most"))

    def slots(batches):
        for b in batches:
            where = places_of(b.column("gram").to_numpy(zero_copy_only=False).view(np.uint64))
            no = b.column("no").to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.concatenate(where)
            mask = np.tile(np.int64(1) << (no % MASK_BITS), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(no // MASK_BITS, HASHES)), pa.array(place), pa.array(mask)],
                                             ["tab", "place", "mask"])

    sliced = typical.select("no", "gram").mapInArrow(slots, "tab bigint, place bigint, mask bigint").groupBy(
        "tab", "place").agg(F.bit_or("mask").alias("mask"))
    table = np.zeros((tables, PLACES), np.int64)
    # At most PLACES rows a table of 63 languages, whatever the corpus.
    got = sliced.toArrow()
    table[got["tab"].to_numpy(), got["place"].to_numpy()] = got["mask"].to_numpy()
    rates = np.array([(np.count_nonzero(table[i // MASK_BITS] >> np.int64(i % MASK_BITS) & 1) / PLACES) ** HASHES
                      for i in range(len(langs))])
    return langs, table, rates


def decide(texts: list[str | None], langs: list[str], table: np.ndarray, rates: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of every text.  Score: the language's share of all corrected counts."""
    h, doc = grams(texts)
    where = places_of(h)
    seen = np.bincount(doc, minlength=len(texts)).astype(float)
    votes = np.zeros((len(texts), max(len(langs), 1)))
    for tab in range(table.shape[0] if langs else 0):
        mask = table[tab][where[0]]
        for w in where[1:]:
            mask &= table[tab][w]
        for i in range(tab * MASK_BITS, min(len(langs), (tab + 1) * MASK_BITS)):
            hit = (mask >> np.int64(i % MASK_BITS)) & 1
            count = np.bincount(doc, hit, len(texts))
            votes[:, i] = np.maximum(0.0, (count - seen * rates[i]) / (1 - min(rates[i], 0.999)))
    total = votes.sum(axis=1)
    best = votes.argmax(axis=1)
    score = np.where(total > 0, votes[np.arange(len(texts)), best] / np.maximum(total, 1e-12), 0.0)
    named = [langs[b] if langs and has_letter(t) else "und" for t, b in zip(texts, best)]
    return named, np.where([x == "und" for x in named], 0.0, score)


def identify(df: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``df`` (columns doc_id, text).

    ``training`` (columns doc_id, text, lang) is ``df`` itself by default.  Null texts and texts without letters are
    ``und``, score 0; so is everything when no row has a language.  Ties, and texts none of whose n-grams is known,
    go to the language with the most training n-grams.  Rows without a doc_id are predicted, not learned from, and not
    held out.  Repeated rows get equal results.
    """
    spark = df.sparkSession
    langs, table, rates = train(training if training is not None else df)
    # 16 MB a table, whatever the corpus.
    model = spark.sparkContext.broadcast((langs, table, rates))

    def run(batches):
        langs, table, rates = model.value
        for batch in batches:
            for part in parts_of(batch, max_bytes=SLICE_BYTES):
                ids = part.column("doc_id")
                named, score = decide(part.column("text").to_pylist(), langs, table, rates)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([held_out(i) for i in ids.to_pylist()], pa.bool_()), pa.array(named, pa.string()),
                     pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return identify(table(spark, sf_dir, "documents"))
