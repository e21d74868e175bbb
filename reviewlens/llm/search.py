"""Ranked lexical search by scanning the documents with an automaton.

All terms of a block of items go into one Aho-Corasick automaton, each between two guards (a space): texts are brought
to lower-case terms between spaces, so a match is a whole term, and every task counts term frequencies straight from
the text.  No index of the documents is made.  Two scans:

1. documents with terms, all their terms, and the number of documents that hold each of the items' terms;
2. scores.  The automaton's outputs lead from a term to the items that hold it; a task keeps each item's best ``k``
   documents of those it reads, so ``items x k`` rows a task meet in the last ranking.

Items are taken in blocks of at most ``BLOCK_CHARS`` characters of terms; that bounds the automaton which is broadcast.
Scores are whole numbers below 2**53 per block of documents (checked), so sums in doubles are exact.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_ready, parts_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Characters of distinct terms in one block of items (the automaton takes some tens of bytes for each).
BLOCK_CHARS = 1 << 20
#: Documents are scored together while they are so few, with so few (document, item, term) entries and table cells.
ROWS, ENTRIES, CELLS = 256, 1 << 19, 1 << 21
K1_MILLI, BASE, LENGTH_PERCENT = 1000, 10**9, 90
EXACT = 1 << 53

#: Bytes of a text to bytes of its terms: A-Z in lower case, what is in no term a space, all others as they are.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def folded(text: str | None) -> bytes:
    """The terms of a text in lower case, spaces between and around them."""
    return b" " + (text or "").encode().translate(_BYTES) + b" "


def terms(text: str | None) -> list[str]:
    return folded(text).decode().split(" ")


class Block:
    """Items of one block: distinct terms, and for each term the items that hold it."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        held = [sorted(set(terms(t)) - {""}) for _, t in items]
        self.terms = sorted(set().union(*held)) if held else []
        number = {t: i for i, t in enumerate(self.terms)}
        pairs = sorted((number[t], i) for i, ts in enumerate(held) for t in ts)
        self.items = np.array([i for _, i in pairs], np.int64)
        counts = np.bincount([t for t, _ in pairs], minlength=len(self.terms)) if pairs else np.zeros(len(self.terms), int)
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}  # built where it is used

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms that a folded text holds, and how often."""
        if not self.terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                self._automaton.add_word(f" {t} ", i)
            self._automaton.make_automaton()
        found = np.fromiter((i for _, i in self._automaton.iter(text.decode())), np.int64)
        return np.unique(found, return_counts=True)


def blocks_of(items: DataFrame) -> list[Block]:
    """All items, in blocks.  The items are the stated query set; they pass the driver a block at a time."""
    out, held, chars = [], [], 0
    for r in items.select("item_id", "text").orderBy("item_id").toLocalIterator():
        held.append((r[0], r[1]))
        chars += sum(map(len, set(terms(r[1]))))
        if chars > BLOCK_CHARS:
            out.append(Block(held))
            held, chars = [], 0
    return out + ([Block(held)] if held else [])


def ragged_places(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places s, s + 1, ... s + n - 1 of all (s, n), one after the other."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lens), lens)


def _statistics(block: Block):
    def run(batches):
        n_docs = n_terms = 0
        df = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for part in parts_of(batch):
                for text in part.column("text").to_pylist():
                    f = folded(text)
                    n = len(f.split())
                    n_docs, n_terms = n_docs + (n > 0), n_terms + n
                    df[block.counts(f)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([n_docs, n_terms, *df[at].tolist()], pa.int64())],
            ["term", "n"])

    return run


def _merged(best, scores, docs, k: int):
    """The ``k`` best (score descending, doc_id ascending, null last) of what was kept and the new ones."""
    best = best + list(zip(scores, docs))
    best.sort(key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
    return best[:k]


def _scored(block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    n_items = len(block.ids)

    def run(batches):
        best = [[] for _ in range(n_items)]
        least = np.ones(n_items)  # scores below this cannot enter
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in parts_of(batch):
                ids, held, entries = [], [], 0
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    got = entry(text)
                    if got is None:
                        continue
                    ids.append(doc_id)
                    held.append(got)
                    entries += len(got[0])
                    if len(ids) >= ROWS or entries > ENTRIES or len(ids) * n_items > CELLS:
                        keep(ids, held, best, least)
                        ids, held, entries = [], [], 0
                if ids:
                    keep(ids, held, best, least)
        rows = [(block.ids[i], d, int(s)) for i, kept in enumerate(best) for s, d in kept]
        if rows:
            items, docs, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(docs, id_type), pa.array(scores, pa.int64())],
                                             ["item_id", "doc_id", "score"])

    def entry(text):
        """(items, values) of a document's terms, an entry for each item that holds the term."""
        f = folded(text)
        found, tf = block.counts(f)
        if not len(found):
            return None
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * len(f.split()) * n_docs) // n_terms
        value = weights[found] * ((BASE * tf) // (K1_MILLI * tf + 8 * m))
        a, n = block.starts[found], block.starts[found + 1] - block.starts[found]
        return block.items[ragged_places(a, n)], np.repeat(value, n)

    def keep(ids, held, best, least):
        rows = np.repeat(np.arange(len(ids)), [len(i) for i, _ in held])
        cells = rows * n_items + np.concatenate([i for i, _ in held])
        total = np.bincount(cells, np.concatenate([v for _, v in held]).astype(float), len(ids) * n_items)
        if total.max() >= EXACT:
            raise OverflowError("a score left the range of exact sums")
        table = total.reshape(len(ids), n_items)
        for i in np.flatnonzero((table >= least).any(axis=0)):
            at = np.flatnonzero(table[:, i] >= least[i])
            best[i] = _merged(best[i], table[at, i].tolist(), [ids[r] for r in at], k)
            if len(best[i]) == k:
                least[i] = best[i][-1][0]

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``k`` best documents with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text.  Null texts and texts without terms match nothing; items
    without a match have no rows, nor has anything if a table is empty.  Every row of ``docs`` is a document, repeated rows
    too; equal scores go by ascending doc_id, null last.  Repeated items are ranked each.
    """
    spark = docs.sparkSession
    arrow_ready(spark)
    kinds = [items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()]
    best = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    for block in blocks_of(items):
        found = docs.select("text").mapInArrow(_statistics(block), "term bigint, n bigint")
        counts = dict(found.groupBy("term").agg(F.sum("n")).collect())  # at most the block's terms
        n_docs, n_terms = counts.get(-2, 0), counts.get(-1, 0)
        if not n_terms:
            break
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1)))
                            for i in range(len(block.terms))], np.int64)
        # Items go by their place in the block, which tells repeated ids apart.
        names, block.ids = block.ids, list(range(len(block.ids)))
        one = docs.select("doc_id", "text").mapInArrow(_scored(block, weights, n_docs, n_terms, k),
                                                       f"item_id bigint, doc_id {kinds[1]}, score bigint")
        order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        one = one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        known = spark.createDataFrame(list(enumerate(names)), f"_i bigint, _name {kinds[0]}")
        one = one.join(F.broadcast(known), F.col("item_id") == F.col("_i"))
        best = best.union(one.select("_name", "rank", "doc_id", "score"))
    return best


def op13_search(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
