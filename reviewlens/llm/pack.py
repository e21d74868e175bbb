"""Best-fit packing by minimum bin slack.

Documents become token ids, pieces of at most ``CAPACITY`` tokens, and a histogram of piece lengths: at most CAPACITY
rows, whatever the corpus.  On the histogram, bin after bin, a bitset subset-sum program over the lengths that are left
finds the fullest feasible combination (with the longest length left in it); the combination is removed as often as
the counts allow.  The resulting patterns are bounded by the histogram too.  A piece finds its sequence by its rank among
the pieces of its length, counted over 256 hash buckets a length, so a length that many pieces share is no single task.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.rank import prefix_sums
from reviewlens.session import stage

from .common import BATCH_BYTES, arrow_ready, parts_of, ragged_take

CAPACITY = 4096
#: The id after each document.
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

#: Chunks without other characters are cut into the tokenizer's words by ``_SPLIT``: there the pattern is surely equal.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9]|[^\sa-zªµºß-öø-ÿ0-9]+")
#: Bytes of a task's caches; a full cache is emptied and filled again, results do not depend on it.
_CACHE = 48 << 20


class Encoder:
    """Token ids of texts as the tokenizer file gives them, word by word with a cache.

    No token spans white space, so a text's ids are those of its white-space-separated chunks in turn.  The merges of a
    word run in tiktoken on the file's own vocabulary: a byte that UTF-8 never has stands for the word-end mark, and a
    token's id is its merge rank.  Chunks with unusual characters go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = self._bytes_of(ByteLevel)
        special = set(self.specials)
        ranks = {}
        for token, i in self.tokenizer.get_vocab().items():
            if token not in special:
                body = token.removesuffix("</w>")
                ranks[bytes(byte_of[c] for c in body) + (b"\xff" if body != token else b"")] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.chunks: dict[str, int] = {}
        self.words: dict[str, list[int]] = {}
        self.reset()

    @staticmethod
    def _bytes_of(byte_level) -> dict[str, int]:
        """The byte that each letter of the byte-level alphabet stands for."""
        pre = byte_level(add_prefix_space=False, use_regex=False)
        out = {}
        for cp in [*range(0x80), *range(0x80, 0x800), *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]:
            if 0xD800 <= cp < 0xE000:
                continue
            raw = chr(cp).encode()
            out.update(zip(pre.pre_tokenize_str(chr(cp))[0][0], raw))
        # Letters that no text makes (bytes that UTF-8 never has) still occur in the vocabulary.
        free = iter(sorted(set(range(256)) - set(out.values())))
        for c in sorted(set(byte_level.alphabet()) - set(out)):
            out[c] = next(free)
        return out

    def reset(self) -> None:
        self.chunks.clear()
        self.words.clear()
        self.bytes = 0
        self.flat, self.starts, self.lens = array("I"), array("q"), array("q")

    def word(self, word: str) -> list[int]:
        ids = self.words[word] = self.merge.encode_single_piece(word.encode() + b"\xff")
        self.bytes += 250 + 4 * len(word) + 32 * len(ids)
        return ids

    def ids_of(self, chunk: str) -> list[int]:
        plain = (chunk.isascii() and chunk.isprintable()) or _PLAIN.fullmatch(chunk)
        if plain and not ("<|" in chunk and any(s in chunk for s in self.specials)):
            out: list[int] = []
            for w in _SPLIT.findall(chunk.lower()):
                ids = self.words.get(w)
                out += ids if ids is not None else self.word(w)
            return out
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and the end of each text's ids."""
        if self.bytes > _CACHE:
            self.reset()
        # Cut at ASCII white space alone: other white space stays inside a chunk, where the tokenizer drops it.
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        at = []
        chunks, flat, starts, lens = self.chunks, self.flat, self.starts, self.lens
        for chunk in coded.dictionary.to_pylist():
            k = chunks.get(chunk)
            if k is None:
                ids = self.ids_of(chunk)
                self.bytes += 150 + 4 * len(chunk) + 4 * len(ids)
                k = chunks[chunk] = len(starts)
                starts.append(len(flat))
                lens.append(len(ids))
                flat.extend(ids)
            at.append(k)
        entry = np.array(at, np.int64)
        if len(coded):
            entry = entry[coded.indices.to_numpy(zero_copy_only=False)]
        size = np.array(lens, np.int64)[entry]
        ids = ragged_take(np.array(flat, np.uint32), np.array(starts, np.int64)[entry], size)
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))])
        return ids, np.concatenate([[0], np.cumsum(size)])[words[1:]].astype(np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_by(path: str | None, name: str, capacity: int, end_id: int):
    """mapInArrow function: one row a piece, ``doc_id, piece, start, length, ids_crc32``."""
    def run(batches):
        enc = encoder(path or vocabulary_path(name))
        for batch in batches:
            for part in parts_of(batch, max_bytes=BATCH_BYTES // 4):
                ids, ends = enc.encode(part.column("text"))
                rows: list[tuple] = []
                start = 0
                for doc, end in enumerate(ends.tolist()):
                    own = np.append(ids[start:end], np.uint32(end_id)).astype("<u4")
                    start = end
                    for piece, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at:at + capacity]
                        rows.append((doc, piece, at, len(cut), zlib.crc32(cut.tobytes())))
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def fullest(counts: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """The longest length left and the combination of lengths that fills the rest best: {length: how often}.

    ``lengths``: those with a count, descending.  Bit s of the bitset says that some combination sums to s; it is kept
    after every item, so the fullest sum can be traced back.  Equal lengths enter in powers of two up to their count.
    """
    first = lengths[0]
    room = capacity - first
    full = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for n in lengths:
        left = min(counts[n] - (n == first), room // n) if n <= room else 0
        times = 1
        while left > 0:
            k = min(times, left)
            trail.append((n, k, reach))
            reach |= (reach << (n * k)) & full
            left -= k
            times *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    pattern = {first: 1}
    for n, k, before in reversed(trail):
        if not before >> total & 1:
            pattern[n] = pattern.get(n, 0) + k
            total -= n * k
    return pattern


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns and how many bins each fills, until every piece has a place."""
    counts = {n: c for n, c in histogram.items() if c}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        pattern = fullest(counts, lengths, capacity)
        bins = min(counts[n] // k for n, k in pattern.items())
        out.append((pattern, bins))
        for n, k in pattern.items():
            counts[n] -= k * bins
        lengths = [n for n in lengths if counts[n]]
    return out


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to the pieces; all rows of one sequence follow each other without a gap."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = []  # (length, first rank, ranks a bin, first sequence, offset of the first): one row a pattern and length
    rank, sequence = {}, 0
    for pattern, bins in plan(histogram, capacity):
        offset = 0
        for n in sorted(pattern, reverse=True):
            k = pattern[n]
            places.append((n, rank.get(n, 0), rank.get(n, 0) + k * bins, k, sequence, offset))
            rank[n] = rank.get(n, 0) + k * bins
            offset += n * k
        sequence += bins
    slots = spark.createDataFrame(places, "length bigint, lo bigint, hi bigint, k bigint, first_sequence bigint, base bigint")
    by_length = slots.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "k", "first_sequence", "base")))
                                            .alias("slots"))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(256))
    ranked = prefix_sums(pieces, bucket, [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")],
                         {"_rank": F.lit(1).cast("bigint")}, partition_by=["length"])
    # The slots are bounded by the histogram (capacity lengths), whatever the number of pieces.
    d = ranked.join(F.broadcast(by_length), "length").withColumn("_r", F.col("_rank") - 1)
    d = d.withColumn("_s", F.filter("slots", lambda s: (s["lo"] <= F.col("_r")) & (F.col("_r") < s["hi"]))[0])
    nth = F.col("_r") - F.col("_s.lo")
    inside = F.pmod(nth, F.col("_s.k"))
    d = d.withColumn("sequence_id", (F.col("_s.first_sequence") + (nth - inside) / F.col("_s.k")).cast("bigint"))
    d = d.withColumn("offset", F.col("_s.base") + inside * F.col("length"))
    return d.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack(df: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack every row of ``df`` (columns doc_id, text) into sequences of at most ``capacity`` tokens.

    ``path``: the tokenizer file, by default the public one as installed on each worker.  A null or empty text is the end
    id alone; longer texts than a sequence are cut.  Repeated rows are packed each; a null doc_id is kept.  An empty
    table gives no rows.
    """
    arrow_ready(df.sparkSession)
    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = stage(docs.mapInArrow(pieces_by(path, VOCABULARY, capacity, end_id),
                                   f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"), "pieces")
    return packed(pieces, capacity)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return pack(table(spark, sf_dir, "documents"))
