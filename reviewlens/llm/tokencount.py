"""Token counts: count-only Viterbi over a unigram vocabulary.

The vocabulary is a public sentencepiece file's pieces and scores.  An Aho-Corasick automaton enumerates the pieces that
end at each character; dynamic programming carries the best score and its piece count, no segmentation.  Tie rules are
the public tokenizers' own: a later candidate wins only with a greater score, and candidates come longest first; a
character that is no piece itself is unknown, at the least score less 10, and counts one token a UTF-8 byte.

No piece goes on past a space (spaces are the mark ``▁`` at a piece's start), so chunks from one run of spaces to
the next are counted apart and cached.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_ready, parts_of

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes that the cache of chunks may take before it is emptied.
_CACHE = 64 << 20
_RUNS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Counter:
    """Best score and piece count of chunks."""

    def __init__(self, pieces: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.cache: dict[str, tuple[float, int]] = {}
        self.cached = 0

    def viterbi(self, chunk: str) -> tuple[float, int]:
        n = len(chunk)
        score: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        done = 0  # unknown characters before this end are entered

        def enter_unknown(upto):
            nonlocal done
            while done < upto:
                c = chunk[done]
                done += 1
                if c not in self.single:
                    candidate = score[done - 1] + self.unknown
                    if score[done] is None or candidate > score[done]:
                        score[done] = candidate
                        count[done] = count[done - 1] + len(c.encode("utf-8", "surrogatepass"))

        for last, (size, value) in self.automaton.iter(chunk):
            end = last + 1
            enter_unknown(last)  # every end before this one is final
            start = end - size
            candidate = value + score[start]
            if score[end] is None or candidate > score[end]:
                score[end] = candidate
                count[end] = count[start] + 1
        enter_unknown(n)
        return score[n], count[n]

    def chunk(self, chunk: str) -> tuple[float, int]:
        got = self.cache.get(chunk)
        if got is None:
            got = self.viterbi(chunk)
            if len(chunk) < 256:
                self.cached += 250 + 4 * len(chunk)
                if self.cached > _CACHE:
                    self.cache.clear()
                    self.cached = 250 + 4 * len(chunk)
                self.cache[chunk] = got
        return got

    def text(self, text: str) -> tuple[float, int]:
        """Score and tokens of a whole text; an empty one has none."""
        if not text:
            return 0.0, 0
        parts = [self.chunk(c) for c in _RUNS.findall((" " + text).replace(" ", MARK))]
        return sum(p[0] for p in parts), sum(p[1] for p in parts)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores and counts of many texts: distinct chunks once, texts with runs of spaces on their own."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.match_substring(texts, MARK), pc.match_substring(
            texts, " \n"))).to_numpy(zero_copy_only=False)
        # " a\nb c" -> chunks " a", "\nb", " c": a line feed starts a chunk without a mark.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        both = []
        for chunk in coded.dictionary.to_pylist():
            if chunk[:1] == "\n":
                line, rest = self.chunk("\n"), self.chunk(chunk[1:]) if len(chunk) > 1 else (0.0, 0)
                both.append((line[0] + rest[0], line[1] + rest[1]))
            else:
                both.append(self.chunk(MARK + chunk))
        table = np.array(both, np.float64).reshape(-1, 2)
        index = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        score = np.concatenate([[0.0], np.cumsum(table[index, 0])])
        count = np.concatenate([[0.0], np.cumsum(table[index, 1])])
        scores, counts = score[ends[1:]] - score[ends[:-1]], (count[ends[1:]] - count[ends[:-1]]).astype(np.int64)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        scores[empty], counts[empty] = 0.0, 0
        for i in np.flatnonzero(odd & ~empty):
            scores[i], counts[i] = self.text(texts[int(i)].as_py())
        return scores, counts


def vocabulary(path: str) -> dict[str, float]:
    """Normal pieces and scores of a sentencepiece file (no control, unknown, unused or byte pieces)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))}


_COUNTERS: dict[str, Counter] = {}


def counter(path: str | None = None) -> Counter:
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(vocabulary(path))
    return _COUNTERS[path]


def token_counts(df: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, score`` of every row of ``df`` (columns doc_id, text): tokens and score of the best path.

    ``path``: the vocabulary, by default the public one as installed on each worker.  Null and empty texts have no
    tokens and score 0.  Repeated rows are counted each; an empty table gives no rows.
    """
    arrow_ready(df.sparkSession)

    def run(batches):
        c = counter(path)
        for batch in batches:
            for part in parts_of(batch, max_bytes=8 << 20):
                scores, counts = c.texts(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), pa.array(scores)],
                                                 ["doc_id", "n_tokens", "score"])

    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, score double")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", F.round("score", 3).alias("score"))
