"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.session import ship_package

#: ASCII white space, as the contracts write it, and a run of anything else.
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one Arrow batch hands to a Python worker; a single longer text is a batch of its own.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_ready(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (long texts) and make the package importable in Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """Second half of the row key (doc_id, text hash): equal keys are repeated rows."""
    return F.xxhash64(text_or_empty(name))


def numbered(df: DataFrame, *apart: str) -> list[Column]:
    """All columns but ``apart`` under the names ``_c0, _c1, ...``, so that helper columns cannot clash with them."""
    return [df[c].alias(f"_c{i}") for i, c in enumerate(df.columns) if c not in apart]


def renamed(columns: list[str], **new: Column) -> list[Column]:
    """The columns of ``numbered`` under their own names, those in ``new`` with their new values."""
    return [(new[c] if c in new else F.col(f"_c{i}")).alias(c) for i, c in enumerate(columns)]


def parts_of(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 4 << 20):
    """Cut a record batch into slices of about ``max_bytes`` of text, so numpy temporaries stay small."""
    n = batch.num_rows
    if not n:
        return
    lens = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < n:
        base = lens[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(lens, base + max_bytes, side="right")))
        yield batch.slice(start, end - start)
        start = end


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """ASCII-white-space words of every text: (distinct words, index of each word, word offsets by text).

    Nulls count as empty texts.  Offsets has one entry more than there are texts.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    # Leading and trailing white space leave empty strings; they are no words.
    keep = np.asarray(pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False), bool)
    sizes = np.asarray(pc.list_value_length(lists).to_numpy(zero_copy_only=False), np.int64)
    ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(sizes)])]
    coded = words.filter(pa.array(keep)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends


def ragged_take(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[s:s+n]`` over all (s, n), without a Python loop."""
    ends = np.cumsum(lens)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    shift = np.repeat(starts - (ends - lens), lens)
    return flat[np.arange(ends[-1]) + shift]
