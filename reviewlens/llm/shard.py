"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Every row gets a dense global number (rows in the order of a seeded hash of doc_id, then doc_id, size and checksum);
the permutation of 0..N-1 turns it into a place in the shuffled corpus, and place p sits in shard p mod K at slot
p div K.  So shard sizes differ by one row at most, slots have no gaps, the same input gives the same result, and
shard and slot of any row number can be computed without the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import with_computed
from reviewlens.operators.rank import prefix_sums, seeded_hash
from reviewlens.session import stage

from .permute import halves, permuted

SHARDS = 24
SEED = 20240607


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, row_number, shard, slot`` for every row of ``df`` (columns doc_id, text).

    Null text: no bytes, size 8, checksum 0 (that of no bytes).  A null doc_id is hashed as the text ``null``.  Repeated
    rows are rows of their own with places of their own; which of them gets which place is left open, as they are equal.
    An empty table gives no rows.  Other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    base = stage(df.select("doc_id", (F.octet_length(body) + 8).cast("bigint").alias("size"),
                           F.crc32(body).alias("text_crc32")), "shard")
    n = base.count()
    order = seeded_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), seed)
    # 4,096 buckets of the hash: totals per bucket are a bounded table, rows of a bucket are numbered in one task.
    numbered = prefix_sums(base.withColumn("_h", order), F.substring("_h", 1, 3),
                           [F.col("_h"), F.col("doc_id"), F.col("size"), F.col("text_crc32")],
                           {"_n": F.lit(1).cast("bigint")}, bounded_buckets=True)
    total = F.lit(max(n, 1)).cast("bigint")
    a, b = halves(total)
    placed = with_computed(numbered.withColumn("row_number", F.col("_n") - 1),
                           _p=permuted(F.col("row_number"), total, a, b, F.lit(seed).cast("bigint")))
    return placed.select("doc_id", "size", "text_crc32", "row_number", (F.col("_p") % shards).cast("int").alias("shard"),
                         ((F.col("_p") - F.col("_p") % shards) / shards).cast("bigint").alias("slot"))


def op8_shards(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
