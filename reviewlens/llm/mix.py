"""Mixing sources to target weights.

Each source's words, document after document in a seeded order, form one stream that is cut into blocks of
``BLOCK`` words.  A source's target (its share of the whole, capped at three times its size, the excess shared anew)
makes a quota of blocks.  Output shard by output shard, the sources' slot counts are drawn from a multinomial over
what is left of the quotas; the last shard takes the rest, so draws decide where a source's blocks go and every total
meets its quota.  Slot j of a source is block perm(j mod blocks) of its pass j div blocks, where each source and pass has
a pseudorandom permutation of its own (Feistel, computed by index, no shuffle).  Slots and blocks are joined by index.

What the driver holds is one row a source and shard: names, sizes and counts, never rows of a source.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.columns import with_computed
from reviewlens.operators.rank import prefix_sums
from reviewlens.session import stage

from .common import WORD, arrow_ready, numbered, parts_of, renamed, text_key
from .permute import halves, permuted

#: Weights of the sources in their order, repeated.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source, and so no document, is taken more often than this.
MOST = 3
BLOCK = 64
SHARDS = 64
SEED = 20240605
#: Slots that one row of the plan unrolls to at a time.
_RUN = 4096
#: Runs a task unrolls, and the most tasks.  Runs are tiny until unrolled, so their bytes say nothing about the work.
_RUNS_A_TASK, _MOST_TASKS = 32, 20_000


def word_counts(texts) -> np.ndarray:
    """ASCII-white-space words of every text, counted in the bytes of the whole Arrow column."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or ends[0] == ends[-1]:
        return np.zeros(len(texts), np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = ends[:-1][ends[:-1] < len(raw)]
    begins[firsts] = solid[firsts]  # a text's first byte follows no other
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[ends[1:]] - total[ends[:-1]]


def _sizes(batches):
    import pyarrow as pa

    for batch in batches:
        for part in parts_of(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("h"), part.column("source"), pa.array(word_counts(part.column("text")))],
                ["doc_id", "h", "source", "size"])


def targets(sizes: list[int], weights=WEIGHTS, most: float = MOST) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times its size; the excess goes to the others by weight."""
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    open_ = [i for i in range(len(sizes)) if sizes[i]]
    left = total
    while open_:
        share = left / sum(weight[i] for i in open_)
        full = [i for i in open_ if share * weight[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share * weight[i]
            break
        for i in full:
            out[i] = most * float(sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def quotas(target: list[float], sizes: list[int], blocks: list[int], most: int = MOST) -> np.ndarray:
    """Whole numbers of blocks nearest to the targets; a source's last block may be short, so by mean block size."""
    exact = np.array([t * b / s if s else 0.0 for t, s, b in zip(target, sizes, blocks)])
    return np.minimum(np.rint(exact), most * np.array(blocks, float)).astype(np.int64)


def draw(quota: np.ndarray, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots by (shard, source): multinomial over what is left of the quotas, the last shard takes the rest."""
    rng, left = np.random.default_rng(seed), quota.copy()
    out = np.zeros((shards, len(quota)), np.int64)
    for shard in range(shards):
        total = int(left.sum())
        if not total:
            break
        if shard == shards - 1:
            out[shard] = left
            break
        n = total // (shards - shard)
        out[shard] = np.minimum(rng.multinomial(n, left / total), left)
        left = left - out[shard]
    return out


def mix(df: DataFrame, weights=WEIGHTS, most: int = MOST, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED):
    """The mix of ``df`` (columns doc_id, text, source): (documents, slots).

    documents: ``doc_id, h, source, size, source_size, target, start, n, source_no`` by row: ``h`` the text's hash, ``start`` where
    it begins in its source's stream, ``n`` the row's number there.  slots: ``source_no, block, pass, shard, slot`` by
    slot of the mix.  Null and empty texts have size 0 and are in no block; a null source is a source, the last one;
    repeated rows are rows of their own.  A corpus without words has no slots.  The driver holds a number for each source and
    shard: sources are names, not a column as wide as URLs.
    """
    spark = df.sparkSession
    arrow_ready(spark)
    docs = df.select("doc_id", text_key().alias("h"), F.col("source").cast("string").alias("source"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = stage(docs.mapInArrow(_sizes, f"doc_id {kind}, h bigint, source string, size bigint"), "sizes")
    rows = base.groupBy("source").agg(F.sum("size").alias("size")).collect()
    # UTF-8 bytes sort as code points do.
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["size"]) for r in rows]
    blocks = [-(-s // block) for s in sizes]
    target = targets(sizes, weights, most)
    table = spark.createDataFrame(
        [(i, r["source"], sizes[i], float(target[i]), blocks[i]) for i, r in enumerate(rows)],
        "source_no int, _source string, source_size bigint, target double, blocks bigint")
    # One row a source; the planner broadcasts it while it is small.
    named = base.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # 1,024 hash buckets a source, so one that holds a third of all rows is many tasks.
    placed = prefix_sums(named, F.pmod(F.xxhash64("doc_id", "h", F.lit(seed)), F.lit(1024)),
                         [F.col("doc_id"), F.col("h")], {"_end": F.col("size"), "n": F.lit(1).cast("bigint")},
                         partition_by=["source_no"])
    documents = stage(placed.select("doc_id", "h", "source", "size", "source_size", "target", "source_no", "blocks", "n",
                                    (F.col("_end") - F.col("size")).alias("start")), "placed")

    counts = draw(quotas(target, sizes, blocks, most), shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    runs = [(i, s, int(first[s, i]), int(counts[s, i]), blocks[i])
            for s in range(counts.shape[0]) for i in range(counts.shape[1]) if counts[s, i]]
    plan = spark.createDataFrame(runs, "source_no int, shard int, first bigint, k bigint, blocks bigint")
    plan = plan.select("*", F.explode(F.expr(f"sequence(0L, (k - 1L) div {_RUN}L)")).alias("run"))
    tasks = min(_MOST_TASKS, 1 + sum(-(-r[3] // _RUN) for r in runs) // _RUNS_A_TASK)
    plan = plan.repartition(tasks, "source_no", "shard", "run")
    slots = plan.select("source_no", "shard", "blocks", F.explode(F.expr(
        f"sequence(first + run * {_RUN}L, first + least(k, (run + 1L) * {_RUN}L) - 1L)")).alias("slot"))
    slots = slots.withColumn("pass", F.expr("slot div blocks"))
    a, b = halves(F.col("blocks"))
    key = F.xxhash64("source_no", "pass", F.lit(seed))
    slots = with_computed(slots.withColumns({"_a": a, "_b": b, "_k": key}), block=permuted(
        F.expr("slot % blocks"), F.col("blocks"), F.col("_a"), F.col("_b"), F.col("_k")))
    return documents, slots.select("source_no", "block", "pass", "shard", "slot")


def in_blocks(documents: DataFrame, block: int) -> DataFrame:
    """``source_no, n, block, lo, hi``: the words lo to hi (not included) of each row that lie in each of its blocks."""
    some = documents.where("size > 0").select("source_no", "n", "start", "size", F.explode(F.expr(
        f"sequence(start div {block}L, (start + size - 1L) div {block}L)")).alias("block"))
    return some.select("source_no", "n", "block",
                       F.greatest(F.col("block") * block - F.col("start"), F.lit(0).cast("bigint")).alias("lo"),
                       F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")).alias("hi"))


def taken(documents: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """``documents`` with ``taken``: the words that the mix takes of each row, repeats counted."""
    times = slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    own = in_blocks(documents, block).join(times, ["source_no", "block"]).groupBy("source_no", "n").agg(
        F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
    return documents.join(own, ["source_no", "n"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))


def mixed_documents(df: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mix as documents: for every pass that takes words of a row, the row with the taken words as its text.

    A pass that takes all words keeps the text as it is; else the taken words are joined by single spaces.  ``n_chars`` is
    counted anew; the other columns stay.  Rows that no slot takes are left out, as the targets say.  Rows of equal doc_id, text
    and source are joined as one with the choices of all of them; an empty table gives no rows.
    """
    documents, slots = mix(df, block=block, **options)
    parts = in_blocks(documents, block).join(slots.select("source_no", "block", "pass"), ["source_no", "block"])
    own = parts.groupBy("source_no", "n", "pass").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("_parts"), F.sum(F.col("hi") - F.col("lo")).alias("_words"))
    chosen = own.join(documents.select("source_no", "n", "doc_id", "h", "source", "size"), ["source_no", "n"])
    # Repeated rows: one of each (doc_id, text, source) is joined with the choices of all its copies.
    repeated = documents.groupBy("doc_id", "h", "source").count().where("count > 1")
    one = df if repeated.isEmpty() else df.dropDuplicates(["doc_id", "text", "source"])
    rows = one.select(*numbered(df, "text"), df["doc_id"].alias("_id"), df["source"].cast("string").alias("_from"),
                      text_key().alias("_key"), df["text"].alias("_t"))
    d = rows.join(chosen, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("h")) &
                  F.col("_from").eqNullSafe(F.col("source")))
    words = F.regexp_extract_all(F.coalesce("_t", F.lit("")), F.lit(WORD), F.lit(0))
    whole = F.col("_words") == F.col("size")
    d = with_computed(d, _w=F.when(whole, F.lit(None)).otherwise(words))
    picked = F.flatten(F.transform("_parts", lambda p: F.slice(F.col("_w"), (p["lo"] + 1).cast("int"),
                                                              (p["hi"] - p["lo"]).cast("int"))))
    d = with_computed(d, _text=F.when(whole, F.col("_t")).otherwise(F.array_join(picked, " ")))
    return d.select(*renamed(df.columns, text=F.col("_text"), n_chars=F.length("_text").cast("bigint")))


def op5_mix(spark, sf_dir: str) -> DataFrame:
    from .common import table

    documents, slots = mix(table(spark, sf_dir, "documents"))
    return taken(documents, slots).select("doc_id", "size", "source_size", "target", "taken")
