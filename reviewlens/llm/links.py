"""Links between texts: exact confirmation of candidate pairs, and components of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import drop, stage

from .common import parts_of
from .shingles import shingle_sets, similar

#: Partners that one task confirms against one text; a text with more partners is dealt to several tasks.
PARTNERS = 2_000
#: So many keys of rows (an id of at most 16 bytes, doc_id, hash) are broadcast to the documents: some ten MB.  More are joined by key.
NAMED = 1 << 18


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The distinct pairs (a, b) whose shingle sets are ``percent`` alike; ``texts`` has ``id, text``.

    Texts travel, not sets.  Pairs meet at ``b``: its text once a task, the partners' texts streamed behind it, so each
    text moves once a pair it is partner in, and a text with many partners is dealt out by ``PARTNERS``.  Who meets whom
    is written first: a narrow table of known size, so Spark broadcasts it where it is small and no other text moves.
    Gives a written table.
    """
    pairs = pairs.select("a", "b").distinct()
    dealt = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select(
        "b", F.ceil(F.col("n") / PARTNERS).cast("int").alias("parts"))
    placed = pairs.join(dealt, "b").select(
        "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.col("a").alias("id"))
    kind = texts.schema["id"].dataType.simpleString()
    meeting = stage(placed.select("*", F.lit(1).alias("turn")).unionByName(
        placed.select("b", "part").distinct().select("b", "part", F.col("b").alias("id"), F.lit(0).alias("turn"))), "meeting")
    rows = meeting.join(texts, "id").repartition("b", "part").sortWithinPartitions("b", "part", "turn").select(
        "turn", "id", "text")

    def run(batches):
        head = None
        for batch in batches:
            for part in parts_of(batch, max_bytes=1 << 20):
                found = []
                ids = part.column("id").to_pylist()
                for first, name, s in zip(part.column("turn").to_pylist(), ids, shingle_sets(part.column("text"), shingle)):
                    if first == 0:
                        head = (name, s)
                    elif similar(head[1], s, percent):
                        found.append((name, head[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in found], part.schema.field("id").type) for i in (0, 1)], ["a", "b"])

    out = stage(rows.mapInArrow(run, f"a {kind}, b {kind}"), "links")
    drop(meeting)
    return out


def texts_of(docs: DataFrame, keys: DataFrame, repeated: bool) -> DataFrame:
    """Written ``id, text`` of the rows of ``docs`` (doc_id, text) that ``keys`` (id, doc, hash) name.

    ``keys`` is written and counted: up to ``NAMED`` are broadcast, so that documents stay where they are; beyond, both sides
    are shuffled by key.  Only where rows are ``repeated`` are texts shuffled to keep one of each.
    """
    if keys.count() <= NAMED and docs.schema["doc_id"].dataType.typeName() in ("long", "integer"):
        keys = F.broadcast(keys)
    d = docs.withColumn("_h", F.xxhash64("text"))
    d = d.join(keys, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_h") == F.col("hash"))).select("id", "text")
    return stage(d.dropDuplicates(["id"]) if repeated else d, "texts")


def has_repeats(rows: DataFrame) -> bool:
    """Whether two rows have equal doc_id and text hash ``h``."""
    return not rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links (a, b): root is the least node of its component."""
    both = stage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                 .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    label = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("root")), "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("m"))
        step = label.join(near, F.col("node") == F.col("u")).select("node", F.col("root").alias("old"),
                                                                    F.least("root", "m").alias("root"))
        jump = label.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = stage(step.join(jump, "root", "left").select(
            "node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), "labels")
        drop(label)
        label = new
        if new.where("old <> root").isEmpty():
            drop(both)
            out = new.select("node", "root")
            out._stage_path = new._stage_path
            return out


def with_root(df: DataFrame, label: DataFrame, node: str, root: str) -> DataFrame:
    """Add ``root`` of ``node``: its component, or itself where it has no link."""
    named = label.select(F.col("node").alias(node), F.col("root").alias("_r"))
    return df.join(named, node, "left").withColumn(root, F.coalesce("_r", node)).drop("_r")


def joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after ``links`` (a, b) too.  A link counts once a pair of components, however many members it joins."""
    merged = with_root(with_root(links, label, "a", "ra"), label, "b", "rb").where("ra <> rb").select(
        F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
    parts = label.select("node", F.col("root").alias("part"))
    roots = components(merged)
    out = stage(with_root(parts, roots, "part", "root").select("node", "root"), "labels")
    drop(roots, label)
    return out
