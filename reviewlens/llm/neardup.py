"""MinHash near-dedup by HyperMinHash.

A text's set is its distinct 4-word shingles (64-bit hashes).  The hash space is cut into 128 buckets by the top bits; a
bucket's register keeps its least hash as the count of leading zeros (6 bits) and 10 mantissa bits.  Four registers make
a band's 64-bit key, so 32 numbers hold the whole sketch.  Texts that share a band key are candidates: at a similarity
of 0.8 a band agrees with chance 0.41, all 32 fail with 5e-8.

Equal sets are one *node* from the start.  Then, without emitting the pairs within a group:

1. *Star.*  In every bucket (band, key) one member, another in each band, is the hub.  Each node is compared with the
   hub of its buckets that the registers say is most alike, exactly; links give components.
2. *Further hubs.*  In a bucket of more than ``SMALL``, members outside its largest component meet a hub chosen anew within
   that component, in ``ROUNDS`` rounds that take a part of the bands each; this leaves few outside before the exact passes.
3. *Rest, small buckets.*  Members of different components in a bucket of at most ``SMALL`` are compared in pairs.
4. *Rest, large buckets.*  Members outside the bucket's largest component meet the others by an exact prefix join:
   similar sets share one of their rarest shingles, at a place that the bound on sizes allows.

Pairs pass a test of their sizes and the collision-corrected estimate (less five standard errors) before they are confirmed on
full sets.
Components of all links are found by least labels and pointer jumping; every step is a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import drop, stage

from .common import arrow_ready, numbered, parts_of, renamed
from .links import components, confirmed, has_repeats, joined, texts_of, with_root
from .shingles import set_name, shingle_sets

SHINGLE = 4
REGISTERS, BUCKET_BITS, MANTISSA = 128, 7, 10
BANDS = 32
EMPTY = 0xFFFF
SIMILAR = 80  # per cent
#: Buckets up to this size compare members of different components in pairs; larger ones use the prefix join.
SMALL = 40
#: Rounds of further hubs; what they leave goes through the exact passes.
ROUNDS = 3


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(texts x 32) band keys: four 16-bit registers each, register j of a text in band j % 32."""
    starts = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    least = np.zeros((len(sets), REGISTERS), np.uint64)
    full = np.zeros((len(sets), REGISTERS), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, starts)
        ends = np.append(at[1:], len(s))
        full[i] = at < ends
        least[i, full[i]] = s[at[full[i]]]
    rest = (least << np.uint64(BUCKET_BITS)) | np.uint64(1)
    _, exponent = np.frexp(rest.astype(np.float64))
    zeros = (64 - np.minimum(exponent, 64)).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    registers = np.where(full, (zeros << np.uint64(MANTISSA)) | mantissa, np.uint64(EMPTY))
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for q in range(REGISTERS // BANDS):
        keys |= registers[:, q * BANDS:(q + 1) * BANDS] << np.uint64(16 * q)
    return keys.view(np.int64)


def _sign(shingle: int):
    def run(batches):
        for batch in batches:
            for part in parts_of(batch, max_bytes=1 << 20):
                sets = shingle_sets(part.column("text"), shingle)
                flat = pa.array(sketches(sets).reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_name(s) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat)],
                    ["doc_id", "h", "n_shingles", "node", "bands"])

    return run


def _sets(shingle: int):
    """The texts' sets as arrays ``s``, with the other columns."""
    def run(batches):
        for batch in batches:
            for part in parts_of(batch, max_bytes=1 << 20):
                sets = shingle_sets(part.column("text"), shingle)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("node", "root", "outside")],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "root", "outside", "s"])

    return run


def _slot_counts(slots: int):
    """``slot, n``: shingles of the task's sets by hashed slot, one row a slot that has any."""
    def run(batches):
        seen = np.zeros(slots, np.int64)
        for batch in batches:
            flat = batch.column("s").flatten().to_numpy()
            seen += np.bincount(flat & (slots - 1), minlength=slots)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["slot", "n"])

    return run


def _heads(df: np.ndarray):
    """A row for each shingle ``s`` of a set's head, with its place ``at`` in the order of (slot's count, s) and the set's size ``n``.

    A set of n must share one of its first n - ceil(0.8 n) + 1 with any similar set, whatever the order, as long as it is
    one for all sets.
    """
    def run(batches):
        for batch in batches:
            lists = batch.column("s")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows, at, out = [], [], []
            for i in range(batch.num_rows):
                s = flat[ends[i]:ends[i + 1]]
                head = s[np.lexsort((s, df[s & (len(df) - 1)]))[:len(s) - -(-len(s) * SIMILAR // 100) + 1]]
                rows.append(np.full(len(head), i))
                at.append(np.arange(len(head), dtype=np.int32))
                out.append(head)
            if not out:
                continue
            of = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(of)) for c in ("node", "root", "outside")],
                 pa.array(np.diff(ends)[of].astype(np.int64)), pa.array(np.concatenate(at)), pa.array(np.concatenate(out))],
                ["node", "root", "outside", "n", "at", "s"])

    return run


def heads(sets: DataFrame) -> DataFrame:
    """Written ``node, root, outside, n, at, s``: the rarest shingles of every set, as far as a similar set must share one.

    ``sets`` is written, with ``s`` the array of a set.  How rare a shingle is goes by its hashed slot: 2^16 numbers, up to
    2^20 where there are more shingles, are all that the driver sees.  Shingles are ordered where their set is, so only heads move.
    """
    total = sets.agg(F.sum(F.size("s").cast("bigint"))).first()[0] or 0
    slots = 1 << min(max((total // 32).bit_length(), 16), 20)
    counted = sets.select("s").mapInArrow(_slot_counts(slots), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    df = np.zeros(slots, np.int64)
    rows = counted.toArrow()
    df[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return stage(sets.mapInArrow(_heads(df), "node binary, root binary, outside boolean, n bigint, at int, s bigint"), "heads")


def estimate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of two arrays of sketches (pairs x bands), and their standard errors at the threshold."""
    x, y = (np.ascontiguousarray(v, np.int64).view(np.uint16) for v in (x, y))
    same = x == y
    empty = np.count_nonzero(same & (x == EMPTY), axis=1)
    used = np.maximum(x.shape[1] - empty, 1)
    by_chance = 1 / (3 * 2.0 ** MANTISSA)
    share = (np.count_nonzero(same, axis=1) - empty) / used
    return (share - by_chance) / (1 - by_chance), np.sqrt(0.16 / used)


def _likely(batches):
    for batch in batches:
        ba, bb = (batch.column(c).flatten().to_numpy().reshape(-1, BANDS) for c in ("ba", "bb"))
        est, error = estimate(ba, bb)
        keep = pa.array(est >= SIMILAR / 100 - 5 * error)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).filter(keep) for c in ("a", "b")], pa.array(est).filter(keep)], ["a", "b", "est"])


def alike_in_size(x, y) -> Column:
    """Whether sets of ``x`` and ``y`` shingles can be similar at all."""
    return 100 * F.least(x, y) >= SIMILAR * F.greatest(x, y)


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b, est) whose registers do not rule the similarity out, nor their sizes ``n`` where the nodes have them."""
    sizes = "n" in nodes.columns
    left = nodes.select(F.col("node").alias("a"), F.col("bands").alias("ba"), *([F.col("n").alias("na")] if sizes else []))
    right = nodes.select(F.col("node").alias("b"), F.col("bands").alias("bb"), *([F.col("n").alias("nb")] if sizes else []))
    d = pairs.join(left, "a").join(right, "b")
    if sizes:
        d = d.where(alike_in_size("na", "nb"))
    return d.select("a", "b", "ba", "bb").mapInArrow(_likely, "a binary, b binary, est double")


def linked(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``confirmed`` of pairs that are written first: it reads them several times."""
    pairs = stage(pairs.select("a", "b").distinct(), "likely")
    out = confirmed(pairs, texts, shingle, SIMILAR)
    drop(pairs)
    return out


def further_hubs(members: DataFrame, label: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``label`` after members outside a large bucket's main component met hubs of it, one a bucket, in the round of its band.

    A pair at the threshold shares 13 of 32 bands on average and one of a round's with chance 0.996, so a third of the rows
    finds nearly all that every band would, and the next round starts from its links.
    """
    large = members.where(F.col("size") > SMALL).select("node", "band", "key")
    for turn in range(1, ROUNDS + 1):
        m = with_root(large.where(F.col("band") % ROUNDS == turn - 1), label, "node", "root")
        parts = m.groupBy("band", "key", "root").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "band", F.lit(turn)).alias("h"), "node")).alias("hub"))
        main = parts.groupBy("band", "key").agg(
            F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "root", "hub")).alias("main")).where("parts > 1")
        pairs = m.join(main, ["band", "key"]).where(F.col("root") != F.col("main.root")).select(
            F.col("node").alias("a"), F.col("main.hub.node").alias("b")).distinct()
        found = linked(likely(pairs, nodes), texts, shingle)
        if found.isEmpty():
            drop(found)
            continue
        label = joined(label, found)
        drop(found)
    return label


def rest_pairs(members: DataFrame, label: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Written candidate pairs between components, from small and from large buckets."""
    m = with_root(members.select("node", "n", "band", "key", "size"), label, "node", "root")
    mixed_buckets = m.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    m = stage(m.join(mixed_buckets.select("band", "key"), ["band", "key"]), "mixed")
    small = m.where(F.col("size") <= SMALL)
    one = small.select("band", "key", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"))
    two = small.select("band", "key", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"))
    in_small = one.join(two, ["band", "key"]).where(F.expr("a < b and ra <> rb") & alike_in_size("na", "nb")).select("a", "b").distinct()

    large = m.where(F.col("size") > SMALL)
    parts = large.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("band", "key").agg(F.max(F.struct("n", "root")).alias("main"))
    outside = (large.join(main, ["band", "key"]).groupBy("node").agg(
        F.max(F.col("root") != F.col("main.root")).alias("outside"), F.min("root").alias("root")))
    sets = stage(outside.join(texts.withColumnRenamed("id", "node"), "node").mapInArrow(
        _sets(shingle), "node binary, root binary, outside boolean, s array<bigint>"), "sets")
    head = heads(sets)
    x = head.where("outside").select("s", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"),
                                     F.col("at").alias("pa"))
    y = head.select("s", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"),
                    F.col("at").alias("pb"))
    # Shared shingles that similarity asks for, of sets with na and nb; no fewer may be left from the shared one on.
    need = F.ceil((F.col("na") + F.col("nb")) * SIMILAR / (100.0 + SIMILAR) - 1e-9)
    fits = (F.col("na") - F.col("pa") >= need) & (F.col("nb") - F.col("pb") >= need) & (F.col("ra") != F.col("rb"))
    in_large = x.join(y, "s").where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stage(in_small.union(in_large).distinct(), "pairs")
    drop(m, sets, head)
    return pairs


def grouped(df: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Written tables: every row of ``df`` as ``doc_id, h, n_shingles, node``, and its nodes' components.

    ``h`` is the text's hash; nodes (texts with words) have ``node, root, component`` and the doc_id ``first`` and hash of
    the row that stands for the component.
    """
    arrow_ready(df.sparkSession)
    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = stage(docs.withColumn("h", F.xxhash64("text")).mapInArrow(
        _sign(shingle), f"doc_id {kind}, h bigint, n_shingles bigint, node binary, bands array<bigint>"), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = signed.where("n_shingles > 0").groupBy("node").agg(F.min(F.struct(order.alias("o"), "n_shingles", "bands")).alias("f"))
    nodes = stage(first.select("node", F.col("f.o.doc_id").alias("first_doc"), F.col("f.o.h").alias("h"),
                               F.col("f.n_shingles").alias("n"), F.col("f.bands").alias("bands")), "nodes")

    bands = nodes.select("node", "n", F.posexplode("bands").alias("band", "key")).where("key <> -1")
    order = F.xxhash64("node", "band")
    # Numbers alone are aggregated by hashing; the hub's name is looked up in the buckets that are left.
    buckets = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("lead")).where("size > 1")
    hub = F.min(F.when(order == F.col("lead"), F.col("node"))).over(Window.partitionBy("band", "key"))
    members = stage(bands.join(buckets, ["band", "key"]).withColumn("hub", hub).drop("lead"), "members")
    chosen = stage(nodes.join(members.select("node").distinct(), "node"), "chosen")
    keys = stage(chosen.select(F.col("node").alias("id"), F.col("first_doc").alias("doc"), F.col("h").alias("hash")), "keys")
    texts = texts_of(docs, keys, has_repeats(signed))
    drop(keys)

    stars = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    best = likely(stars, chosen).groupBy("a").agg(F.max(F.struct("est", "b")).alias("best")).select(
        "a", F.col("best.b").alias("b"))
    links = linked(best, texts, shingle)
    roots = components(links)
    label = stage(with_root(chosen.select("node"), roots, "node", "root").select("node", "root"), "labels")
    drop(links, roots)
    label = further_hubs(members, label, chosen, texts, shingle)
    pairs = rest_pairs(members, label, texts, shingle)
    more = linked(likely(pairs, chosen), texts, shingle)
    label = joined(label, more)
    drop(pairs, more, members, chosen, texts)
    rooted = with_root(nodes.select("node", "first_doc", "h"), label, "node", "root")
    named = rooted.groupBy("root").agg(F.min(F.struct(
        F.col("first_doc").isNull().alias("none"), F.col("first_doc").alias("doc_id"), "h")).alias("f"))
    names = stage(rooted.join(named, "root").select(
        "node", "root", F.col("f.doc_id").alias("component"), F.col("f.doc_id").alias("first"), F.col("f.h").alias("first_h")),
        "names")
    drop(label, nodes)
    return signed, names


def near_duplicates(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``df`` (columns doc_id, text).

    Null, empty and wordless texts have no shingles and stay alone.  Rows with equal sets are linked, repeated rows too;
    ``component_id`` is the least non-null doc_id of the component, ``kept`` whether it is the row's own.  Rows with a
    null doc_id take part; alone, they have a null ``component_id`` and are kept.  Rows without words are their own
    component by doc_id.  An empty table gives no rows.
    """
    signed, names = grouped(df, shingle)
    d = signed.select("doc_id", "n_shingles", "node").join(names.select("node", "component"), "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return d.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def one_of_each(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``df``, one of each component of near duplicates, with their columns as they are.

    The row that stays has the least doc_id of the component (null last), then the least text hash; of repeated rows with
    both equal, one.  Rows without words stay, each.  Rows go by (doc_id, text hash), so a doc_id with several texts
    loses none that stands for a component of its own.  Texts move only where the lists of rows to drop are too large to be broadcast
    by Spark's own size check.  An empty table gives no rows.
    """
    signed, names = grouped(df, shingle)
    keys = signed.where("n_shingles > 0").groupBy("doc_id", "h", "node").agg(F.count(F.lit(1)).alias("_rows"))
    keys = keys.join(names, "node").select(
        F.col("doc_id").alias("_doc"), F.col("h").alias("_hash"), "_rows",
        (F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("h") == F.col("first_h"))).alias("_stays"))
    lists = stage(keys.where(~F.col("_stays") | (F.col("_rows") > 1)), "dropped")
    d = df.select(*numbered(df), df["doc_id"].alias("_id"), F.xxhash64(df["text"]).alias("_h"))
    same = d["_id"].eqNullSafe(lists["_doc"]) & (d["_h"] == lists["_hash"])
    single = d.join(lists, same, "left_anti")
    several = d.join(lists.where("_stays"), same, "left_semi")
    one = several.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_h").orderBy("_h"))).where("_n = 1")
    return single.unionByName(one.drop("_n")).select(*renamed(df.columns))


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"))
