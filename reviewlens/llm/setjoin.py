"""N-gram Jaccard join: all links between shingle sets of a similarity, as components.

Equal sets are one *node*.  Every node has a bitmap signature: bit ``hash mod B`` holds the parity of the shingles that
fall there, with B about the set's size.  The bits in which two signatures differ are no more than the elements in which the
sets differ, so they bound the overlap from above.

1. *Postings.*  Two similar sets share one of their first ``n - ceil(t n) + 1`` shingles in any common order; the order
   puts shingles that are frequent in a sample of texts last (the sample decides no result).  Where at most ``SMALL``
   nodes have a shingle there, their pairs are candidates if sizes and places allow; most pairs share many
   shingles and count once.  Larger groups go on to 2 and 3.
2. *Hubs.*  For ``ROUNDS`` rounds, in each shingle's nodes of one size band, members outside the largest component
   meet one hub of it: at most one confirmation a member and round, never all pairs of a group.  Groups that are
   within one component drop out.
3. *Tiles.*  What is left between components.  A shingle's nodes, in order of size, are cut into tiles of at most
   ``TILE`` by ``TILE``; tiles whose size bands are too far apart are not made.  In a tile, bit counts rule pairs out.
   What passes says only which node must visit which stretch of another component's members, again in order of size.
4. *Visits.*  A stretch's sets (at most ``STRETCH`` shingles, or one set) wait in a task; visitors stream past, are held
   against the bit counts and then against the sorted arrays, exactly.  The first link to a stretch is enough.

Nothing is capped: every pair of nodes that can be similar is either confirmed, ruled out by a bound or already within one
component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.columns import with_computed
from reviewlens.session import drop, stage

from .common import arrow_ready, parts_of
from .links import confirmed, has_repeats, joined, texts_of, with_root
from .shingles import mixed, set_name, shared, shingle_sets

SHINGLE, PERCENT = 5, 80
#: About so many texts are looked at for frequent shingles: those in ``FREQUENT`` of them, at most ``MOST`` shingles.
SAMPLE, FREQUENT, MOST = 4_096, 3, 1 << 17
#: Groups of at most so many nodes with one shingle give their pairs at once.
SMALL = 8
ROUNDS = 4
TILE = 512
STRETCH = 1 << 19
#: Visitors that one task holds against one stretch.
VISITORS = 500


def bit_places(n: int) -> int:
    """Bits of the signature of a set of n: a power of two, n at least and 64."""
    return max(64, 1 << max(n - 1, 1).bit_length())


def signature(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap as 64-bit words."""
    at = (mixed(s) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A signature of fewer words, of the same set."""
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def need(na, nb, percent: int):
    """Common elements that sets of na and nb must have."""
    return -(-(na + nb) * percent // (100 + percent))


def _frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of frequent shingles and their counts in the sample."""
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    share = max(1, int(min(1.0, SAMPLE / total) * 1_000_000))
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share).select("text").distinct()

    def run(batches):
        for batch in batches:
            for part in parts_of(batch):
                sets = shingle_sets(part.column("text"), shingle)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                which, n = np.unique(flat, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(which.view(np.int64)), pa.array(n, pa.int64())], ["t", "n"])

    counts = some.mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).where(
        F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "t").limit(MOST).collect()
    t = np.array([r[0] for r in counts], np.int64).view(np.uint64)
    n = np.array([r[1] for r in counts], np.int64)
    order = np.argsort(t)
    return t[order], n[order]


def _signed(shingle: int, percent: int, hot: np.ndarray, times: np.ndarray):
    def prefix(s: np.ndarray) -> np.ndarray:
        keep = len(s) - -(-len(s) * percent // 100) + 1
        if len(hot):
            at = np.searchsorted(hot, s)
            at[at == len(hot)] = 0
            rank = np.where(hot[at] == s, times[at], 0)
            s = s[np.lexsort((s, rank))]
        return s[:keep]

    def run(batches):
        for batch in batches:
            for part in parts_of(batch, max_bytes=2 << 20):
                sets = shingle_sets(part.column("text"), shingle)
                prefixes = [prefix(s) if len(s) else s for s in sets]
                maps = [signature(s, bit_places(len(s))) for s in sets]

                def lists(arrays):
                    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
                    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_name(s) for s in sets], pa.binary()), lists(prefixes), lists(maps)],
                    ["doc_id", "h", "n", "node", "prefix", "bits"])

    return run


def differing(a: Column, b: Column) -> Column:
    """Bits in which two signatures differ; the longer one is folded onto the shorter."""
    def onto(x, y):
        # Sizes of comparable sets differ by a factor below 2, so one fold is enough.
        return F.aggregate(F.sequence(F.lit(0), F.size(y) - 1), F.lit(0), lambda s, i: s + F.bit_count(
            F.get(x, i).bitwiseXOR(F.get(y, i)).bitwiseXOR(
                F.when(F.size(x) > F.size(y), F.get(x, i + F.size(y))).otherwise(F.lit(0).cast("bigint")))).cast("int"))

    return F.when(F.size(a) >= F.size(b), onto(a, b)).otherwise(onto(b, a))


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) that sizes and signatures do not rule out."""
    one = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    two = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    d = pairs.join(one, "a").join(two, "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    d = with_computed(d, _differ=differing(F.col("ba"), F.col("bb")))
    both = (F.col("na") + F.col("nb") - F.col("_differ")) / 2
    return d.where(both * (100 + percent) >= percent * (F.col("na") + F.col("nb"))).select(*pairs.columns)


def size_band(n: Column, turn: int, percent: int) -> Column:
    """Number of the size band, bands being as wide as comparable sizes; odd turns have bands shifted by a half."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 0.5 * (turn % 2) + 1e-9).cast("int")


def hub_round(m: DataFrame, nodes: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (member, hub): every member outside its groups' main components with its likeliest hub."""
    m = m.withColumn("band", size_band(F.col("n"), turn, percent))
    parts = m.groupBy("t", "band", "root").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id")).alias("hub"))
    main = parts.groupBy("t", "band").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("members", "root", "hub")).alias("main")).where("parts > 1")
    met = m.join(main, ["t", "band"]).where(F.col("root") != F.col("main.root"))
    pairs = met.groupBy(F.col("id").alias("a"), F.col("main.hub.id").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    best = possible(pairs, nodes, percent).groupBy("a").agg(F.max(F.struct("times", "b")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"))


def mixed_groups(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Written rows of the groups that hold several components, with their ``root``."""
    m = with_root(rows.drop("root"), label, "id", "root")
    group = Window.partitionBy("t")
    m = m.withColumns({"_lo": F.min("root").over(group), "_hi": F.max("root").over(group)})
    return stage(m.where("_lo <> _hi").drop("_lo", "_hi"), "mixed")


def _tiles(percent: int):
    """Visits (x, root, stretch) that a tile's bit counts do not rule out."""
    def run(batches):
        held, key = [], None

        def flush():
            rows = held
            if len(rows) < 2:
                return []
            ids, n, at = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2))
            roots, weight = (np.array([r[i] for r in rows], np.int64) for i in (3, 4))
            stretch, side = (np.array([r[i] for r in rows], np.int64) for i in (5, 6))
            maps = [r[7] for r in rows]
            out = set()
            for i in range(len(rows)):
                # Either both are of one cut (each pair once), or one of each.
                j = np.flatnonzero((side != side[i]) | (np.arange(len(rows)) > i) & (side == 2)) if side[i] == 2 else (
                    np.flatnonzero(side == 1) if side[i] == 0 else np.zeros(0, np.int64))
                j = j[(roots[j] != roots[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
                least = need(n[j], n[i], percent)
                j = j[np.minimum(n[j] - at[j], n[i] - at[i]) >= least]
                for o in j.tolist():
                    size = min(len(maps[i]), len(maps[o]))
                    differ = int(np.bitwise_count(folded(maps[i], size) ^ folded(maps[o], size)).sum())
                    if n[i] + n[o] - differ >= 2 * need(int(n[i]), int(n[o]), percent):
                        # The node of the lighter component visits the heavier one.
                        x, y = (i, o) if (weight[i], roots[i]) < (weight[o], roots[o]) else (o, i)
                        out.add((int(ids[x]), int(roots[y]), int(stretch[y])))
            return out

        for batch in batches:
            found = []
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("t", "c", "d")]))
            values = list(zip(*[batch.column(c).to_pylist() for c in ("id", "n", "i", "root", "weight", "stretch", "side")]))
            bits = batch.column("bits")
            ends, flat = bits.offsets.to_numpy(), bits.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for r, (k, v) in enumerate(zip(keys, values)):
                if k != key:
                    found += flush()
                    held, key = [], k
                held.append((*v, flat[ends[r]:ends[r + 1]].copy()))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                                             ["id", "root", "stretch"])
        found = list(flush())
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                                         ["id", "root", "stretch"])

    return run


def _visits(shingle: int, percent: int):
    def run(batches):
        names, sets, sizes, maps, bits, key = [], [], None, None, 64, None
        for batch in batches:
            for part in parts_of(batch):
                found = []
                columns = [part.column(c).to_pylist() for c in ("root", "stretch", "part", "turn", "id")]
                for (*k, turn, name), s in zip(zip(*columns), shingle_sets(part.column("text"), shingle)):
                    if k != key:
                        names, sets, maps, key = [], [], None, k
                    if turn == 0:
                        names.append(name)
                        sets.append(s)
                        continue
                    if maps is None:
                        sizes = np.array([len(x) for x in sets], np.int64)
                        bits = bit_places(int(sizes.max())) if len(sizes) else 64
                        maps = np.array([signature(x, bits) for x in sets], np.uint64).reshape(len(sets), -1)
                    n = len(s)
                    differ = np.bitwise_count(maps ^ signature(s, bits)[None, :]).sum(axis=1, dtype=np.int64)
                    least = need(sizes, n, percent)
                    near = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)) & (sizes + n - differ >= 2 * least)
                    for o in np.flatnonzero(near)[np.argsort(differ[near])].tolist():
                        if shared(s, sets[o]) >= least[o]:
                            found.append((name, names[o]))
                            break
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def rest(m: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between components, from all pairs that share a posting and that no bound rules out."""
    # Members of a component in order of size, cut into stretches of bounded shingles.
    by_size = Window.partitionBy("root").orderBy("n", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = m.select("id", "n", "root").distinct()
    weights = members.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    members = stage(members.withColumn("stretch", F.floor((F.sum("n").over(by_size) - F.col("n")) / STRETCH)).join(
        weights, "root"), "members")
    # Tiles: a shingle's nodes in order of size, cut by rank; pairs of cuts whose sizes are comparable.
    ranked = m.withColumn("c", F.floor((F.row_number().over(Window.partitionBy("t").orderBy("n", "id")) - 1) / TILE))
    ranked = stage(ranked, "ranked")
    cuts = ranked.groupBy("t", "c").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    other = cuts.select("t", F.col("c").alias("d"), F.col("lo").alias("lo_d"))
    tiles = cuts.join(other, "t").where((F.col("c") <= F.col("d")) & (100 * F.col("hi") >= percent * F.col("lo_d"))).select(
        "t", "c", "d")
    first = tiles.select("t", "c", "d", F.col("c").alias("own"), F.when(F.col("c") == F.col("d"), 2).otherwise(0).alias("side"))
    second = tiles.where("c <> d").select("t", "c", "d", F.col("d").alias("own"), F.lit(1).alias("side"))
    placed = first.unionByName(second).join(ranked.withColumnRenamed("c", "own"), ["t", "own"])
    placed = placed.join(members.select("id", "weight", "stretch"), "id").join(nodes.select("id", "bits"), "id")
    placed = placed.repartition("t", "c", "d").sortWithinPartitions("t", "c", "d")
    visits = stage(placed.mapInArrow(_tiles(percent), "id bigint, root bigint, stretch bigint").distinct(), "visits")

    dealt = visits.groupBy("root", "stretch").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("parts"))
    waiting = dealt.join(members, ["root", "stretch"]).select(
        "root", "stretch", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("turn"), "id")
    coming = visits.join(dealt, ["root", "stretch"]).select(
        "root", "stretch", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("turn"), "id")
    meeting = stage(waiting.unionByName(coming), "meeting")
    met = meeting.join(texts, "id").repartition("root", "stretch", "part").sortWithinPartitions(
        "root", "stretch", "part", "turn", "id")
    links = stage(met.mapInArrow(_visits(shingle, percent), "a bigint, b bigint"), "links")
    drop(members, ranked, visits, meeting)
    return links


def linked(df: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``df`` (columns doc_id, text).

    A text's set is its distinct shingles of ``shingle`` words, A-Z in lower case; with fewer words the whole sequence.
    Null, empty and wordless texts have no set and stay alone under their own doc_id.  Rows with equal sets are linked, repeated
    rows too.  ``component_id`` is the least non-null doc_id of the component; null if it has none.  An empty
    table gives no rows.
    """
    spark = df.sparkSession
    arrow_ready(spark)
    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hot, times = _frequent(docs, shingle)
    wide = docs.withColumn("h", F.xxhash64("text")).mapInArrow(
        _signed(shingle, percent, hot, times),
        f"doc_id {kind}, h bigint, n bigint, node binary, prefix array<bigint>, bits array<bigint>")
    # Prefixes are most of this table and are read once.
    wide = stage(wide.withColumn("id", F.monotonically_increasing_id()), "wide")
    signed = stage(wide.drop("prefix"), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "id")).alias("f")
    names = stage(signed.where("n > 0").groupBy("node").agg(least).select(
        "node", F.col("f.id").alias("id"), F.col("f.doc_id").alias("first_doc"), F.col("f.h").alias("h")), "names")
    copies = signed.where("n > 0").select("node", "id").join(
        names.select("node", F.col("id").alias("first_id")), "node").where("id <> first_id")
    copies = stage(copies.select("id"), "copies")
    nodes = wide.where("n > 0").select("id", "n", "prefix").join(copies, "id", "left_anti")

    # In one exchange by shingle: how many have it, and those just before a node in order of size.
    group, in_size = Window.partitionBy("t"), Window.partitionBy("t").orderBy("n", "id")
    postings = nodes.select("id", "n", F.posexplode("prefix").alias("i", "t")).withColumns({
        "_r": F.lead("id").over(in_size), "_at": F.row_number().over(in_size)}).where("_at > 1 or _r is not null")
    postings = postings.withColumn("_of", F.count(F.lit(1)).over(group)).withColumn("_earlier", F.when(
        F.col("_of") <= SMALL, F.collect_list(F.struct("id", "n", "i")).over(in_size.rowsBetween(1 - SMALL, -1))))
    postings = stage(postings.select("t", "id", "n", "i", F.when(F.col("_of") <= SMALL, F.col("_earlier")).alias("e")), "postings")
    drop(wide)
    met = postings.where("e is not null").select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"),
                                                 F.explode("e").alias("x"))
    least = F.ceil((F.col("x.n") + F.col("nb")) * percent / (100.0 + percent) - 1e-9)
    fits = (F.col("x.n") - F.col("x.i") >= least) & (F.col("nb") - F.col("ib") >= least) & (
        100 * F.col("x.n") >= percent * F.col("nb"))
    pairs = stage(met.where(fits).select(F.col("x.id").alias("a"), "b").distinct(), "pairs")
    rows = stage(postings.where("e is null").select("t", "id", "n", "i"), "rows")
    drop(postings)
    involved = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(rows.select("id")).distinct(),
                     "involved")
    signs = stage(signed.select("id", "n", "bits").join(involved, "id", "left_semi"), "signs")
    close = stage(possible(pairs, signs, percent), "pairs")
    drop(pairs)
    wanted = stage(close.select(F.col("a").alias("id")).union(close.select("b")).union(rows.select("id")).distinct(), "wanted")
    keys = wanted.join(names, "id").select("id", F.col("first_doc").alias("doc"), F.col("h").alias("hash"))
    keys = stage(keys, "keys")
    texts = texts_of(docs, keys, has_repeats(signed))
    drop(keys)

    label = stage(wanted.select(F.col("id").alias("node"), F.col("id").alias("root")), "labels")
    links = confirmed(close, texts, shingle, percent)
    label = joined(label, links)
    drop(links, close, wanted, involved)
    m = mixed_groups(rows, label)
    drop(rows)
    for turn in range(ROUNDS):
        if m.isEmpty():
            break
        links = confirmed(hub_round(m, signs, turn, percent), texts, shingle, percent)
        none = links.isEmpty()
        if not none:
            label = joined(label, links)
            before, m = m, mixed_groups(m, label)
            drop(before)
        drop(links)
        if none and turn % 2:
            break
    if not m.isEmpty():
        links = rest(m, signs, texts, shingle, percent)
        label = joined(label, links)
        drop(links)
    drop(m, texts, signs, copies)

    rooted = with_root(names.select("node", "id", "first_doc"), label, "id", "root")
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("component"))
    found = rooted.join(named, "root").select("node", "component")
    d = signed.select("doc_id", "n", "node").join(found, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return d.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op12_set_join(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return linked(table(spark, sf_dir, "documents"))
