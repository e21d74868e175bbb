"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

Each paragraph (text between line feeds) is hashed to a wide vector, and a text's fingerprint is the sum of its
paragraphs' vectors, lane by lane, modulo a power of two.  Sums do not depend on the order, and a paragraph is put in
or taken out by adding or subtracting its vector.  A vector has two parts:

* 8 equality lanes of 32 bits: four 64-bit hashes of the paragraph, halved;
* 64 likeness lanes of 30 bits: for each piece of the paragraph (a sentence, or what stands between symbols), the bits
  of a 64-bit hash, one bit a lane.  Two lanes share one 64-bit number, 30 bits and guard bits each, so one masked
  addition adds both modulo 2**30 and never reaches the sign.  A text (below 2**31 bytes) has fewer than 2**30 pieces,
  so a text's own lanes do not wrap.

With n pieces, twice a likeness lane less n is a sum of n random signs; the cosine of two texts' lanes estimates their
shared pieces, |A and B| / sqrt(|A| |B|), with a standard error of about 1/8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.columns import with_computed
from reviewlens.session import stage

#: Between the pieces of a paragraph: sentence ends, and runs of symbols.
PIECE_BREAK = r"[.!?|#%&*$\n]+ *"
_ONE_EACH = 0x0000000100000001
_FIELDS = 0x3FFFFFFF3FFFFFFF
_NUMBERS = 32
_LOW32 = 0xFFFFFFFF
#: Stands for a null doc_id in keys: such rows come last in descending order, as one document.
_NULL_ID = -(2**63)


def paragraph_hashes(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1),
                       lambda p: F.struct(*[F.xxhash64(p, F.lit(i)).alias(f"h{i}") for i in range(4)]))


def piece_hashes(text: Column) -> Column:
    pieces = F.filter(F.split(text, PIECE_BREAK, -1), lambda p: p != "")
    return F.transform(pieces, lambda p: F.xxhash64(p))


def equality_lanes(paragraphs: Column) -> Column:
    """8 sums modulo 2**32."""
    def summed(lane):
        return F.aggregate(paragraphs, F.lit(0).cast("bigint"), lambda s, h: (s + lane(h)).bitwiseAND(F.lit(_LOW32)))

    def halves(name):
        return [summed(lambda h: h[name].bitwiseAND(F.lit(_LOW32))), summed(lambda h: F.shiftrightunsigned(h[name], 32))]

    return F.array(*[lane for i in range(4) for lane in halves(f"h{i}")])


def likeness_lanes(pieces: Column) -> Column:
    """32 numbers of two 30-bit lanes each: the sums of the pieces' hash bits modulo 2**30."""
    def step(s, h):
        return F.struct(*[
            (s[f"s{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONE_EACH))).bitwiseAND(F.lit(_FIELDS)).alias(f"s{k}")
            for k in range(_NUMBERS)])

    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"s{k}") for k in range(_NUMBERS)])
    return F.aggregate(pieces, zero, step, lambda s: F.array(*[s[f"s{k}"] for k in range(_NUMBERS)]))


def signed_lanes(lanes: Column, n: Column) -> Column:
    """64 sums of signs: twice the lane less n, as the residue modulo 2**31 that is nearest to 0."""
    def unpack(x):
        return F.array(*[
            F.pmod(F.shiftrightunsigned(x, 32 * q).bitwiseAND(F.lit((1 << 30) - 1)) * 2 - n + F.lit(1 << 30), F.lit(1 << 31))
            - F.lit(1 << 30) for q in range(2)])

    return F.flatten(F.transform(lanes, unpack))


def likeness(a: Column, na: Column, b: Column, nb: Column, same: Column) -> Column:
    """Estimated share of common pieces, 0 to 1: the cosine of the signed lanes, negative ones as 0.

    1 for equal fingerprints; 0 if one of two different texts has no pieces.
    """
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: (x * y).cast("double")), F.lit(0.0), lambda s, v: s + v)
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + (x * x).cast("double"))
    norm = F.sqrt(square(a) * square(b))
    cos = F.when((na > 0) & (nb > 0) & (norm > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / norm)))
    return F.when(same, F.lit(1.0)).otherwise(F.coalesce(cos, F.lit(0.0)))


def fingerprint_string(eq: Column, n: Column, lanes: Column) -> Column:
    """Equality lanes, piece count and likeness lanes in hexadecimal."""
    return F.concat(F.array_join(F.transform(eq, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), ""), F.lit(":"),
                    n.cast("string"), F.lit(":"),
                    F.array_join(F.transform(lanes, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), ""))


def with_fingerprint(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add ``<prefix>eq``, ``<prefix>n`` and ``<prefix>lanes`` of the non-null text column."""
    d = with_computed(df, **{f"{prefix}_p": paragraph_hashes(F.col(text)), f"{prefix}_c": piece_hashes(F.col(text))})
    d = with_computed(d, **{f"{prefix}eq": equality_lanes(F.col(f"{prefix}_p")),
                            f"{prefix}n": F.size(f"{prefix}_c").cast("bigint"),
                            f"{prefix}lanes": likeness_lanes(F.col(f"{prefix}_c"))})
    return d.drop(f"{prefix}_p", f"{prefix}_c")


def fingerprints(df: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``df`` (columns doc_id, text); null text counts as empty."""
    d = with_fingerprint(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "a_")
    return d.select("doc_id", fingerprint_string(F.col("a_eq"), F.col("a_n"), F.col("a_lanes")).alias("fingerprint"))


def neighbours(ids: DataFrame) -> DataFrame:
    """``k, prev_k, prev_m`` for distinct ids ``k`` with a number ``m``: what stands before k in descending order.

    The greatest id follows the least.  Ids are dealt out by range and their part is written with them, so the order
    needs one narrow shuffle; only each part's least id goes through one task (one row a part).
    """
    parts = ids.repartitionByRange(F.col("k").desc()).withColumn("pid", F.spark_partition_id())
    parts = stage(parts, "ids")
    w = Window.partitionBy("pid").orderBy(F.col("k").desc())
    inside = parts.withColumn("prev_k", F.lag("k").over(w)).withColumn("prev_m", F.lag("m").over(w))
    last = parts.groupBy("pid").agg(F.min_by(F.struct("k", "m"), "k").alias("last"))
    around = Window.orderBy("pid")
    everything = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = last.select("pid", F.coalesce(F.lag("last").over(around), F.last("last").over(everything)).alias("before"))
    d = inside.join(F.broadcast(before), "pid")
    return d.select("k", F.coalesce("prev_k", "before.k").alias("prev_k"), F.coalesce("prev_m", "before.m").alias("prev_m"))


def edited_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    Edited text: the last floor(n_chars / 2) code points give way to the first as many of the next document in
    descending doc_id (after the last: the first).  Null text counts as empty; rows with a null doc_id are one document
    that comes last.  Where a doc_id has several rows, each of them is edited and the next document is the row whose
    text has the least hash.  One document alone is its own next.  An empty table gives no rows.
    """
    docs = df.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID)).alias("k"),
                     F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.groupBy("k").agg(F.max(F.floor(F.length("text") / 2)).cast("bigint").alias("m"))
    pairs = stage(neighbours(ids), "pairs")
    first = Window.partitionBy("k").orderBy(F.xxhash64("text"))
    # The texts are shuffled once, by k; the starts that neighbours need come from the same exchange.
    whole = docs.join(pairs.hint("merge"), "k").withColumn("rn", F.row_number().over(first))
    starts = whole.where("rn = 1").select(F.col("prev_k").alias("k"), F.expr("left(text, int(prev_m))").alias("start"))
    d = docs.join(starts.hint("merge"), "k")
    d = with_computed(d, n_chars=F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2)
    d = with_computed(d, edited=F.concat(F.expr("left(text, int(n_chars - floor(n_chars / 2)))"),
                                         F.left(F.col("start"), half.cast("int"))))
    d = with_fingerprint(with_fingerprint(d, "text", "a_"), "edited", "e_")
    # What is left of a row is narrow: written once, for the comparison with the next row.
    d = stage(d.select("k", "n_chars", F.xxhash64("text").alias("h"), "a_eq", "a_n", "a_lanes", "e_eq", "e_n", "e_lanes",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")), "fingerprints")
    follow = d.groupBy("k").agg(F.min(F.struct("h", "a_eq", "a_n", "a_lanes")).alias("x")).join(pairs, "k").select(
        F.col("prev_k").alias("k"), F.col("x.a_eq").alias("x_eq"), F.col("x.a_n").alias("x_n"),
        F.col("x.a_lanes").alias("x_lanes"))
    d = with_computed(d.join(follow, "k"),
                      **{f"{p}s": signed_lanes(F.col(f"{p}lanes"), F.col(f"{p}n")) for p in ("a_", "e_", "x_")})
    same = lambda p: (F.col("a_eq") == F.col(f"{p}eq")) & (F.col("a_lanes") == F.col(f"{p}lanes"))
    near = lambda p: likeness(F.col("a_s"), F.col("a_n"), F.col(f"{p}s"), F.col(f"{p}n"), same(p))
    text = lambda p: fingerprint_string(F.col(f"{p}eq"), F.col(f"{p}n"), F.col(f"{p}lanes"))
    return d.select(F.when(F.col("k") != _NULL_ID, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256",
                    text("a_").alias("fingerprint"), text("e_").alias("edited_fingerprint"),
                    near("e_").alias("near_edited"), near("x_").alias("near_next"))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return edited_fingerprints(table(spark, sf_dir, "documents"))
