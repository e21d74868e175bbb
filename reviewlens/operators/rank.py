"""Exact, seeded, repartition-proof global order without a one-task sort (§7.2).

Every consumer (exact sample, split, folds, vocabulary ids, cumulative ROC
counts) needs a running count or running sum in a global order.  A plain
``Window.orderBy`` puts all rows in one task.  Instead:

1. tag each row with a *bucket* that coarsens the order (rows in a lower
   bucket come first): an md5 prefix, a score bin, a (-freq, term prefix);
2. total each measure per bucket (partial aggregation, small result);
3. running offsets over the bucket totals (bucket count is small);
4. running sum within (group, bucket) plus the bucket's offset.

Only step 4 moves the rows, hash-partitioned on the bucket, so a hot group is
spread over all its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 42
MD5_BUCKET_HEX = 3  # 4,096 buckets: offsets table has at most 4,096 rows per group


def seeded_hash(key, seed: int = DEFAULT_SEED) -> Column:
    """md5(seed || ':' || key), the shared seeded order (DuckDB: md5('42:'||key))."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def prefix_sums(df: DataFrame, bucket: Column, order: list[Column], measures: dict[str, Column],
                partition_by: list[str] | None = None, bucket_desc: bool = False,
                bounded_buckets: bool = False, coarse=None, _level: int = 0) -> DataFrame:
    """Add ``<name>`` = running sum of each measure over ``order`` within ``partition_by``.

    ``bucket`` must be monotone in ``order`` (ascending, or descending when
    ``bucket_desc``).  ``bounded_buckets`` declares that the bucket count is a
    small constant, which allows an explicit broadcast of the offsets.
    ``coarse`` (a function of the bucket column, monotone in it) makes the
    bucket offsets themselves a prefix sum over coarser buckets, so a large
    bucket count never goes through one ordered window.
    """
    parts = list(partition_by or [])
    bk, t, o, m = f"_bk{_level}", f"_t{_level}_", f"_o{_level}_", f"_m{_level}_"
    d = df.withColumn(bk, bucket)
    for name, meas in measures.items():
        d = d.withColumn(f"{m}{name}", meas)
    tot = d.groupBy(*parts, bk).agg(*[F.sum(f"{m}{n}").alias(f"{t}{n}") for n in measures])
    bk_order = F.col(bk).desc() if bucket_desc else F.col(bk).asc()
    if coarse is None:
        w_off = Window.partitionBy(*parts).orderBy(bk_order).rowsBetween(Window.unboundedPreceding, -1)
        offs = tot.select(*parts, bk,
                          *[F.coalesce(F.sum(f"{t}{n}").over(w_off), F.lit(0)).alias(f"{o}{n}") for n in measures])
    else:
        cum = prefix_sums(tot, coarse(F.col(bk)), [bk_order], {f"{o}{n}": F.col(f"{t}{n}") for n in measures},
                          partition_by=parts, bucket_desc=bucket_desc, _level=_level + 1)
        offs = cum.select(*parts, bk, *[(F.col(f"{o}{n}") - F.col(f"{t}{n}")).alias(f"{o}{n}") for n in measures])
    if bounded_buckets:
        offs = F.broadcast(offs)
    d = d.join(offs, [*parts, bk])
    w_in = Window.partitionBy(*parts, bk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for n in measures:
        d = d.withColumn(n, F.col(f"{o}{n}") + F.sum(f"{m}{n}").over(w_in))
    return d.drop(bk, *[f"{m}{n}" for n in measures], *[f"{o}{n}" for n in measures])


def exact_rank(df: DataFrame, key: str, seed: int = DEFAULT_SEED, partition_by: list[str] | None = None,
               rank_col: str = "rank", hex_digits: int = MD5_BUCKET_HEX) -> DataFrame:
    """1-based rank by (md5(seed:key), key), globally or within ``partition_by``.

    Equals ``row_number() over ([partition by ..] order by md5('seed:'||key), key)``.
    ``key`` must be unique (within the partition).
    """
    h = seeded_hash(key, seed)
    d = df.withColumn("_h", h)
    out = prefix_sums(d, F.substring(F.col("_h"), 1, hex_digits), [F.col("_h"), F.col(key)],
                      {rank_col: F.lit(1).cast("bigint")}, partition_by=partition_by,
                      bounded_buckets=not partition_by)
    return out.drop("_h")


def sorted_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add ``out``: each row's 0-based place in ascending order of ``col`` (unique), by range parts.

    One exchange: rows are dealt out by range, sorted within their part and written with a number that tells part and place;
    the parts' sizes (a row a part) give the offsets.
    """
    from reviewlens.session import stage
    d = df.repartitionByRange(F.col(col)).sortWithinPartitions(col).withColumn("_at", F.monotonically_increasing_id())
    d = stage(d, "sorted")
    part = F.shiftright("_at", 33)
    sizes = d.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    place = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)
    return d.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(out, place).drop("_part", "_at", "_before")


#: Hash digits that one counting pass looks at, and the rows of a bucket that the last pass may sort.
CUT_DIGITS = 3
CUT_ROWS = 4_096
_AFTER = "~"  # sorts after every hexadecimal digit


def cut_points(df: DataFrame, key: str, ranks: dict, seed: int = DEFAULT_SEED, by: str | None = None) -> dict:
    """Values at given ranks of the seeded order, found by counting: nothing is sorted or moved but keys.

    ``ranks`` maps each group of ``by`` (``None`` alone without ``by``) to the ranks wanted.  A pass counts the rows by
    ``CUT_DIGITS`` further digits of the hash within the buckets that hold a wanted rank (4,096 counts a rank reach
    the driver); a bucket of at most ``CUT_ROWS`` rows is read and its value taken.  Gives {(group, rank): (hash, key)}:
    exactly ``rank`` rows of the group are at or before it.  Ranks beyond a group's size give the end, those below 1 None.
    ``key`` is unique; a null key comes first.
    """
    group = F.col(by) if by else F.lit(None).cast("string")
    keys = df.select(group.alias("_g"), F.col(key).alias("_k"), F.coalesce(seeded_hash(key, seed), F.lit("")).alias("_h"))
    out = {(g, r): None for g, rs in ranks.items() for r in rs if r <= 0}
    open_ = {(g, r): ("", 0) for g, rs in ranks.items() for r in rs if r > 0}  # bucket prefix, rows before it
    digits = 0
    while open_:
        digits += CUT_DIGITS
        inside = F.lit(False)
        for g, p in {(g, p) for (g, _), (p, _) in open_.items()}:
            inside = inside | (F.col("_g").eqNullSafe(F.lit(g)) & F.col("_h").startswith(p))
        rows = keys if digits == CUT_DIGITS else keys.where(inside)
        counts: dict = {}
        for r in rows.groupBy("_g", F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["_g"], []).append((r["_p"], r["n"]))
        small: dict = {}
        for (g, rank), (prefix, done) in list(open_.items()):
            for p, n in sorted(c for c in counts.get(g, []) if c[0].startswith(prefix)):
                if done + n >= rank:
                    break
                done += n
            else:
                out[g, rank] = (_AFTER, None)
                del open_[g, rank]
                continue
            open_[g, rank] = (p, done)
            if done + n == rank:
                out[g, rank] = (p + _AFTER if p else "", None)
                del open_[g, rank]
            elif n <= CUT_ROWS or digits >= 32:
                small.setdefault((g, p), []).append((rank, rank - done))
                del open_[g, rank]
        if small:
            wanted = F.lit(False)
            for g, p in small:
                wanted = wanted | (F.col("_g").eqNullSafe(F.lit(g)) & F.col("_h").startswith(p))
            found: dict = {}
            for r in keys.where(wanted).collect():
                found.setdefault((r["_g"], r["_h"][:digits]), []).append((r["_h"], r["_k"]))
            for at, places in small.items():
                held = sorted(found[at], key=lambda x: (x[0], x[1] is not None, x[1]))
                for rank, place in places:
                    out[at[0], rank] = held[place - 1]
    return out


def at_or_before(key: str, cut: tuple | None, seed: int = DEFAULT_SEED) -> Column:
    """Whether a row is at or before a cut point; for None no row is."""
    if cut is None:
        return F.lit(False)
    h, k = F.coalesce(seeded_hash(key, seed), F.lit("")), F.col(key)
    if cut[1] is None:  # the end of a bucket, or the null key alone
        return h <= F.lit(cut[0])
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & F.coalesce(k <= F.lit(cut[1]), F.lit(True)))


def sample_exact(df: DataFrame, n: int, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """T-01 / T-02: exactly min(n, count) rows, seeded, no replacement; a filter by the value at rank ``n``."""
    return df.where(at_or_before(key, cut_points(df, key, {None: [n]}, seed)[None, n], seed))


def split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int, int]:
    """X-13: rows of (train, val, test); shares are rounded half to even (fixed rule), train takes what is left."""
    shares = {"val": val_size, "test": test_size}
    wrong = {name: share for name, share in shares.items() if share < 0}
    if wrong or sum(shares.values()) >= 1:
        raise ValueError(f"shares must be at least 0 and leave something to train on: {shares}")
    rows = {name: round(share * n) for name, share in shares.items()}
    return n - sum(rows.values()), rows["val"], rows["test"]


def split_exact(df: DataFrame, key: str, seed: int = DEFAULT_SEED, test_size: float = 0.2,
                val_size: float = 0.1) -> DataFrame:
    """X-13: add ``split`` in {train, val, test} with exact sizes; rows are compared with two values and stay in place."""
    train, val, _ = split_sizes(df.count(), test_size, val_size)
    cuts = cut_points(df, key, {None: [train, train + val]}, seed)
    tag = F.when(at_or_before(key, cuts[None, train], seed), "train").when(
        at_or_before(key, cuts[None, train + val], seed), "val").otherwise("test")
    return df.withColumn("split", tag)


def split_holdout(df: DataFrame, key: str, seed: int = DEFAULT_SEED, holdout: float = 0.1) -> DataFrame:
    """X-15: unstratified two-way split; ``split`` in {train, holdout}."""
    t = split_exact(df, key, seed, test_size=0.0, val_size=holdout)
    return t.withColumn("split", F.when(F.col("split") == "train", "train").otherwise("holdout"))


def split_stratified(df: DataFrame, key: str, label: str, seed: int = DEFAULT_SEED,
                     holdout: float = 0.1) -> DataFrame:
    """X-14: per label (a class; one value a label reaches the driver), the first round(holdout * n_label) rows are held out."""
    sizes = {r[0]: round(r[1] * holdout) for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}
    cuts = cut_points(df, key, {g: [n] for g, n in sizes.items()}, seed, by=label)
    out = F.lit(False)
    for g, n in sizes.items():
        out = out | (F.col(label).eqNullSafe(F.lit(g)) & at_or_before(key, cuts[g, n], seed))
    return df.withColumn("split", F.when(out, "holdout").otherwise("train"))


def kfold(df: DataFrame, key: str, label: str | None = None, k: int = 5, seed: int = DEFAULT_SEED) -> DataFrame:
    """M-18: ``fold`` = (seeded rank within label - 1) mod k; stratified when ``label`` is given."""
    parts = [label] if label else None
    r = exact_rank(df, key, seed, partition_by=parts, rank_col="_r")
    return r.withColumn("fold", ((F.col("_r") - 1) % k).cast("int")).drop("_r")
