"""A keyed permutation of 0..n-1 as Spark columns: alternating Feistel rounds with cycle walking.

The domain is a x b with a = ceil(sqrt(n)) and b = ceil(n / a), so it holds fewer than
a points beyond n and a walk leaves the range with a chance below 1 / sqrt(n).  Rounds add a keyed hash of one
half to the other, modulo that half's size: each round can be undone, so the whole is a permutation of the domain,
and walking until the value is below n makes it one of 0..n-1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
#: Steps a walk may take.  A walk can only visit the fewer than sqrt(n) + 1 points outside the range, and needs more
#: than this many with a chance below n ** -(WALK / 2); if one ever did, the query raises rather than give a wrong slot.
WALK = 48


def halves(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("bigint")
    return a, F.greatest(F.ceil(n.cast("double") / a), F.lit(1)).cast("bigint")


def rounds(x: Column, a: Column, b: Column, key: Column) -> Column:
    """One pass through the Feistel network over [0, a * b)."""
    def step(s, i):
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, key), a), a)
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], i, key), b), b)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r")))

    start = F.struct((x - F.pmod(x, b)).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))
    start = F.struct(((start["l"] / b).cast("bigint")).alias("l"), start["r"].alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"])


def permuted(x: Column, n: Column, a: Column, b: Column, key: Column) -> Column:
    """Image of ``x`` (0 <= x < n) under the permutation of 0..n-1 named by ``key`` (a bigint column)."""
    out = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.lit(-1).cast("bigint"),
        lambda y, i: F.when(i == 1, rounds(x, a, b, key)).when(y < n, y).otherwise(rounds(y, a, b, key)))
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("bigint"))
