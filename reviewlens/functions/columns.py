"""Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add expensive columns that are evaluated exactly once per row.

    Catalyst inlines a projected expression into every later reference and
    pushes filters below it, so a regex chain used by a filter and two
    derived columns would run three times.  Emitting the columns through a
    one-element ``inline`` (a Generate) fixes the evaluation point: later
    filters and projections read the generated columns.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))


def rounded(c: Column, digits: int = 6) -> Column:
    """``F.round`` of a double, by arithmetic where the value is no near tie: ``F.round`` goes through decimal text for every value."""
    x = c * F.lit(10.0 ** digits)
    clear = (F.abs(x) < 1e12) & (F.abs(x - F.floor(x) - 0.5) > 1e-3)
    return F.when(clear, F.floor(x + 0.5) / F.lit(10.0 ** digits)).otherwise(F.round(c, digits))
