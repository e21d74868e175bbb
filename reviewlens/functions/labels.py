"""Rating -> sentiment -> code expressions (P-06..P-09, F-12, F-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label maps.
SENTIMENTS = ["negative", "neutral", "positive"]
SENTIMENT_CODE = {"negative": 0, "neutral": 1, "positive": 2}
RATING_TO_SENTIMENT = {1: "negative", 2: "negative", 3: "neutral", 4: "positive", 5: "positive"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rating_int(c) -> Column:
    """F-12: truncate toward zero; NULL for null, NaN, inf, junk and '4.0'-style strings.

    ``try_cast`` (never a bare cast: ANSI mode raises) gives exactly Python's
    ``int(x)`` acceptance for numbers and integer strings.
    """
    return _c(c).try_cast("int")


def sentiment(c) -> Column:
    """P-07: rating -> 'negative' | 'neutral' | 'positive'; anything unmapped is neutral."""
    r = rating_int(c)
    expr = F.when(r.isin(1, 2), F.lit("negative")).when(r == 3, F.lit("neutral")).when(r.isin(4, 5), F.lit("positive"))
    return expr.otherwise(F.lit("neutral"))


def sentiment_code(c, default: int | None = 1) -> Column:
    """P-08 (default 1) / P-09 (default None): sentiment name -> 0/1/2."""
    s = _c(c)
    out = F.when(s == "negative", F.lit(0)).when(s == "neutral", F.lit(1)).when(s == "positive", F.lit(2))
    if default is not None:
        out = out.otherwise(F.lit(default))
    return out.cast("int")


def class_name(code) -> Column:
    """J-07: code -> class name (CASE, no join needed for 3 classes)."""
    c = _c(code)
    return (F.when(c == 0, F.lit("negative")).when(c == 1, F.lit("neutral"))
            .when(c == 2, F.lit("positive")))
