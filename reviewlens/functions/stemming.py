"""Porter suffix stripping (M. F. Porter, 1980) as native expressions.

Each step reads the word and its *shape*, a string of ``c`` (consonant) and ``v`` (vowel) as long as the word, and is one
projection: a condition on a stem is a regular expression on the first letters of the shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The algorithm's suffix tables, in the published order.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"),
         ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
         ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
         "iti", "ous", "ive", "ize"]

#: Measures of a stem (its number of vowel-consonant sequences) as patterns on its shape.
SOME, ONE, MANY = "^c*v+c", "^c*v+c+v*$", "^c*v+c+v+c"


def shape(word: Column) -> Column:
    """``c`` or ``v`` for every letter; a ``y`` is a vowel behind a consonant only."""
    def step(done, letter):
        y = F.when(done.endswith("c"), "v").otherwise("c")
        return F.concat(done, F.when(letter.isin(*"aeiou"), "v").when(letter == "y", y).otherwise("c"))

    return F.aggregate(F.split(word, ""), F.lit(""), step)


def _cut(text: Column, n: int) -> Column:
    """``text`` without its last ``n`` letters."""
    return F.substring(text, F.lit(1), F.greatest(F.length(text) - n, F.lit(0)))


class _Step:
    """One step's view of the columns ``w`` and ``s`` (word and shape)."""

    def __init__(self):
        self.w, self.s = F.col("_w"), F.col("_s")

    def stem(self, suffix: str) -> Column:
        return _cut(self.w, len(suffix))

    def holds(self, suffix: str, pattern: str) -> Column:
        """Whether the shape of what is before the suffix has the pattern."""
        return _cut(self.s, len(suffix)).rlike(pattern)

    def closed(self, suffix: str = "") -> Column:
        """Consonant, vowel, consonant at the end, the last not w, x or y."""
        return self.holds(suffix, "cvc$") & ~F.substring(self.stem(suffix), -1, 1).isin("w", "x", "y")

    def doubled(self) -> Column:
        return self.w.rlike(r"(.)\1$") & self.s.endswith("c")


def _plural(x: _Step) -> Column:
    return (F.when(x.w.endswith("sses") | x.w.endswith("ies"), _cut(x.w, 2))
            .when(x.w.endswith("s") & ~x.w.endswith("ss"), _cut(x.w, 1)).otherwise(x.w))


def _past(x: _Step) -> Column:
    """The word without -ed or -ing, with a mark behind it where the next step has to mend its end."""
    return (F.when(x.w.endswith("eed"), F.when(x.holds("eed", SOME), _cut(x.w, 1)).otherwise(x.w))
            .when(x.w.endswith("ed") & x.holds("ed", "v"), F.concat(x.stem("ed"), F.lit("\u0000")))
            .when(x.w.endswith("ing") & x.holds("ing", "v"), F.concat(x.stem("ing"), F.lit("\u0000"))).otherwise(x.w))


def _mended(x: _Step) -> Column:
    long = x.w.endswith("at") | x.w.endswith("bl") | x.w.endswith("iz")
    return (F.when(long, F.concat(x.w, F.lit("e")))
            .when(x.doubled() & ~F.substring(x.w, -1, 1).isin("l", "s", "z"), _cut(x.w, 1))
            .when(x.s.rlike(ONE) & x.closed(), F.concat(x.w, F.lit("e"))).otherwise(x.w))


def _y(x: _Step) -> Column:
    return F.when(x.w.endswith("y") & x.holds("y", "v"), F.concat(x.stem("y"), F.lit("i"))).otherwise(x.w)


def _first(x: _Step, rules, pattern: str, more=lambda suffix: F.lit(True)) -> Column:
    """The first rule whose suffix the word has decides, whether its condition holds or not."""
    out = None
    for suffix, new in rules:
        made = F.when(x.holds(suffix, pattern) & more(suffix), F.concat(x.stem(suffix), F.lit(new))).otherwise(x.w)
        out = F.when(x.w.endswith(suffix), made) if out is None else out.when(x.w.endswith(suffix), made)
    return out.otherwise(x.w)


def _last_e(x: _Step) -> Column:
    drop = x.holds("e", MANY) | (x.holds("e", ONE) & ~x.closed("e"))
    return F.when(x.w.endswith("e") & drop, x.stem("e")).otherwise(x.w)


def _last_l(x: _Step) -> Column:
    return F.when(x.w.endswith("l") & x.s.rlike(MANY) & x.doubled(), _cut(x.w, 1)).otherwise(x.w)


def stemmed(df: DataFrame, term: str, out: str) -> DataFrame:
    """``df`` with the stem of the lower-case words in ``term``; words of one or two letters stay, null stays null.

    One projection a step: a word is read several times in a step, so each step's word is a column of its own.
    """
    x = _Step()

    def step(d: DataFrame, word: Column) -> DataFrame:
        return d.withColumn("_w", word).withColumn("_s", shape(x.w))

    d = step(df.withColumn("_w", F.col(term)), x.w)
    d = step(d, _plural(x))
    d = d.withColumn("_w", _past(x)).withColumn("_again", x.w.endswith("\u0000"))
    d = step(d, F.rtrim(x.w, F.lit("\u0000")))
    d = step(d, F.when(F.col("_again"), _mended(x)).otherwise(x.w))
    d = step(d, _y(x))
    d = step(d, _first(x, STEP2, SOME))
    d = step(d, _first(x, STEP3, SOME))
    # -ion goes behind s or t alone.
    ion = lambda suffix: x.stem("ion").rlike("[st]$") if suffix == "ion" else F.lit(True)
    d = step(d, _first(x, [(suffix, "") for suffix in STEP4], MANY, ion))
    d = step(d, _last_e(x))
    d = d.withColumn("_w", _last_l(x))
    return d.withColumn(out, F.when(F.length(term) <= 2, F.col(term)).otherwise(x.w)).drop("_w", "_s", "_again")
