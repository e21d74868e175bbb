"""Stemming and lemmatisation as Spark jobs (F-15..F-19).

Every *distinct* token is mapped once, to its stem by native expressions or to its lemma by a dictionary table
``(form, lemma)``; the map is a written vocabulary with frequencies, so ``features.lookup`` broadcasts its head and no
frequent word is a hot join key.  Documents are re-assembled in position order.  An empty dictionary gives the plain
lowercased tokens (the reference's own fallback).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import text as X
from reviewlens.functions.columns import with_computed
from reviewlens.functions.stemming import stemmed
from reviewlens.operators.features import lookup
from reviewlens.session import stage


def _distinct(pos: DataFrame) -> DataFrame:
    return pos.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))


def stem_table(tokens: DataFrame) -> DataFrame:
    """Written (term, freq, mapped) for each distinct term of a (.., term) table."""
    return stage(stemmed(_distinct(tokens), "term", "mapped"), "stems")


def lemma_table(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Written (term, freq, mapped): the dictionary's lemma (the least of several), or the term itself."""
    forms = dictionary.groupBy(F.lower("form").alias("term")).agg(F.min("lemma").alias("lemma"))
    t = _distinct(tokens).join(forms, "term", "left")
    return stage(t.select("term", "freq", F.coalesce("lemma", "term").alias("mapped")), "lemmas")


def _positions(df: DataFrame, text_col: str, key: str) -> DataFrame:
    t = with_computed(df.select(key, text_col), _t=X.word_tokens(F.col(text_col)))
    return t.select(key, F.posexplode("_t").alias("pos", "term"))


def _reassemble(df: DataFrame, pos: DataFrame, mapping: DataFrame, key: str, out_col: str) -> DataFrame:
    """Replace each token by its mapping (or itself), join tokens in position order per document."""
    j = lookup(pos, mapping, ["mapped"]).select(key, "pos", F.col("mapped").alias("w"))
    g = j.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "w"))).alias("_p"))
    txt = F.array_join(F.transform("_p", lambda s: s.getField("w")), " ")
    docs = df.select(key).join(g.select(key, txt.alias(out_col)), key, "left")
    return docs.select(key, F.coalesce(out_col, F.lit("")).alias(out_col))


def stem_text(df: DataFrame, text_col: str, key: str = "doc_id", out_col: str = "stem") -> DataFrame:
    """F-15: Porter stems of the word tokens, space-joined."""
    pos = _positions(df, text_col, key)
    return _reassemble(df, pos, stem_table(pos), key, out_col)


def lemmatize_text(df: DataFrame, text_col: str, dictionary: DataFrame | None = None, key: str = "doc_id",
                   out_col: str = "lemma") -> DataFrame:
    """F-16: dictionary lemmas (form -> lemma) with the token itself as default."""
    if dictionary is None:
        return df.select(key, F.array_join(X.word_tokens(F.col(text_col)), " ").alias(out_col))
    pos = _positions(df, text_col, key)
    return _reassemble(df, pos, lemma_table(pos, dictionary), key, out_col)


def stem_vs_lemma(df: DataFrame, text_col: str, key: str = "doc_id", dictionary: DataFrame | None = None) -> DataFrame:
    """F-17: whole text, stem and lemma side by side, joined on the key."""
    s = stem_text(df, text_col, key)
    lm = lemmatize_text(df, text_col, dictionary, key)
    return df.select(key, F.col(text_col).alias("text")).join(s, key).join(lm, key)


def preprocess_for_ml(df: DataFrame, text_col: str, use_lemma: bool = True, key: str = "doc_id",
                      dictionary: DataFrame | None = None) -> DataFrame:
    """F-18: ``processed_text`` per document."""
    if use_lemma:
        return lemmatize_text(df, text_col, dictionary, key, "processed_text")
    return stem_text(df, text_col, key, "processed_text")
