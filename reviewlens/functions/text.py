"""Text functions as native Column expressions (no UDFs).

Python's ``\\w``, ``\\s`` and ``\\d`` are Unicode-aware while Java's (Spark)
and RE2's (DuckDB) are ASCII.  Every pattern below spells the Unicode class
out, so the same pattern string gives the same answer in Spark, DuckDB and
Python.  Never use ``\\w``, ``\\b`` or a bare ``\\s`` here.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Character classes and patterns (shared by Spark and the SQL
# oracle; changing one changes results).
# ---------------------------------------------------------------------------
WORD_CLASS = r"\p{L}\p{N}_"
WS_CLASS = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = f"[{WORD_CLASS}]"
NON_WORD = f"[^{WORD_CLASS}]"
WS = f"[{WS_CLASS}]"
WS_RUN = f"{WS}+"
DIGIT_RUN = r"\p{Nd}+"
URL = rf"https?://[^{WS_CLASS}]+|www\.[^{WS_CLASS}]+"
NOISE = rf"[^{WORD_CLASS}{WS_CLASS}']"
TOKEN = f"({WORD}+)"
PUNCT = rf"[^{WORD_CLASS}{WS_CLASS}]"

HTML_BLOCKS = [r"(?is)<script[^>]*>.*?</script[^>]*>", r"(?is)<style[^>]*>.*?</style[^>]*>", r"(?s)<!--.*?-->"]
# A "<" opens a tag only before a letter, "/", "!" or "?"; "a < b" stays.
HTML_TAG = r"<[A-Za-z/!?][^>]*>"
# Character references: numeric ones (the semicolon may be missing), named ones with it.
HTML_REFERENCE = r"&(?:#[0-9]{1,7};?|#[xX][0-9A-Fa-f]{1,6};?|[A-Za-z][A-Za-z0-9]*;)"
# The standard's names, from Python's standard library.
HTML_NAMES = {f"&{name}": value for name, value in html5.items() if name.endswith(";")}
# What the standard reads numbers 128 to 159 as: Windows-1252, where that has a character.
HTML_NUMBERS = {n: ord(c) for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))}
REPLACEMENT = 0xFFFD
APOSTROPHE = "['\u2019]"

# Contraction table (our own, applied in this order, case-insensitive).
# Whole words: (word, expansion); matched after start-of-text or a non-word char.
CONTRACTION_WORDS = [("won't", "will not"), ("can't", "cannot"), ("shan't", "shall not"), ("let's", "let us")]
# Pronoun + 's -> pronoun + " is".
CONTRACTION_PRONOUNS = ["he", "she", "it", "that", "there", "what", "where", "who", "here", "how"]
# Suffixes after a letter and before a non-word char or end of text.
CONTRACTION_SUFFIXES = [("n't", " not"), ("'re", " are"), ("'ve", " have"), ("'ll", " will"), ("'m", " am"),
                        ("'d", " would")]
# Probe: does a text contain any contraction (data-quality view).
CONTRACTION_PROBE = r"(?i)\p{L}(n't|'re|'ve|'ll|'m|'d|'s)"


def curly(word: str) -> str:
    """``word`` as a pattern, with a straight or a typographic apostrophe."""
    return word.replace("'", APOSTROPHE)


def contraction_rules() -> list[tuple[str, str, str]]:
    """(pattern, java_replacement, re2_replacement) in application order."""
    rules = []
    for word, exp in CONTRACTION_WORDS:
        rules.append((f"(?i)(^|{NON_WORD}){curly(word)}", f"$1{exp}", f"\\1{exp}"))
    pron = "|".join(CONTRACTION_PRONOUNS)
    rules.append((f"(?i)(^|{NON_WORD})({pron}){APOSTROPHE}s", "$1$2 is", "\\1\\2 is"))
    for suf, exp in CONTRACTION_SUFFIXES:
        rules.append((f"(?i)(\\p{{L}}){curly(suf)}({NON_WORD}|$)", f"$1{exp}$2", f"\\1{exp}\\2"))
    return rules


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F-01 -----------------------------------------------------------------------
def strip_html(c) -> Column:
    """Drop script/style blocks and comments, tags -> space, decode entities.

    Each group runs only on values containing its trigger character (every
    pattern needs a literal '<' or '&'), a cheap exact skip for plain text.
    """
    src = _c(c)
    tags = src
    for p in HTML_BLOCKS:
        tags = F.regexp_replace(tags, p, " ")
    tags = F.regexp_replace(tags, HTML_TAG, " ")
    out = F.when(src.contains("<"), tags).otherwise(src)
    return F.when(out.contains("&"), decode_references(out)).otherwise(out)


def decode_references(c) -> Column:
    """Named and numeric character references as their characters, each once; unknown names stay.

    The pieces between references and the references, zipped, add up to the value.  Names are looked up in a literal
    map by first letter; numbers that are no character become U+FFFD.
    """
    by_letter: dict = {}
    for name, value in HTML_NAMES.items():
        by_letter.setdefault(name[1], {})[name] = value
    names = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")
    numbers = F.from_json(F.lit(json.dumps(HTML_NUMBERS)), "map<string,int>")

    def decoded(r):
        bare = F.rtrim(r, F.lit(";"))
        digits = F.when(F.lower(F.substring(r, 3, 1)) == "x", F.conv(F.substring(bare, 4, 8), 16, 10)).otherwise(
            F.substring(bare, 3, 8)).cast("int")
        n = F.coalesce(F.try_element_at(numbers, digits.cast("string")), digits)
        n = F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), REPLACEMENT).otherwise(n)
        return F.when(F.substring(r, 2, 1) == "#", F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(F.try_element_at(names, F.substring(r, 2, 1)), r))

    def whole(x):
        pieces = F.zip_with(F.split(x, HTML_REFERENCE, -1), F.regexp_extract_all(x, F.lit(HTML_REFERENCE), F.lit(0)),
                            lambda p, r: F.concat(p, F.coalesce(decoded(r), r, F.lit(""))))
        return F.array_join(pieces, "")

    # Bound once: the value is an expensive expression and is read twice.
    return F.element_at(F.transform(F.array(_c(c)), whole), 1)


# F-02 -----------------------------------------------------------------------
def expand_contractions(c) -> Column:
    """Every rule needs an apostrophe: values without one skip the regex chain."""
    src = _c(c)
    out = src
    for pat, java_rep, _ in contraction_rules():
        out = F.regexp_replace(out, pat, java_rep)
    return F.when(src.contains("'") | src.contains("\u2019"), out).otherwise(src)


# F-03, F-04, F-05 -------------------------------------------------------------
def remove_noise(c) -> Column:
    out = F.regexp_replace(_c(c), URL, " ")
    out = F.regexp_replace(out, DIGIT_RUN, " ")
    return F.regexp_replace(out, NOISE, " ")


# F-06 -----------------------------------------------------------------------
def normalize_ws(c) -> Column:
    """Lowercase, collapse Unicode whitespace runs to one space, trim."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), WS_RUN, " "))


# F-07 -----------------------------------------------------------------------
def clean_text(c, html=strip_html, contractions=expand_contractions) -> Column:
    """F-01 -> F-02 -> F-03..F-05 -> F-06 as one expression.

    ``html`` / ``contractions`` are plug-in points (V-02): any Column -> Column.
    """
    return normalize_ws(remove_noise(contractions(html(_c(c)))))


# F-09 -----------------------------------------------------------------------
def ws_tokens(c) -> Column:
    """F-11: whitespace tokens (Python ``str.split()``)."""
    return F.filter(F.split(_c(c), WS_RUN), lambda x: x != "")


def char_len(c) -> Column:
    return F.length(_c(c))


def word_len(c) -> Column:
    return F.size(ws_tokens(c))


# F-10 -----------------------------------------------------------------------
def word_tokens(c) -> Column:
    """Lowercased maximal runs of word characters (Python ``\\b\\w+\\b``)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN), 1)


# F-13 -----------------------------------------------------------------------
def ngrams(tokens, n: int) -> Column:
    """Space-joined n-grams within one token array; none if fewer than n tokens.

    Built from n shifted slices zipped together, so the lambda only reads its
    own element: an outer array referenced inside a lambda is re-evaluated
    per element, which would re-run the whole tokenizer (quadratic).
    """
    t = _c(tokens)
    if n == 1:
        return t
    k = F.greatest(F.size(t) - n + 1, F.lit(0))
    shifted = [F.slice(t, i + 1, k).alias(str(i)) for i in range(n)]
    zipped = F.arrays_zip(*shifted)
    return F.transform(zipped, lambda e: F.concat_ws(" ", *[e.getField(str(i)) for i in range(n)]))


# F-14 -----------------------------------------------------------------------
def truncate(c, n: int = 200) -> Column:
    return F.substring(_c(c), 1, n)


# Text-stat helpers (X-06) -------------------------------------------------------
def punct_count(c) -> Column:
    return F.length(_c(c)) - F.length(F.regexp_replace(_c(c), PUNCT, ""))


def upper_count(c) -> Column:
    return F.length(_c(c)) - F.length(F.regexp_replace(_c(c), r"\p{Lu}", ""))
