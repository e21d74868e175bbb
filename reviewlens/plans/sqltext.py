"""DuckDB twins of the native text expressions, built from the same fixed patterns.

Used only to write the oracle SQL; Spark never runs these strings.
"""

from __future__ import annotations

from reviewlens.functions import text as X


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(repl)}, 'g')"


def strip_html(e: str) -> str:
    for p in X.HTML_BLOCKS:
        e = rr(e, p, " ")
    e = rr(e, X.HTML_TAG, " ")
    return f"list_transform([{e}], lambda x: case when contains(x, '&') then {decode_references('x')} else x end)[1]"


def decode_references(e: str) -> str:
    names = ", ".join(map(lit, X.HTML_NAMES))
    values = ", ".join(map(lit, X.HTML_NAMES.values()))
    numbers = " ".join(f"when {a} then {b}" for a, b in X.HTML_NUMBERS.items())
    n = ("cast(case when lower(r[2][3]) = 'x' then '0x' || rtrim(r[2][4:], ';') else rtrim(r[2][3:], ';') end as integer)")
    char = (f"list_transform([{n}], lambda n: chr(case {numbers} when n = 0 or n between 55296 and 57343 or n > 1114111 "
            f"then {X.REPLACEMENT} else n end))[1]").replace("when 1", "when n = 1")
    one = (f"case when r[2][2] = '#' then {char} else list_extract([{values}], list_position([{names}], r[2])) end")
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({e}, {lit(X.HTML_REFERENCE)}), "
            f"regexp_extract_all({e}, {lit(X.HTML_REFERENCE)})), lambda r: r[1] || coalesce({one}, r[2], '')), '')")


def expand_contractions(e: str) -> str:
    for pat, _, re2_rep in X.contraction_rules():
        e = rr(e, pat, re2_rep)
    return e


def remove_noise(e: str) -> str:
    return rr(rr(rr(e, X.URL, " "), X.DIGIT_RUN, " "), X.NOISE, " ")


def normalize_ws(e: str) -> str:
    return f"trim({rr(f'lower({e})', X.WS_RUN, ' ')})"


def clean_text(e: str) -> str:
    return normalize_ws(remove_noise(expand_contractions(strip_html(e))))


def ws_tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {lit(X.WS_RUN)}), lambda t: t <> '')"


def word_tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {lit(X.TOKEN)}, 1)"


def ngrams(toks: str, n: int) -> str:
    if n == 1:
        return toks
    return (f"list_transform(range(1, len({toks}) - {n - 2}), "
            f"lambda i: array_to_string({toks}[i:i + {n - 1}], ' '))")


def non_blank(e: str) -> str:
    return f"({e} is not null and length({rr(e, X.WS_RUN, '')}) > 0)"


def rating_int(e: str) -> str:
    return f"try_cast(trunc({e}) as integer)"


def sentiment(e: str) -> str:
    r = rating_int(e)
    return (f"(case when {r} in (1, 2) then 'negative' when {r} = 3 then 'neutral' "
            f"when {r} in (4, 5) then 'positive' else 'neutral' end)")


def sentiment_code(e: str, default: str | None = "1") -> str:
    d = f" else {default}" if default is not None else ""
    return (f"cast(case {e} when 'negative' then 0 when 'neutral' then 1 when 'positive' then 2{d} end as integer)")


def punct_count(e: str) -> str:
    return f"(length({e}) - length({rr(e, X.PUNCT, '')}))"


def upper_count(e: str) -> str:
    return f"(length({e}) - length({rr(e, chr(92) + 'p{Lu}', '')}))"


def shared_value(key: str, id_col: str = "doc_id") -> str:
    return f"(('0x' || substr(md5('{key}:' || {id_col}), 1, 6))::BIGINT / 16777216::DOUBLE)"
