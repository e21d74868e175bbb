"""N-grams of a part of the documents, counted and weighted as numbers in Arrow batches (X-01, X-02).

Tokens come from the JVM, space-joined; a row without any is null.  A gram is a number within its part; its text is built once a part, when rows leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows of one batch that leaves a task.
ROWS = 1 << 16


def grams_of(tokens: list[pa.StringArray], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, gram) of every n-gram of the rows, a null row has none; and the distinct grams' texts, space-joined, by number."""
    tokens = [pc.split_pattern(t, " ") for t in tokens]
    flat = [t.flatten() for t in tokens]
    sizes = [pc.fill_null(pc.list_value_length(t), 0).to_numpy(zero_copy_only=False) for t in tokens]
    row = np.repeat(np.arange(sum(map(len, sizes))), np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64))
    coded = pa.concat_arrays([*flat, pa.array([], pa.string())]).dictionary_encode()
    word, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    flat.clear()
    rows, codes, texts, first = [], [], [], 0
    code, names = word, words
    for n in range(1, hi + 1):
        if n > 1:
            inside = row[:max(len(row) - n + 1, 0)] == row[n - 1:]
            pair = pa.array(code[:len(inside)] * len(words) + word[n - 1:]).filter(pa.array(inside)).dictionary_encode()
            head, tail = np.divmod(pair.dictionary.to_numpy(), max(len(words), 1))
            names = pc.binary_join_element_wise(names.take(pa.array(head)), words.take(pa.array(tail)), " ")
            code = np.zeros(len(inside), np.int64)  # at the places of grams; others are never read: a longer gram holds this one
            code[inside] = pair.indices.to_numpy()
        if n >= lo:
            here = slice(None) if n == 1 else inside
            rows.append(row[:len(code)][here])
            codes.append(code[here] + first)
            texts.append(names)
            first += len(names)
    return np.concatenate(rows), np.concatenate(codes), pa.concat_arrays(texts)


def _plain(v):
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in v.items())
    if isinstance(v, list):
        return tuple(map(_plain, v))
    return "NaN" if isinstance(v, float) and v != v else v


def groups_of(*columns: pa.Array) -> np.ndarray:
    """Number of each row's values: equal values, nulls too, have the same."""
    seen: dict = {}
    values = zip(*[c.to_pylist() for c in columns])
    return np.fromiter((seen.setdefault(tuple(map(_plain, v)), len(seen)) for v in values), np.int64, len(columns[0]))


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, np.int64)


def _column(batches: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.concat_arrays([b.column(name) for b in batches])


def _by_part(batches) -> dict[int, list[pa.RecordBatch]]:
    out: dict[int, list[pa.RecordBatch]] = {}
    for b in batches:
        for part in pc.unique(b.column("_part")).to_pylist():
            mine = b.filter(pc.equal(b.column("_part"), part))
            out.setdefault(part, []).append(mine)
    return out


def part_terms(same: list[str], lo: int, hi: int):
    """Rows ``_part, _fit, same.., _t`` -> ``_part, term, freq, df``: each gram of a part, with its counts in the fit documents.

    Rows that are equal in ``same`` are one document.
    """
    def run(batches):
        parts = _by_part(batches)
        for part in sorted(parts):
            own = parts.pop(part)
            row, gram, texts = grams_of([b.column("_t") for b in own], lo, hi)
            group = groups_of(*[_column(own, c) for c in same])
            inside = _column(own, "_fit").to_numpy(zero_copy_only=False)[row]
            n = max(len(texts), 1)
            freq = np.bincount(gram[inside], minlength=n)
            both = np.sort(group[row[inside]] * n + gram[inside])
            df = np.bincount(both[_runs(both)] % n, minlength=n)
            for at in range(0, len(texts), ROWS):
                s = slice(at, min(at + ROWS, len(texts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(s.stop - at, part, np.int32)), texts[s], pa.array(freq[s].astype(float)), pa.array(df[s])],
                    ["_part", "term", "freq", "df"])

    return run


def totals(batches):
    """``_part, term, df`` with the sum over all parts in place of the part's own, without terms of no fit document.

    A task has all rows of its terms: at most one a part.
    """
    own = [b for b in batches if b.num_rows]
    if not own:
        return
    coded = _column(own, "term").dictionary_encode()
    index = coded.indices.to_numpy()
    df = np.bincount(index, weights=_column(own, "df").to_numpy(), minlength=len(coded.dictionary)).astype(np.int64)
    at = 0
    for b in own:
        mine = df[index[at:at + b.num_rows]]
        at += b.num_rows
        keep = pa.array(mine > 0)
        yield pa.RecordBatch.from_arrays(
            [b.column("_part").filter(keep), b.column("term").filter(keep), pa.array(mine).filter(keep)], ["_part", "term", "df"])


def part_rows(key: str, carry: list[str], lo: int, hi: int, weighted: bool, numbered: bool):
    """Rows of documents (``_part, key, carry.., _t``) and of known terms (``_part, term, _w[, index]``) of a part, in any order ->
    ``key, carry.., term[, index], value``, a row for each known term of a document.

    ``value`` is the count, or where ``weighted`` the count times ``_w``, divided by the norm of all rows of the key.
    """
    def run(batches):
        parts = _by_part(batches)
        for part in sorted(parts):
            own = parts.pop(part)
            terms = [b.filter(pc.is_valid(b.column("term"))) for b in own]
            docs = [b.filter(pc.is_null(b.column("term"))) for b in own]
            own.clear()
            known = _column(terms, "term")
            weight = _column(terms, "_w").to_numpy(zero_copy_only=False)
            number = _column(terms, "index") if numbered else None
            terms.clear()
            row, gram, texts = grams_of([b.column("_t") for b in docs], lo, hi)
            columns = [_column(docs, c) for c in (key, *carry)]
            docs.clear()
            place = pc.index_in(texts, value_set=known)
            del known
            is_known = pc.is_valid(place).to_numpy(zero_copy_only=False)
            place = pc.fill_null(place, 0).to_numpy(zero_copy_only=False)
            kept = is_known[gram]
            row, gram = row[kept], gram[kept]
            if not len(row):
                continue
            group, by_key = groups_of(*columns), groups_of(columns[0])
            one = np.zeros(group.max() + 1, np.int64)
            one[group[::-1]] = np.arange(len(group))[::-1]  # the first row of a group
            both = np.sort(group[row] * len(texts) + gram)
            first = _runs(both)
            tf = np.diff(np.append(first, len(both))).astype(float)
            doc, gram = np.divmod(both[first], len(texts))
            del both, row
            doc = one[doc]
            if weighted:
                value = tf * weight[place[gram]]
                value /= np.sqrt(np.bincount(by_key[doc], value * value))[by_key[doc]]
            else:
                value = tf
            for at in range(0, len(gram), ROWS):
                s = slice(at, at + ROWS)
                d, g = pa.array(doc[s]), gram[s]
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(d) for c in columns], texts.take(pa.array(g)),
                     *([number.take(pa.array(place[g]))] if numbered else []), pa.array(value[s])],
                    [key, *carry, "term", *(["index"] if numbered else []), "value"])

    return run
