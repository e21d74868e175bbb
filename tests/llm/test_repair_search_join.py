"""Conversation repair, ranked search and the set join against brute force, and on edge rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from reviewlens.llm import fingerprint, links, neardup, quality, repair, search, setjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ 11, conversation repair
def brute_repair(rows):
    """(illegal and fault counts, cost, audit, digest) of ordered (role, text) rows: all states, strings compared whole."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}  # last initial: cost, audit, lines

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for at, (cost, letters, lines) in list(states.items()):
                to = follow[at]
                new = (cost + 3, letters + "I", lines + ({"u": "user:", "a": "assistant:"}[to],))
                if to not in states or new[:2] < states[to][:2]:
                    states[to] = new
        return states

    for (role, text), fault in zip(rows, faults):
        after = {}

        def put(to, new):
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for at, (cost, letters, lines) in inserted(best).items():
            put(at, (cost + 4, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            initial = role[:1]
            if initial and (initial == follow[at] or initial == "s" and at == ""):
                put(initial, (cost + more, letters + "K", lines + (f"{role}:{text}",)))
            to = follow[at]
            put(to, (cost + 3 + more, letters + "R", lines + ({"u": "user", "a": "assistant"}[to] + ":" + text,)))
        best = after
    ends = [v for at, v in inserted(best).items() if at in ("", "a")]
    cost, letters, lines = min(ends, key=lambda v: v[:2])
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))
    count = collections.Counter(faults)
    return (count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    """The contract's damage of (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 1:
            text = ""
        elif way == 2:
            text = re.sub(r"[.!?]", "", text)
        elif way == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def want_repair(rows):
    out = {}
    groups = collections.defaultdict(list)
    for r in damage(rows):
        groups[r[0]].append(r)
    for conv in {r[0] for r in rows}:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *brute_repair([r[2:] for r in own]))
    return out


def got_repair(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in repair.digests(repair.damaged(df)).collect()}


def test_repair_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got_repair(df) == want_repair(rows)


def test_repair_of_odd_conversations_equals_brute_force(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No", "What?", "", " \t", "Again.", "x" * 300]
    rows = []
    for conv in [None, *range(150)]:
        turns = [None] * (conv == 3) + rng.sample(range(-3, 40), rng.randint(1, 12))
        for turn in turns:
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "unknown"]),
                         rng.choice([*texts, None])))
    df = spark.createDataFrame([(*r, 1, "z") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, _h int, audit string")
    assert got_repair(df) == want_repair(rows)


def test_runs_advance_by_powers_and_unroll_like_single_rows():
    rng = random.Random(3)
    for n in (1, 2, 5, 31, 1024, 1025, 3000):
        runs = [(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 11]), rng.choice([1, n])) for _ in range(3)]
        cost, letters = repair.audit(runs)
        single = repair.audit([(s, 1) for s, k in runs for _ in range(k)])
        assert (cost, letters) == single
        assert sum(c != "I" for c in letters) == sum(k for _, k in runs)
        price = {"K": 0, "R": 3, "D": 4, "I": 3}
        rows = [s for s, k in runs for _ in range(k)]
        kept = [c for c in letters if c != "I"]
        assert cost == sum(price[c] for c in letters) + sum(3 for c, s in zip(kept, rows) if c != "D" and s // 4 == 1)


def test_repair_ties_and_repeats_and_empty(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string"
    rows = [(9, 1, "user", "Same."), (9, 1, "user", "Same."), (9, 1, "user", "Other."), (9, 2, "assistant", "Fine.")]
    df = spark.createDataFrame(rows, kinds)
    got = repair.digests(repair.unharmed(df)).collect()
    again = repair.digests(repair.unharmed(spark.createDataFrame(rows[::-1], kinds))).collect()
    assert got == again and got[0].duplicate == 1
    whole = repair.repaired(repair.unharmed(df)).orderBy("place").collect()
    text = "\n".join(f"{r.role}:{r.text}" for r in whole)
    assert hashlib.sha256(text.encode()).hexdigest() == got[0].repaired_sha256
    assert [r.place for r in whole] == list(range(len(whole)))
    assert repair.digests(repair.damaged(df.limit(0))).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    gone = repair.digests(repair.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], kinds))).collect()[0]
    assert tuple(gone) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_one_long_conversation(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"Line {i}." if i % 7 else "cut off") for i in range(6000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert got_repair(df) == want_repair(rows)


# ------------------------------------------------------------------ 12, set join
def sets_of(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute_links(rows, k):
    """(doc_id, set size, component) of (doc_id, text) rows."""
    sets = [sets_of(t, k) for _, t in rows]
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {}
    for (doc, _), p in zip(rows, part):
        if doc is not None:
            least[p] = min(doc, least.get(p, doc))
    return sorted(((d, len(s), least.get(p) if s else d) for (d, _), s, p in zip(rows, sets, part)), key=repr)


def got_links(df):
    return sorted(map(tuple, setjoin.linked(df).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_set_join_equals_brute_force(small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert got_links(small) == brute_links(rows, 5)


def copies(seed, n=60):
    """Chains and groups of edited copies around the similarity, beside a passage that all texts share."""
    rng = random.Random(seed)
    passage = " ".join(f"common{i}" for i in range(30))
    rows = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(rng.choice([40, 120]))]
        for _ in range(n // 4):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words) + (" " + passage if rng.random() < 0.5 else "")))
            base = words if rng.random() < 0.3 else base
    return rows


@pytest.mark.parametrize("limits", [{}, {"SMALL": 2, "TILE": 4, "STRETCH": 200, "VISITORS": 3},
                                    {"SMALL": 2, "ROUNDS": 0, "TILE": 7, "STRETCH": 1}])
def test_set_join_of_copies_by_every_way(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(setjoin, name, value)
    monkeypatch.setattr(links, "PARTNERS", 3)
    rows = copies(len(limits))
    assert got_links(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_links(rows, 5)


def test_set_join_edges(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert got_links(edge) == brute_links(rows, 5)
    assert setjoin.linked(edge.limit(0)).count() == 0


# ------------------------------------------------------------------ 13, search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k=10):
    counts = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total, n_docs = sum(sum(c.values()) for _, c in counts), len(counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = sorted(map(tuple, search.search(small, items).collect()), key=repr)
    assert got == brute_search([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_search_edges_and_item_blocks(spark, edge, monkeypatch):
    items = spark.createDataFrame([(1, "one MAIL text"), (2, None), (3, "w1 w2 ünï 漢字"), (3, "same w5 w5"), (None, "x1 here"),
                                   (4, "--- ..."), (5, "a b one")], "item_id int, text string")
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    want = brute_search(docs, [tuple(r) for r in items.collect()])
    assert sorted(map(tuple, search.search(edge, items).collect()), key=repr) == want
    monkeypatch.setattr(search, "BLOCK_CHARS", 8)
    monkeypatch.setattr(search, "ROWS", 2)
    assert sorted(map(tuple, search.search(edge, items).collect()), key=repr) == want
    for d, i in ((edge.limit(0), items), (edge, items.limit(0))):
        assert search.search(d, i).collect() == []


def test_search_ties_go_by_doc_id(spark):
    docs = spark.createDataFrame([(7 * i % 31, "alpha beta") for i in range(31)] + [(None, "alpha beta"), (99, "gamma")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(0, "alpha")], "item_id bigint, text string")
    got = search.search(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(10)) and len({r.score for r in got}) == 1


# ------------------------------------------------------------------ mends of 3, 6 and 10
def test_likeness_of_many_equal_lines(spark):
    line = "A line that is written again and again."
    rows = [(3, "\n".join([line] * 20_000)), (2, "\n".join([line] * 10_000)), (1, "\n".join([line] * 70_000))]
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[3].near_next > 0.99 and got[2].near_next > 0.99 and got[1].near_edited > 0.99


def test_near_duplicate_stage_goes_by_row(spark, edge):
    a = " ".join(f"a{i}" for i in range(30))
    b = " ".join(f"b{i}" for i in range(30))
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "y"), (9, b, "y"), (None, b, "z"), (9, "", "e"), (None, "c d", "n"), (None, "c d", "m")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string")
    got = sorted(((r.doc_id, r.text) for r in neardup.one_of_each(df, 5).collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (9, ""), (None, "c d")], key=repr)
    kept = neardup.one_of_each(edge, 5)
    assert kept.columns == edge.columns
    want = {}
    for d, n, c in brute_links([(r.doc_id, r.text) for r in edge.collect()], 5):
        want.setdefault((c if n else object()), 0)
    assert kept.count() == len(want)
    assert neardup.one_of_each(edge.limit(0)).count() == 0


def test_kept_documents_are_the_rows_that_quality_keeps(spark, edge, small):
    for df in (edge, small):
        verdicts = collections.Counter((r.doc_id, r.n_words) for r in quality.quality(df).where("kept").collect())
        kept = quality.kept_documents(df)
        assert kept.columns == df.columns
        assert collections.Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in kept.collect()) == verdicts


def test_mixed_documents_keep_sources_of_equal_rows_apart(spark):
    from reviewlens.llm import mix

    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text, "A"), (1, text, "B"), (2, text + " x", "A"), (3, text, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mix.taken(*mix.mix(df.withColumn("lang", mix.F.lit("en"))))
    want = {r["source"]: r["words"] for r in plan.groupBy("source").agg(mix.F.sum("taken").alias("words")).collect()}
    got = collections.Counter()
    for r in mix.mixed_documents(df.withColumn("n_chars", mix.F.lit(0))).collect():
        got[r.source] += len(WORD.findall(r.text))
    assert got == collections.Counter({k: v for k, v in want.items() if v})
