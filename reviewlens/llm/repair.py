"""Conversation structure repair by run-length dynamic programming.

A conversation's rows, by turn, become symbols: the initial of the role (s, u, a, other) and the row's first fault.  Edits
turn the initials into ``(s?(ua)+)?`` at the least cost, a walk through four states (nothing yet, after s, after u, after a).
A symbol is a 4 x 4 min-plus matrix: the cost of getting from one state to another over one such row, insertions before
the row included.  Equal consecutive symbols are one *run*; a run of n rows costs a vector log2(n) products with
the cached binary powers of its matrix.  Costs to the end are kept at the run ends alone; choices are then unrolled
from the front, a stretch of ``STRETCH`` rows at a time, taking the least letter that still reaches the least cost.

Two passes, each shuffled by conversation and streamed in order: the first carries no texts (two hashes stand for
role and text) and gives the audit; the second carries the texts behind their audit, row after row, so a long
conversation is never held as a whole.  What one task holds of a conversation is its runs and its audit, a byte a row,
which is a single value of the result; the digest of all its texts is sequential, too.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_ready

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 60
#: Costs to the end when no rows are left: nothing and "after a" may end; "after u" needs an assistant, "after s" both.
END = (0, 2 * INSERT, INSERT, 0)
#: State after the next user or assistant, and that role.
NEXT = (2, 2, 3, 2)
ROLE_OF = ("user", "user", "assistant", "user")
INITIALS = "sua"
STRETCH = 1024


def kept_state(state: int, initial: int) -> int:
    """State after keeping a row with this initial (0 s, 1 u, 2 a, 3 other), or -1."""
    if initial == 0:
        return 1 if state == 0 else -1
    return NEXT[state] if initial == NEXT[state] - 1 else -1


@lru_cache(None)
def row_costs(symbol: int) -> tuple:
    """Min-plus matrix of one row.  A symbol is 4 * fault + initial; faults: 0 none, 1 truncated, 2 must go."""
    fault, initial = divmod(symbol, 4)
    out = [[FAR] * 4 for _ in range(4)]
    for start in range(4):
        at, paid = start, 0
        for _ in range(4):  # insertions before the row; a fourth returns to a state already seen
            moves = [(at, DELETE)]
            if fault < 2:
                more = TRUNCATED * fault
                moves.append((NEXT[at], REROLE + more))
                if kept_state(at, initial) >= 0:
                    moves.append((kept_state(at, initial), KEEP + more))
            for to, cost in moves:
                out[start][to] = min(out[start][to], paid + cost)
            at, paid = NEXT[at], paid + INSERT
    return tuple(map(tuple, out))


@lru_cache(None)
def power(symbol: int, k: int) -> tuple:
    """Matrix of a run of 2 ** k rows."""
    if k == 0:
        return row_costs(symbol)
    m = power(symbol, k - 1)
    return tuple(tuple(min(m[i][j] + m[j][o] for j in range(4)) for o in range(4)) for i in range(4))


def before(symbol: int, n: int, after: tuple) -> tuple:
    """Costs to the end before a run of n rows, from those after it."""
    k = 0
    while n:
        if n & 1:
            m = power(symbol, k)
            after = tuple(min(m[i][j] + after[j] for j in range(4)) for i in range(4))
        n, k = n >> 1, k + 1
    return after


def unrolled(symbol: int, n: int, state: int, after: tuple, out: list[str]) -> int:
    """Append the letters of a run's cheapest edits, the ASCII-least of them, to ``out``; the state behind it."""
    fault, initial = divmod(symbol, 4)
    more = TRUNCATED * fault
    while n:
        rows = min(n, STRETCH)
        n -= rows
        costs = [before(symbol, n, after)]
        for _ in range(rows):
            costs.append(before(symbol, 1, costs[-1]))
        for j in range(rows, 0, -1):
            here, behind = costs[j], costs[j - 1]
            while True:
                if DELETE + behind[state] == here[state]:
                    out.append("D")
                elif INSERT + here[NEXT[state]] == here[state]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                elif kept_state(state, initial) >= 0 and KEEP + more + behind[kept_state(state, initial)] == here[state]:
                    out.append("K")
                    state = kept_state(state, initial)
                else:
                    out.append("R")
                    state = NEXT[state]
                break
    return state


def audit(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Least cost of a conversation given as (symbol, rows) runs, and the letters of its edits."""
    ends = [END]
    for symbol, n in reversed(runs):
        ends.append(before(symbol, n, ends[-1]))
    ends.reverse()
    state, out = 0, []
    for (symbol, n), after in zip(runs, ends[1:]):
        state = unrolled(symbol, n, state, after, out)
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return ends[0][0], "".join(out)


_short_audit = lru_cache(1 << 14)(lambda runs: audit(list(runs)))


class Conversation:
    """What the first pass keeps of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.runs, self.last = conv_id, [], None
        self.faults, self.illegal = [0, 0, 0], 0
        self.least = self.most = self.turn = None
        self.turns = 0

    def add(self, turn, initial: int, fault: int) -> None:
        """A row: ``fault`` 0 none, 1 truncated, 2 blank, 3 duplicate."""
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.turns += 1
        if fault:
            self.faults[fault - 1] += 1
        if self.last is not None and (self.last, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.last = initial
        symbol = 4 * min(fault, 2) + (initial if fault < 2 else 3)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + 1)
        else:
            self.runs.append((symbol, 1))

    def row(self) -> tuple:
        cost, letters = _short_audit(tuple(self.runs)) if len(self.runs) <= 16 and sum(
            n for _, n in self.runs) <= 64 else audit(self.runs)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.faults[1], self.faults[2], self.faults[0], self.illegal, cost, letters)


STATS = [("gaps", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"),
         ("illegal", "bigint"), ("cost", "bigint"), ("audit", "string")]


def damaged(df: DataFrame) -> DataFrame:
    """The contract's damage: ``conv_id, turn, role, text, copies`` (0: dropped).  Nulls count as one space."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                      F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                  F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_way"))
    way = F.col("_way")
    text = F.when(way == 1, "").when(way == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", F.when(way == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.when(way == 0, 0).when(way == 3, 2).otherwise(1).alias("copies"))


def unharmed(df: DataFrame) -> DataFrame:
    """Rows as they are, in the form of ``damaged``."""
    return df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                     F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("_h"), F.xxhash64("text", F.lit(1), "role").alias("_g")]


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_h"), F.col("_g"), F.col("_copy")]


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` of every conversation of ``rows`` (as ``damaged`` gives them).

    Rows are ordered by turn, nulls first; of rows with equal turns by role and a hash of role and text, so repeated
    rows are adjacent.  A null conv_id is a conversation.  One without rows (all dropped) has zeros and an empty audit.
    An empty table gives no rows.
    """
    arrow_ready(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.left(F.col("role"), F.lit(1))
    narrow = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "role", *_hashes(), (body == "").alias("_blank"),
        F.right(body, F.lit(1)).isin(".", "!", "?").alias("_ended"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("_initial"),
        F.explode(F.sequence(F.least(F.lit(1), "copies"), "copies")).alias("_copy")).repartition("conv_id")
    # By conversation already, so the window sorts but does not shuffle again.
    seen = F.row_number().over(Window.partitionBy("conv_id", "_copy_kind", "_h", "_g").orderBy("turn"))
    d = narrow.withColumn("_copy_kind", F.col("_copy") > 0).withColumn("_seen", seen)
    fault = F.when(F.col("_blank"), 2).when(F.col("_seen") > 1, 3).when(~F.col("_ended"), 1).otherwise(0)
    d = d.withColumn("_fault", fault).sortWithinPartitions("conv_id", *_order()).select(
        "conv_id", "turn", F.col("_initial").cast("int"), F.col("_fault").cast("int"), F.col("_copy").cast("int"))

    def run(batches):
        def table(found):
            columns = list(zip(*[c.row() for c in found])) or [()] * 8
            kinds = [pa_kind, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["conv_id", *[n for n, _ in STATS]])

        now, pa_kind = None, None
        for batch in batches:
            pa_kind, done = batch.schema.field(0).type, []
            for conv, turn, initial, fault, copy in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv != now.conv_id:
                    done += [now] if now else []
                    now = Conversation(conv)
                if copy:
                    now.add(turn, initial, fault)
            yield table(done)
        if now:
            yield table([now])

    return d.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{n} {k}" for n, k in STATS))


def replay(letters, state: int = 0):
    """Follow an audit: send (role, text) of the next row; gives the repaired (edit, role, text) rows up to it.

    ``None`` in place of a row asks for what is inserted after the last.
    """
    at, out = 0, []
    while True:
        row = yield out
        out = []
        while at < len(letters) and letters[at] == "I":
            out.append(("I", ROLE_OF[state], ""))
            state, at = NEXT[state], at + 1
        if row is None:
            continue
        edit, at = letters[at], at + 1
        role, text = row
        if edit == "K":
            state = kept_state(state, INITIALS.find(role[:1]) if role else 3)
        elif edit == "R":
            role, state = ROLE_OF[state], NEXT[state]
        if edit != "D":
            out.append((edit, role, text))


def _streams(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Every conversation's audit row, its own rows behind it in order."""
    empty = [F.lit(None).cast(k).alias(n) for n, k in STATS]
    texts = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("_kind"), F.col("turn").cast("bigint").alias("turn"), "role", "text", *_hashes(),
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"), *empty)
    heads = audited.select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(0).cast("bigint").alias("_h"), F.lit(0).cast("bigint").alias("_g"),
        F.lit(0).alias("_copy"), *[n for n, _ in STATS])
    d = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "_kind", *_order())
    return d.select("conv_id", "_kind", "role", "text", *[n for n, _ in STATS])


def _replayed(batches):
    """(head row or None, repaired rows) pieces of the conversations in a sorted stream."""
    head, steps = None, None
    for batch in batches:
        names = batch.schema.names
        for values in zip(*[c.to_pylist() for c in batch.columns]):
            if values[1] == 0:
                if steps:
                    yield head, steps.send(None), True
                head, steps = dict(zip(names, values)), replay(values[names.index("audit")])
                next(steps)
            else:
                yield head, steps.send((values[2] or "", values[3] or "")), False
    if steps:
        yield head, steps.send(None), True


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (from 0), ``edit`` (K kept, R new role, I inserted), ``role, text``.

    Edge rows as in ``audits``; a conversation whose rows all go has no rows here.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    d = _streams(rows, audits(rows))

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        pa_kind = first.schema.field(0).type

        def chained():
            yield first
            yield from batches

        place, held, size = 0, [], 0
        for head, got, last in _replayed(chained()):
            for edit, role, text in got:
                held.append((head["conv_id"], place, edit, role, text))
                place, size = place + 1, size + len(text)
            place = 0 if last else place
            if len(held) >= 5_000 or size > 4 << 20:
                yield _batch(held, pa_kind)
                held, size = [], 0
        if held:
            yield _batch(held, pa_kind)

    def _batch(held, pa_kind):
        kinds = [pa_kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)],
                                          ["conv_id", "place", "edit", "role", "text"])

    return d.mapInArrow(run, f"conv_id {kind}, place bigint, edit string, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256``: the digest of the repaired ``role:text`` lines, joined by line feeds."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    d = _streams(rows, audits(rows))
    names = ["conv_id", *[n for n, _ in STATS]]

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        pa_kind = first.schema.field(0).type

        def chained():
            yield first
            yield from batches

        def table(done):
            kinds = [pa_kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                              [*names, "repaired_sha256"])

        digest, started, done = hashlib.sha256(), False, []
        for head, got, last in _replayed(chained()):
            for _, role, text in got:
                digest.update(("\n" * started + f"{role}:{text}").encode())
                started = True
            if last:
                done.append((*[head[n] for n in names], digest.hexdigest()))
                digest, started = hashlib.sha256(), False
                if len(done) >= 5_000:
                    yield table(done)
                    done = []
        if done:
            yield table(done)

    return d.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{n} {k}" for n, k in STATS) + ", repaired_sha256 string")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return digests(damaged(table(spark, sf_dir, "conversations")))
