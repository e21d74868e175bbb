"""Rounds of further hubs in op10_near_duplicates."""

from reviewlens.llm import neardup


def test_each_round_meets_the_hubs_of_its_own_bands(spark, monkeypatch):
    seen, real = [], neardup.with_root

    def watched(df, *names):
        if "band" in df.columns:
            seen.append({r.band for r in df.select("band").distinct().collect()})
        return real(df, *names)

    monkeypatch.setattr(neardup, "with_root", watched)
    members = spark.createDataFrame([(bytearray([n]), b, 7, 100) for n in range(3) for b in range(neardup.BANDS)],
                                    "node binary, band int, key long, size int")
    label = spark.createDataFrame([(bytearray([n]), bytearray([0])) for n in range(3)], "node binary, root binary")
    nodes = spark.createDataFrame([(bytearray([n]), [1] * neardup.BANDS) for n in range(3)], "node binary, bands array<long>")
    texts = spark.createDataFrame([(bytearray([n]), "a b c d") for n in range(3)], "id binary, text string")
    neardup.further_hubs(members, label, nodes, texts, 4)
    assert len(seen) == neardup.ROUNDS and set().union(*seen) == set(range(neardup.BANDS))
    assert sum(map(len, seen)) == neardup.BANDS


def test_heads_are_ordered_where_the_set_is(spark, monkeypatch):
    """Similar sets share a shingle of their heads, the rest of a set does not move, and no row a shingle is joined."""
    import random
    rng = random.Random(3)
    base = list(range(100, 300))
    rows = []
    for n in range(60):
        mine = sorted(set(base[:-n % 45 or None]) | {rng.getrandbits(60) for _ in range(n % 45)})
        rows.append((bytearray([n]), bytearray([n]), n % 2 == 0, mine))
    sets = spark.createDataFrame(rows, "node binary, root binary, outside boolean, s array<bigint>")
    joins, real = [], type(sets).join
    monkeypatch.setattr(type(sets), "join", lambda self, *a, **k: joins.append(a) or real(self, *a, **k))
    out = neardup.heads(sets).collect()
    assert not joins
    heads = {}
    for r in out:
        heads.setdefault(bytes(r.node), {})[r.at] = r.s
    whole = {bytes(node): set(s) for node, _, _, s in rows}
    for node, s in whole.items():
        assert sorted(heads[node]) == list(range(len(s) - -(-len(s) * 80 // 100) + 1)) and set(heads[node].values()) <= s
    assert {(bytes(r.node), r.n) for r in out} == {(k, len(v)) for k, v in whole.items()}
    for a, x in whole.items():
        for b, y in whole.items():
            if 100 * len(x & y) >= 80 * len(x | y):
                assert set(heads[a].values()) & set(heads[b].values())
    assert neardup.heads(sets.limit(0)).count() == 0
