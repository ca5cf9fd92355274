import random

import pytest

from brooklet.llm import near_dedup
from brooklet.llm.components import connected_components


def brute(rows, size, part, whole):
    def shingles(text):
        words = [w for w in (text or "").encode().lower().split()]
        return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and whole * len(x & y) >= part * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return sorted(((i, len(s), least.get(root(a)) if s else i) for a, (i, s) in enumerate(sets)), key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize(("size", "part", "rows", "chunk"), [(3, 85, 3, 256), (5, 80, 2, 256), (3, 85, 3, 3)])
def test_against_all_pairs(frame, hostile, monkeypatch, size, part, rows, chunk):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    df = near_dedup.near_duplicates(frame(hostile), words=size, part=part, rows=rows)
    assert found(df) == brute(hostile, size, part, 100)


def test_one_of_each_component_is_kept(frame, hostile):
    rows = near_dedup.near_duplicates(frame(hostile), words=3, part=85, rows=3).collect()
    kept = [r for r in rows if r["kept"]]
    assert all(r["doc_id"] == r["component_id"] for r in kept)
    with_words = [r["component_id"] for r in kept if r["n_shingles"]]
    assert len(with_words) == len(set(with_words))
    assert {r["component_id"] for r in rows} == {r["component_id"] for r in kept}


def test_a_group_whose_members_are_linked_through_others_only(frame, monkeypatch):
    """Chains: each text shares most words with the next, and few with the far ones."""
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    draw = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 100])) for i in range(60)]
    rows += [(1000 + i, " ".join(draw.choice("abcdefghij") + str(draw.randrange(50)) for _ in range(40))) for i in range(40)]
    df = near_dedup.near_duplicates(frame(rows), words=3, part=85, rows=3)
    assert found(df) == brute(rows, 3, 85, 100)


def test_recall_at_the_threshold():
    for t, rows in ((0.8, 2), (0.85, 3)):
        n = near_dedup.bands_for(t, rows, 2e-4)
        assert 2 * (1 - t ** rows) ** n <= 2e-4


def test_empty_table_and_table_without_words(frame):
    assert near_dedup.near_duplicates(frame([])).count() == 0
    assert found(near_dedup.near_duplicates(frame([(2, None), (1, " ")]))) == [(1, 0, 1), (2, 0, 2)]


def test_components_against_search(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 50)]
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    want = {}
    for start in sorted(near):
        stack = [start]
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = start
                stack += near[x]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: c for x, c in want.items() if len(near[x] - {x})}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
