import math

import numpy as np
import pytest

from brooklet.llm import metric_tree


def brute(rows, k, every, factor):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(factor * x) for x in v]
            kept[i] = min(kept.get(i, whole), whole)
    out = []
    for q in kept:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(n, size, seed):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(size=size).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # One vector of very many rows.
    return rows + [(-20, rows[1][1]), (None, rows[2][1]), (5000, None), (5020, [1.0, None]), (5040, [math.nan]), (5060, [math.inf]), (5080, []),
                   (5100, [2.0]), (3, rows[3][1]), (3, rows[4][1])]


@pytest.mark.parametrize(("page", "subtree", "per_cell"), [(256, 8192, 4096), (4, 16, 12), (3, 500, 25)])
def test_against_all_pairs(spark, monkeypatch, page, subtree, per_cell):
    monkeypatch.setattr(metric_tree, "PAGE", page)
    monkeypatch.setattr(metric_tree, "SUBTREE", subtree)
    monkeypatch.setattr(metric_tree, "PER_CELL", per_cell)
    rows = vectors(240, 6, 3)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, cell int, part string").repartition(4)
    got = sorted(tuple(r) for r in metric_tree.top_k(df, k=7, every=20, factor=8).collect())
    assert got == brute(rows, 7, 20, 8)


def test_fewer_vectors_than_k_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = metric_tree.top_k(spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [0.5])], schema), k=20).collect()
    assert sorted(tuple(r) for r in few) == [(0, 1, 1, 64 * 32), (0, 2, 2, 64 * 32)]
    assert metric_tree.top_k(spark.createDataFrame([], schema)).count() == 0
    assert metric_tree.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0


def test_bounds_leave_out_pages(monkeypatch):
    monkeypatch.setattr(metric_tree, "PAGE", 32)  # Several pages for each of the twenty clusters.
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 8)) * 400
    x = np.floor(centres[draw.integers(0, 20, 4000)] + draw.normal(size=(4000, 8)) * 3)
    longest = float((x * x).sum(1).max())
    tree = metric_tree.build_subtree(np.arange(4000), x, metric_tree.lifted(x[:1], longest)[0], longest)
    looked = []

    class Page(dict):
        def __getitem__(self, name):
            if name == "x":
                looked.append(1)
            return super().__getitem__(name)

    tree["pages"] = [Page(p) for p in tree["pages"]]
    q = x[17]
    found = metric_tree.search(tree, 17, q, None, 10, longest)
    scores = x @ q
    want = sorted((-s, i) for i, s in enumerate(scores) if i != 17)[:10]
    assert found == [(int(-s), i) for s, i in want]
    assert len(looked) < len(tree["pages"]) / 2


def test_no_table_has_pairs_of_queries_and_subtrees(spark, monkeypatch):
    """each query went with its vector to every subtree in its reach, and there searched alone."""
    monkeypatch.setattr(metric_tree, "SUBTREE", 16)
    monkeypatch.setattr(metric_tree, "PER_CELL", 12)
    monkeypatch.setattr(metric_tree, "QUERY_BLOCK", 8)
    monkeypatch.setattr(metric_tree, "HELD", 2000)
    sizes, kept = {}, metric_tree.written

    def counted(df, label):
        table = kept(df, label)
        sizes[label] = table.count()
        return table

    monkeypatch.setattr(metric_tree, "written", counted)
    rows = [(i, v) for i, v in vectors(500, 24, 7) if i is not None]
    got = metric_tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, every=10, factor=8).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 10, 8)
    # A query is within reach of nearly all of some fifty subtrees.
    assert sizes["subtrees"] > 40
    assert max(sizes.values()) <= len(rows)


def test_sums_beyond_single_floats(spark):
    rows = vectors(100, 3, 11)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, metric_tree.top_k(df, k=4, every=10, factor=2**20).collect()))
    assert got == brute(rows, 4, 10, 2**20)
    assert got[0][3] > metric_tree.SINGLE


def test_a_block_meets_a_page_once():
    draw = np.random.default_rng(2)
    x = np.floor(draw.normal(size=(2000, 16)) * 20)
    x[500:1500] = x[3]  # Very many ties.
    ids, longest = draw.permutation(2000), float((x * x).sum(1).max())
    tree = metric_tree.build_subtree(ids, x, metric_tree.lifted(x[:1], longest)[0], longest)
    looked = []

    class Page(dict):
        def __getitem__(self, name):
            if name == "x":
                looked.append(1)
            return super().__getitem__(name)

    tree["pages"] = [Page(p) for p in tree["pages"]]
    n, k = 60, 9
    block = metric_tree.Search(ids[:n], x[:n], np.full(n, -np.inf), np.full(n, metric_tree.LAST_ID), k, longest)
    block.visit(tree, np.arange(n) != 5)
    found = list(zip(*[c.to_pylist() for c in block.found().columns], strict=True))
    scores = x[:n] @ x.T
    assert found == [
        (ids[q], int(i), int(-s)) for q in range(n) if q != 5 for s, i in sorted((-s, i) for s, i in zip(scores[q], ids) if i != ids[q])[:k]]
    assert len(looked) <= len(tree["pages"])
