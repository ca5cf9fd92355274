"""Exact top-k search by inner product with an M-tree (Ciaccia, Patella and Zezula, 1997).

Inner products become distances by one more coordinate: with ``r`` the longest vector's length, a
vector ``x`` gets ``sqrt(r*r - x.x)`` and a query gets 0, and then ``d(q, x)**2 = q.q + r*r - 2 q.x``.

The tree's upper node is a list of cells, each with a routing vector and a covering radius. A cell
is a number of subtrees of bounded size; a subtree is a node of pages, each with its routing vector,
covering radius and distance to the cell's routing vector; a page holds vectors and their distances
to its routing vector. Searches take cells, pages and vectors best-first, and leave out, by the
triangle inequality on the stored distances, whatever cannot beat the k-th result so far.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches, written

#: Vectors in a page, in a subtree, and for each cell; cells at most.
PAGE, SUBTREE, PER_CELL, CELLS = 256, 8192, 4096, 512
#: Queries that a task searches together, fewer than twice as many in a block; bytes of subtrees that a task holds.
QUERY_BLOCK, HELD = 1024, 32 << 20
#: Groups of blocks at most, and shares of the subtrees, of which there are more where one would be larger than ``HELD``.
GROUPS, SHARES = 4, 8
#: Distances are off by less than this share of the longest.
SLACK = 1e-7
#: Whole numbers below this are exact as single floats, and so is every sum on the way to them.
SINGLE = 2**24
#: What no id is greater than.
LAST_ID = 2**63 - 1

FOUND = "query_id long, vec_id long, score long"


def _matrix(column) -> np.ndarray:
    """An Arrow column of integer lists as a matrix, short ones filled up with zeros."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy().astype(np.float64)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values[offsets[0]:offsets[-1]]
    return out


def _lists(rows: np.ndarray):
    import pyarrow as pa

    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32) if rows.size else np.zeros(len(rows) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.astype(np.int64).ravel()))


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    top = np.abs(x).max(initial=0)
    return x.astype(next((t for t in (np.int8, np.int16, np.int32) if top <= np.iinfo(t).max), np.int64))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with their one more coordinate."""
    return np.column_stack([x, np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0))])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y) - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


def build_subtree(ids: np.ndarray, x: np.ndarray, route: np.ndarray, longest: float) -> dict:
    """The pages of a subtree below the routing vector ``route`` (lifted)."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    tall = lifted(x, longest)
    draw = np.random.default_rng(len(ids))
    chosen = np.sort(draw.choice(len(ids), -(-len(ids) // PAGE), replace=False))
    nearest = distances(tall, tall[chosen]).argmin(1)
    pages = []
    for page, pivot in enumerate(chosen):
        members = np.flatnonzero(nearest == page)
        if not len(members):
            continue
        away = distances(tall[members], tall[pivot:pivot + 1])[:, 0]
        by_distance = np.argsort(away, kind="stable")
        members, away = members[by_distance], away[by_distance]
        # A page that has drawn too many is cut into rings around its routing vector.
        for begin in range(0, len(members), 2 * PAGE):
            ring = slice(begin, begin + 2 * PAGE)
            pages.append({"ids": ids[members[ring]], "x": _small(x[members[ring]]), "away": away[ring], "pivot": x[pivot], "inner": away[ring][0], "radius": away[ring][-1]})
    pivots = np.stack([p["pivot"] for p in pages])
    return {
        "pages": pages, "pivots": pivots, "radius": np.array([p["radius"] for p in pages]), "inner": np.array([p["inner"] for p in pages]),
        "away": distances(lifted(pivots, longest), route[None, :])[:, 0], "route": route,
    }


class Search:
    """The best ``k`` vectors of each query of a block, in the subtrees searched so far.

    A block's queries meet a page as one product of matrices. ``floors`` and ``last`` are scores and ids of
    results that each query has already: what does not go ahead of these is left out.
    """

    def __init__(self, ids: np.ndarray, q: np.ndarray, floors: np.ndarray, last: np.ndarray, k: int, longest: float):
        kind = np.float32 if longest < SINGLE and (q * q).sum(1).max(initial=0) < SINGLE else np.float64
        self.ids, self.q, self.k, self.longest = ids, q.astype(kind), k, longest
        self.own = np.einsum("ij,ij->i", q, q)
        self.slack = SLACK * (1 + np.sqrt(longest) + np.sqrt(self.own))
        self.worst, self.last, self.limit = floors.astype(kind), last.copy(), self.reach(floors)
        self.best = (np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64))
        self.pending, self.waiting = [], 0

    def reach(self, scores: np.ndarray) -> np.ndarray:
        """How far from each query a vector may be that has this score."""
        return np.sqrt(np.maximum(self.own + self.longest - 2 * scores.astype(np.float64), 0)) + self.slack

    def _away(self, y: np.ndarray) -> np.ndarray:
        """Distances from each query to vectors; their products are exact."""
        return np.sqrt(np.maximum(self.own[:, None] + self.longest - 2 * (self.q @ y.T.astype(self.q.dtype)).astype(np.float64), 0))

    def visit(self, tree: dict, asking: np.ndarray) -> None:
        """Searches a subtree for the queries that are ``asking``."""
        # Pages ruled out by their distance to the cell's routing vector are not looked at.
        near = np.abs(self._away(tree["route"][None, :-1]) - tree["away"]) - tree["radius"] <= self.limit[:, None]
        near &= asking[:, None]
        open_ = np.flatnonzero(near.any(0))
        to_pivot = self._away(tree["pivots"][open_])
        least = np.maximum(np.maximum(to_pivot - tree["radius"][open_], tree["inner"][open_] - to_pivot), 0)
        least[~near[:, open_]] = np.inf
        for i in np.argsort(least.min(0, initial=np.inf), kind="stable"):
            asked = np.flatnonzero((least[:, i] <= self.limit) & near[:, open_[i]])
            if not len(asked):
                continue
            page = tree["pages"][open_[i]]
            low = np.searchsorted(page["away"], (to_pivot[asked, i] - self.limit[asked]).min(), "left")
            high = np.searchsorted(page["away"], (to_pivot[asked, i] + self.limit[asked]).max(), "right")
            if low >= high:
                continue
            scores = page["x"][low:high].astype(self.q.dtype) @ self.q[asked].T
            good = np.flatnonzero(scores >= self.worst[asked])
            if not len(good):
                continue
            row, of = np.divmod(good, len(asked))
            of, ids, scores = asked[of], page["ids"][low:high][row], scores.ravel()[good]
            better = ((scores > self.worst[of]) | (ids < self.last[of])) & (ids != self.ids[of])
            self.pending.append((of[better], scores[better], ids[better]))
            self.waiting += int(better.sum())
            if self.waiting > len(self.ids) * self.k:
                self.settle()

    def settle(self) -> None:
        """Takes up what was found since the last time, and looks less far."""
        of, scores, ids = (np.concatenate(c) for c in zip(self.best, *self.pending, strict=True))
        self.pending, self.waiting = [], 0
        order = np.lexsort((ids, -scores, of))
        of, begins = of[order], np.searchsorted(of[order], np.arange(len(self.ids)))
        rank = np.arange(len(of)) - begins[of]
        kept, last = order[rank < self.k], rank == self.k - 1
        self.best = (of[rank < self.k], scores[kept], ids[kept])
        full = of[last]
        self.worst[full], self.last[full] = scores[order[last]], ids[order[last]]
        self.limit = np.minimum(self.limit, self.reach(self.worst))

    def found(self):
        """The results as a table of ``FOUND``, best first."""
        import pyarrow as pa

        self.settle()
        of, scores, ids = self.best
        columns = self.ids[of], ids, scores.astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def search(tree: dict, query_id: int, q: np.ndarray, floor: int | None, k: int, longest: float) -> list[tuple[int, int]]:
    """The best ``k`` (score, id) of a subtree that are at least ``floor``, best first."""
    block = Search(np.array([query_id]), q[None, :], np.array([-np.inf if floor is None else floor]), np.array([LAST_ID]), k, longest)
    block.visit(tree, np.array([True]))
    found = block.found()
    return list(zip(found.column(2).to_pylist(), found.column(1).to_pylist(), strict=True))


def scaled(embedding: Column, factor: int) -> Column:
    """Components as whole numbers, ``floor(factor * x)``; null where one is null or not finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long"))
    return F.when(~bad, whole)


def _first_search(queries: DataFrame, subtrees: DataFrame, k: int, longest: float) -> DataFrame:
    """Results of ``queries`` in the one subtree that each of them names."""
    gathered = queries.groupBy("tree_number", "chunk").agg(F.collect_list(F.struct("query_id", "vector")).alias("queries"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                tree, asked = pickle.loads(batch.column(0)[row].as_py()), batch.column(1)[row].values
                q, n = _matrix(asked.field("vector")), len(asked)
                block = Search(asked.field("query_id").to_numpy(), q, np.full(n, -np.inf), np.full(n, LAST_ID), k, longest)
                block.visit(tree, np.full(n, True))
                yield block.found()

    # Neither side has a bound that would allow a broadcast.
    return gathered.join(subtrees.hint("merge"), "tree_number").select("tree", "queries").mapInArrow(run, FOUND)


def _search_all(blocks: DataFrame, subtrees: DataFrame, k: int, longest: float, groups: int, shares: int) -> DataFrame:
    """Results of blocks of queries in all subtrees of the cells within their reach.

    A group of blocks goes, one after the other, through a share of the subtrees, so that each subtree is met with
    the best results of those before it. Blocks are copied to all shares and subtrees to all groups, few of either;
    pairs of blocks and subtrees are formed as they are searched, and no table has them.
    """

    def run(batches):
        of, block, home = None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                if (number := batch.column(0)[row].as_py()) != of:
                    if block is not None:
                        yield block.found()
                    asked = pickle.loads(batch.column(1)[row].as_py())
                    block, home, of = Search(asked["ids"], asked["x"].astype(np.float64), asked["floors"], asked["last"], k, longest), asked["home"], number
                block.visit(pickle.loads(batch.column(3)[row].as_py()), home != batch.column(2)[row].as_py())
        if block is not None:
            yield block.found()

    def tile(group: Column, share: Column) -> Column:
        return (group * shares + share).cast("int").alias("tile")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = blocks.select("block", "reach", "queries", each(shares).alias("other")).select(
        tile(F.col("block") % groups, F.col("other")), "block", "reach", "queries")
    met = subtrees.select("cell", "tree_number", "tree", each(groups).alias("other")).select(
        tile(F.col("other"), F.col("tree_number") % shares), "cell", "tree_number", "tree")
    tasks = 2 * groups * shares
    tiles = asked.repartition(tasks, "tile").join(met.repartition(tasks, "tile").hint("merge"), "tile")
    pairs = tiles.where(F.array_contains("reach", F.col("cell")))
    return pairs.select("block", "queries", "tree_number", "tree").mapInArrow(run, FOUND)


def _chain(routes: np.ndarray) -> list[int]:
    """Cells in an order that goes on to the nearest one left."""
    away, order = distances(routes, routes), [0]
    away[:, 0] = np.inf
    for _ in range(len(routes) - 1):
        order.append(int(away[order[-1]].argmin()))
        away[:, order[-1]] = np.inf
    return order


def _blocks(routes: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first block and how many it is dealt to: large cells have several, neighbours share one."""
    first, dealt, block, size = np.zeros(len(queries), np.int64), np.ones(len(queries), np.int64), 0, 0
    for cell in _chain(routes):
        dealt[cell] = max(1, queries[cell] // QUERY_BLOCK)
        if size and (size >= QUERY_BLOCK or size + queries[cell] >= 2 * QUERY_BLOCK):
            block, size = block + 1, 0
        first[cell], size = block, size + queries[cell]
        if dealt[cell] > 1:
            block, size = block + dealt[cell], 0
    return first, dealt


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query as an array, combined before the shuffle."""
    item = F.struct((-F.col("score")).alias("minus"), F.col("vec_id"))
    return found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(item)), 1, k).alias("best"))


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, factor: int = 64, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` vectors with the largest inner
    products with each query, ties to the smaller id.

    Components are ``floor(factor * x)``; queries are the vectors with ids divisible by ``every``,
    candidates all vectors with another id. Vectors that are null, or hold a null or a component
    that is not finite, and those without an id take no part; an id that repeats counts once,
    with its least vector; short vectors count as filled up with zeros. Without vectors there are
    no rows. Scores are exact while they are below 2**53. Other columns play no part.

    Cells' routing vectors are a sample of at most ``CELLS`` vectors, every vector is in a subtree
    of its nearest one, and a cell with many vectors has many subtrees, so that a vector which a
    third of the rows share fills no task. Searches go block by block: first each query to one
    subtree of its nearest cell, for a first k-th result; then with that, in blocks of neighbours, to all
    others that it does not rule out. In many dimensions that is nearly all of them: time then grows with queries
    times vectors, memory and disk do not. The driver gets routing vectors, radii and counts of cells.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = written(
        vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), scaled(F.col(f"`{vector_column}`"), factor).alias("vector"))
        .filter("vec_id IS NOT NULL AND vector IS NOT NULL").groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x * x)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest"), F.max(F.size("vector")).alias("size")).first()
    results = "query_id long, rank int, vec_id long, score long"
    if not seen["n"]:
        return spark.createDataFrame([], results)
    longest, size = float(seen["longest"]), seen["size"]
    cells = min(CELLS, -(-seen["n"] // PER_CELL))
    sample = rows.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(cells).collect()
    routes = np.unique(np.array([r["vector"] + [0] * (size - len(r["vector"])) for r in sample], np.float64).reshape(len(sample), size), axis=0)
    shared = spark.sparkContext.broadcast(lifted(routes, longest))

    def assign(batches):
        import pyarrow as pa

        routes = shared.value
        for batch in batches:
            x = _matrix(batch.column(1))
            x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
            away = distances(lifted(x, longest), routes)
            cell = away.argmin(1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), _lists(x), pa.array(cell, pa.int32()), pa.array(away[np.arange(len(x)), cell], pa.float64()),
            ], names=["vec_id", "vector", "cell", "away"])

    placed = written(rows.mapInArrow(assign, "vec_id long, vector array<long>, cell int, away double"), "cells")
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    parts, radius = np.ones(len(routes), np.int64), np.full(len(routes), -1.0)
    for r in stats:
        parts[r["cell"]], radius[r["cell"]] = -(-r["n"] // SUBTREE), r["radius"]
    offset = np.cumsum(parts) - parts
    parts_of = F.get(F.lit(parts.tolist()), F.col("cell"))
    numbered = placed.withColumn("part", F.pmod(F.xxhash64(F.lit(2), "vec_id"), parts_of).cast("int"))

    def plant(key, table):
        import pyarrow as pa

        cell, part = key[0].as_py(), key[1].as_py()
        tree = build_subtree(table.column("vec_id").to_numpy(), _matrix(table.column("vector")), shared.value[cell], longest)
        return pa.table({"cell": pa.array([cell], pa.int32()), "tree_number": pa.array([offset[cell] + part], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    subtrees = written(numbered.groupBy("cell", "part").applyInArrow(plant, "cell int, tree_number long, tree binary"), "subtrees")

    def at_home(batches):
        """The queries with the subtree to search first, one of the nearest cell that has any."""
        import pyarrow as pa

        routes = shared.value
        for batch in batches:
            q = _matrix(batch.column(1))
            own = np.einsum("ij,ij->i", q, q)[:, None]
            away = np.sqrt(np.maximum(own + longest - 2 * q @ routes[:, :-1].T, 0))
            home = np.where(radius >= 0, away, np.inf).argmin(1)
            first = batch.column(0).to_numpy() // every % parts[home]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(home, pa.int32()), pa.array(offset[home] + first, pa.int64()),
            ], names=["query_id", "vector", "home", "tree_number"])

    asked = placed.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    asked = written(asked.mapInArrow(at_home, "query_id long, vector array<long>, home int, tree_number long"), "queries")
    queries = np.zeros(len(routes), np.int64)
    for r in asked.groupBy("home").count().collect():
        queries[r["home"]] = r["count"]
    chunks = F.get(F.lit(np.maximum(1, -(-queries // (parts * QUERY_BLOCK))).tolist()), F.col("home"))
    by_hash = F.xxhash64(F.lit(3), "query_id")
    early = written(_first_search(asked.withColumn("chunk", F.pmod(by_hash, chunks)), subtrees, k, longest), "first")

    first_block, dealt = _blocks(shared.value, queries)
    block_of = F.get(F.lit(first_block.tolist()), F.col("home")) + F.pmod(by_hash, F.get(F.lit(dealt.tolist()), F.col("home")))
    worst = F.get("best", F.lit(k - 1))
    floors = _top(early, k).select(F.col("query_id").alias("of"), (-worst["minus"]).alias("floor"), worst["vec_id"].alias("last"))
    again = asked.join(floors, F.col("query_id") == F.col("of"), "left").withColumn("block", block_of).select(
        "block", "query_id", "vector", "floor", "last", "tree_number")

    def pack(key, table):
        """A block of queries, and the cells that any of them does not rule out."""
        import pyarrow as pa

        routes, x = shared.value, _matrix(table.column("vector"))
        found = ~np.array(table.column("floor").is_null())
        floors = np.where(found, np.array(table.column("floor").fill_null(0), np.float64), -np.inf)
        last = np.array(table.column("last").fill_null(LAST_ID))
        block = Search(table.column("query_id").to_numpy(), x, floors, last, k, longest)
        near = (block._away(routes[:, :-1]) - radius <= block.limit[:, None]).any(0) & (radius >= 0)
        packed = {"ids": block.ids, "x": _small(x), "floors": floors, "last": last, "home": table.column("tree_number").to_numpy()}
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int64()), "reach": pa.array([np.flatnonzero(near).tolist()], pa.list_(pa.int32())),
            "queries": pa.array([pickle.dumps(packed)], pa.binary())})

    blocks = written(again.groupBy("block").applyInArrow(pack, "block long, reach array<int>, queries binary"), "blocks")
    # A vector's bytes in a subtree, and its id and distance.
    width = 16 + size * _small(np.array([np.sqrt(longest)])).itemsize
    count = int((first_block + dealt).max())
    late = _search_all(blocks, subtrees, k, longest, min(count, GROUPS), max(min(SHARES, int(parts.sum())), -(-seen["n"] * width // HELD)))
    best = _top(early.unionAll(late), k).select("query_id", F.posexplode("best").alias("place", "item"))
    return best.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("item.vec_id").alias("vec_id"), (-F.col("item.minus")).alias("score"))
