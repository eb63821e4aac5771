"""Nearest neighbours: vantage-point trees per shard, pruned by the triangle inequality.

Vectors are dealt to shards by a hash of the row.  A shard's tree halves its
vectors again and again at the median distance from a vantage point (of a
few candidates the one with the widest spread of distances), down to leaves
of ``LEAF`` vectors; trees are written as tables, a row each.

Queries are searched in blocks.  For a tree, the distances of a block's
queries to all vantage points bound each leaf from below: a query outside
the ball of a leaf's side is at least its distance to the sphere away.  Each
query visits the leaves in the order of their bounds and stops when the
bound times ``relax`` exceeds the tenth distance found so far in the task.
With ``relax`` = 1 that is the triangle inequality, and the result is exact;
larger factors visit fewer leaves and may miss neighbours.  Distances are
taken between the original vectors in double precision.

Bounds: a task holds one tree of at most ``SHARD`` vectors and a block of
queries with at most ``BLOCK_VALUES`` numbers; more queries mean more blocks.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part; a row repeated in id and vector counts
once, and is never its own neighbour; only vectors of equal length are
compared; rows without an id are candidates but no queries; rows that share
an id but not the vector are queries and candidates each for itself; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from casaframe.llm.common import written

TOP = 10
EVERY = 100                  # rows whose id this divides are queries
RELAX = 1.0                  # factor on the bound: 1 is exact
SHARD = 8192                 # vectors of one tree
LEAF = 64                    # vectors of one leaf
CANDIDATES = 5               # vantage points tried for each split
SAMPLE = 64                  # vectors that judge a vantage point
BLOCK_VALUES = 1 << 21       # numbers of one block of queries (16 MB)


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): the rows that take part, each once, as arrays of doubles."""
    v = F.col(vec).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0.0))
            .dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")))


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of ``x`` to one vector, from their differences."""
    d = x - q
    return np.sqrt((d * d).sum(axis=1))


def rough(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """All distances between two sets, by products; right to about 1e-7 of the norms."""
    sq = (x * x).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2.0 * (x @ q.T)
    return np.sqrt(np.maximum(sq, 0.0))


class Tree:
    """Vectors in leaf order; per inner node a vantage point and the radius of its inner half."""

    def __init__(self, ids: list, x: np.ndarray, leaf: int = LEAF, seed: int = 0):
        rng = np.random.default_rng(seed)
        order, self.vantage, self.radius, self.cuts, self.paths = [], [], [], [0], []

        def split(at: np.ndarray, path: tuple) -> None:
            if len(at) <= leaf:
                order.append(at)
                self.cuts.append(self.cuts[-1] + len(at))
                self.paths.append(path)
                return
            some = x[rng.choice(at, min(SAMPLE, len(at)), replace=False)]
            tried = rng.choice(at, min(CANDIDATES, len(at)), replace=False)
            spread = [distances(some, x[c]).std() for c in tried]
            v = x[tried[int(np.argmax(spread))]]
            d = distances(x[at], v)
            by = np.argsort(d, kind="stable")
            half = len(at) // 2
            node = len(self.vantage)
            self.vantage.append(v)
            # every vector of the inner half is at most, of the outer at least, that far away
            self.radius.append((d[by[half - 1]], d[by[half]]))
            split(at[by[:half]], (*path, (node, 0)))
            split(at[by[half:]], (*path, (node, 1)))

        split(np.arange(len(x)), ())
        order = np.concatenate(order)
        self.ids, self.x = [ids[i] for i in order.tolist()], x[order]

    def pack(self) -> tuple:
        steps = max(map(len, self.paths), default=0)
        way = np.full((len(self.paths), steps, 2), -1, dtype="<i4")
        for k, p in enumerate(self.paths):
            for j, step in enumerate(p):
                way[k, j] = step
        vantage = np.array(self.vantage, dtype="<f8").reshape(-1, self.x.shape[1])
        return (self.x.shape[1], self.ids, self.x.astype("<f8").tobytes(), vantage.tobytes(),
                np.array(self.radius, dtype="<f8").reshape(-1, 2).tobytes(),
                np.array(self.cuts, dtype="<i8").tobytes(), steps, way.tobytes())


TREE = ("dim int, ids array<long>, x binary, vantage binary, radius binary, cuts binary, "
        "steps int, way binary")


def build(vectors: DataFrame, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """A row per tree.  ``vectors`` as returned by ``usable``."""
    schema = StructType.fromDDL(TREE)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def tree(ids: list, x: list, dim: int) -> pa.RecordBatch:
            one = Tree(ids, np.concatenate(x).reshape(-1, dim), leaf).pack()
            return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(one, arrow)],
                                              schema=arrow)

        for batch in batches:
            col = batch.column("v")
            flat = col.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.diff(col.offsets.to_numpy()))
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                ids, x = held.setdefault(dim, ([], []))
                for k in np.flatnonzero(dims == dim).tolist():
                    ids.append(batch.column("vec_id")[k].as_py())
                    x.append(flat[ends[k] - dim:ends[k]].copy())
                    if len(ids) >= shard:
                        yield tree(ids, x, dim)
                        ids.clear()
                        x.clear()
        for dim, (ids, x) in held.items():
            if ids:
                yield tree(ids, x, dim)

    return vectors.select("vec_id", "v", "dim").mapInArrow(run, schema)


class Block:
    """Queries of one length, each with its nearest vectors so far."""

    def __init__(self, ids: list, names: list, q: np.ndarray, top: int):
        self.ids, self.names, self.q, self.top = np.array(ids, dtype=np.int64), names, q, top
        n = len(ids)
        self.d = np.full((n, top), np.inf)
        self.who = np.zeros((n, top), dtype=np.int64)
        self.lost = np.ones((n, top), dtype=bool)       # no id: after all ids among equals
        self.visited = 0

    def offer(self, k: int, d: np.ndarray, who: np.ndarray, lost: np.ndarray) -> None:
        d, who = np.concatenate((self.d[k], d)), np.concatenate((self.who[k], who))
        lost = np.concatenate((self.lost[k], lost))
        best = np.lexsort((who, lost, d))[:self.top]
        self.d[k], self.who[k], self.lost[k] = d[best], who[best], lost[best]

    def search(self, x: np.ndarray, ids: np.ndarray, lost: np.ndarray, vantage: np.ndarray,
               radius: np.ndarray, cuts: np.ndarray, way: np.ndarray, relax: float) -> None:
        n, leaves = len(self.q), len(cuts) - 1
        bound = np.zeros((n, leaves))
        slack = 1e-6 * (1.0 + np.abs(x).max() + np.abs(self.q).max()) * np.sqrt(x.shape[1])
        if len(vantage):
            far = rough(self.q, vantage)
            for j in range(way.shape[1]):
                node, side = way[:, j, 0], way[:, j, 1]
                here = node >= 0
                to = far[:, node[here]]
                r = radius[node[here], side[here]]
                gap = np.where(side[here] == 0, to - r, r - to) - slack
                bound[:, here] = np.maximum(bound[:, here], gap)
        order = np.argsort(bound, axis=1, kind="stable")
        active = np.arange(n)
        for turn in range(leaves):
            leaf = order[active, turn]
            go = bound[active, leaf] * relax <= self.d[active, -1]
            active, leaf = active[go], leaf[go]
            if not len(active):
                break
            by = np.argsort(leaf, kind="stable")
            cut = np.flatnonzero(np.diff(leaf[by], prepend=-1))
            for lo, hi in zip(cut, [*cut[1:], len(by)]):
                who, one = active[by[lo:hi]], leaf[by[lo]]
                part = slice(cuts[one], cuts[one + 1])
                self.visited += len(who) * (part.stop - part.start)
                near = rough(self.q[who], x[part]) <= self.d[who, -1][:, None] + slack
                for at in np.flatnonzero(near.any(axis=1)).tolist():
                    k, may = int(who[at]), np.flatnonzero(near[at])
                    y = x[part][may]
                    d = distances(y, self.q[k])
                    own = (ids[part][may] == self.ids[k]) & ~lost[part][may] & (y == self.q[k]).all(axis=1)
                    self.offer(k, d[~own], ids[part][may][~own], lost[part][may][~own])

    def rows(self) -> Iterator[tuple]:
        for k, (i, name) in enumerate(zip(self.ids.tolist(), self.names)):
            for d, w, lost in zip(self.d[k].tolist(), self.who[k].tolist(), self.lost[k].tolist()):
                if d < np.inf:
                    yield i, name, None if lost else w, d


def nearest(trees: DataFrame, queries: list[tuple[int, int, list[float]]], *, top: int = TOP,
            relax: float = RELAX) -> DataFrame:
    """(query_id, name, vec_id, score): the nearest of each task for each query of a block."""
    by_dim: dict[int, tuple] = {}
    for i, name, v in queries:
        got = by_dim.setdefault(len(v), ([], [], []))
        for c, x in zip(got, (i, name, v)):
            c.append(x)
    block = {dim: (i, n, np.array(v, dtype=np.float64)) for dim, (i, n, v) in by_dim.items()}
    sent = trees.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_VALUES numbers
    schema = StructType.fromDDL("query_id long, name long, vec_id long, score double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {dim: Block(*b, top) for dim, b in sent.value.items()}
        for batch in batches:
            for t in batch.to_pylist():
                if t["dim"] not in blocks:
                    continue
                lost = np.array([i is None for i in t["ids"]], dtype=bool)
                ids = np.array([i or 0 for i in t["ids"]], dtype=np.int64)
                num = lambda c, kind="<f8": np.frombuffer(t[c], dtype=kind)
                blocks[t["dim"]].search(
                    num("x").reshape(-1, t["dim"]), ids, lost, num("vantage").reshape(-1, t["dim"]),
                    num("radius").reshape(-1, 2), num("cuts", "<i8"),
                    num("way", "<i4").reshape(len(num("cuts")) // 1 - 1, t["steps"], 2), relax)
        out = [r for b in blocks.values() for r in b.rows()]
        for lo in range(0, len(out), 8192):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=f.type) for x, f in zip(zip(*out[lo:lo + 8192]), arrow)], schema=arrow)

    return trees.mapInArrow(run, schema)


def nearest_neighbours(vectors: DataFrame, vec: str = "embedding", *, every: int = EVERY,
                       top: int = TOP, relax: float = RELAX, shard: int = SHARD, leaf: int = LEAF,
                       block_values: int = BLOCK_VALUES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest of every row whose id ``every`` divides."""
    rows = written(usable(vectors, vec), "vectors")
    trees = written(build(rows, shard, leaf), "vantage_trees")
    asked = rows.where(F.col("vec_id") % every == 0).select(
        "vec_id", F.xxhash64("v").alias("name"), "v", "dim")
    blocks = -(-(asked.agg(F.coalesce(F.sum("dim"), F.lit(0))).first()[0]) // block_values)
    mine = F.pmod(F.xxhash64(F.lit(13), "vec_id", "name"), F.lit(max(1, blocks)))
    found = None
    for k in range(max(1, blocks)):
        block = [tuple(r) for r in asked.where(mine == k).select("vec_id", "name", "v").collect()]
        got = nearest(trees, block, top=top, relax=relax)
        found = got if found is None else found.unionByName(got)
    best = Window.partitionBy("query_id", "name").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
