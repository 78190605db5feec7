"""Exact top-k inner-product search as a Voronoi kNN join.

Vectors become integers, floor(scale * x). One more coordinate, sqrt(M - |x|^2) with the largest squared norm M (zero
for queries), turns the greatest inner products into the least Euclidean distances.

1. Pivots, a bounded sample, split the data into Voronoi cells. Each cell's summary has its number of rows, the least and
   greatest distance to its pivot, and the k least ones and as many more as a query's id has rows (bounded).
2. Queries are grouped by the nearest of a few centers, pivots far from each other. From the cells' summaries each query has
   an upper bound on the distance of its k-th neighbour; a group's bound is the greatest of its queries', and its summary has the
   range of their distances to every center.
3. By the triangle inequality through each center, a row of data can be among the neighbours of a group's queries only if its
   distances to the centers are within the group's bound of those ranges. A row is replicated to just the groups for which it is.
   The number of groups is the greatest for which a row of the sample goes to REPLICAS of them on average.
4. A group's rows are dealt into blocks of at most BLOCK_BYTES or so, whatever its cells hold, and its queries, in parts of
   as many bytes, meet each block. Blocks are solved on their own and merged.

Scores are exact integers: bounds carry a slack, and only decide what is compared.

Vectors that are null or hold null or non-finite components take no part, nor do rows with a null id; shorter
vectors are read as ending in zeros. Rows with the query's id are its own; other repeated rows count each. A repeated query id is
answered once, with its first vector in order of components. Equal scores are ranked by id. An empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

MOST_PIVOTS, MOST_OWN, MOST_CENTERS = 1024, 64, 64
REPLICAS, SAMPLE = 3.0, 2048
BLOCK_BYTES = 32 << 20
LIST = pa.list_(pa.int64())


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of int64, zeros behind short ones."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): valid rows with their integer vectors."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & fine)
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * float(scale)).cast("bigint")).alias("v"))


class _Space:
    """The lifted space: pivots, and distances to them."""

    def __init__(self, pivots: np.ndarray, norm: float) -> None:
        self.pivots, self.norm = pivots.astype(float), norm
        self.high = np.sqrt(np.maximum(0.0, norm - (self.pivots**2).sum(axis=1)))

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        x = x.astype(float)
        own = (x**2).sum(axis=1)
        high = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm - own))
        square = own if query else np.full(len(x), self.norm)
        return np.sqrt(np.maximum(0.0, square[:, None] + self.norm - 2 * (x @ self.pivots.T + high[:, None] * self.high)))


@C.lean
def _assigned(batches: Iterator[pa.RecordBatch], space: _Space, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            d = space.distances(_matrix(part.column("v"), dims), False)
            cell = d.argmin(axis=1)
            yield C.batch_of({"id": part.column("id"), "v": part.column("v"), "cell": cell.astype(np.int32), "d": d[np.arange(len(d)), cell]})


@C.lean
def _summaries(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of a partition, for each cell: rows, its least distances, most at most, and the greatest."""
    seen: dict[int, list] = {}
    for batch in batches:
        cells, d = batch.column("cell").to_numpy(), batch.column("d").to_numpy()
        for c in np.unique(cells):
            x = np.sort(d[cells == c])
            n, near, far = seen.get(c, (0, np.zeros(0), 0.0))
            seen[c] = (n + len(x), np.sort(np.append(near, x[:most]))[:most], max(far, x[-1]))
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1].tolist() for x in seen.values()], pa.list_(pa.float64())), pa.array([x[2] for x in seen.values()], pa.float64())], names=["cell", "n", "near", "far"])


class _Cells:
    """Summaries of the data's cells."""

    def __init__(self, n: np.ndarray, near: list[np.ndarray], far: np.ndarray, k: int, own: int) -> None:
        self.n, self.far = n, far
        self.owners = np.repeat(np.arange(len(near)), [len(a) for a in near])
        self.near = np.concatenate(near) if near else np.zeros(0)
        self.at = k + own - 1

    def bound(self, d: np.ndarray, space: _Space) -> np.ndarray:
        """For queries at these distances to the pivots: the greatest distance that their k-th neighbour can have, their own rows
        (as many as `own` at most) apart."""
        upper = d[:, self.owners] + self.near
        bound = np.partition(upper, self.at, axis=1)[:, self.at] if upper.shape[1] > self.at else np.full(len(d), np.inf)
        return bound + 1e-6 * (np.sqrt(space.norm) + d.max(axis=1, initial=0.0)) + 1e-3


def _centers(space: _Space, most: int) -> np.ndarray:
    """Pivots, each the farthest from those before it."""
    lifted = np.column_stack([space.pivots, space.high])
    chosen, gap = [0], np.full(len(lifted), np.inf)
    while len(chosen) < min(most, len(lifted)):
        gap = np.minimum(gap, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
        if gap.max() <= 0:
            break
        chosen.append(int(gap.argmax()))
    return np.array(chosen)


class _Groups:
    """For each group of queries: how many, the greatest bound, and the least and greatest distances to each center."""

    def __init__(self, count: int) -> None:
        self.n, self.bound = np.zeros(count, np.int64), np.full(count, -np.inf)
        self.low, self.high = np.full((count, count), np.inf), np.full((count, count), -np.inf)

    def add(self, d: np.ndarray, bound: np.ndarray) -> None:
        group = d.argmin(axis=1)
        np.add.at(self.n, group, 1)
        np.maximum.at(self.bound, group, bound)
        np.minimum.at(self.low, group, d)
        np.maximum.at(self.high, group, d)

    def needs(self, d: np.ndarray, spread: float | np.ndarray = 0.0) -> np.ndarray:
        """(rows, groups): whether rows at these distances to the centers, or anything within spread of them, may be neighbours."""
        spread = np.broadcast_to(spread, len(d))[:, None]
        out = np.zeros((len(d), len(self.n)), bool)
        for g in np.flatnonzero(self.n):
            least = np.maximum(self.low[g] - d, d - self.high[g]).max(axis=1, keepdims=True) - spread
            out[:, g] = (least <= self.bound[g])[:, 0]
        return out


@C.lean
def _grouped(batches: Iterator[pa.RecordBatch], space: _Space, cells: _Cells, centers: np.ndarray, dims: int) -> Iterator[pa.RecordBatch]:
    """Of a partition's queries: a row for each group and center."""
    groups = _Groups(len(centers))
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            d = space.distances(_matrix(batch.slice(lo, 64).column("v"), dims), True)
            groups.add(d[:, centers], cells.bound(d, space))
    g, m = np.nonzero(np.broadcast_to(groups.n[:, None] > 0, groups.low.shape))
    yield C.batch_of({"g": g.astype(np.int32), "m": m.astype(np.int32), "n": groups.n[g], "bound": groups.bound[g], "low": groups.low[g, m], "high": groups.high[g, m]})


@C.lean
def _solve(batches: Iterator[pa.RecordBatch], k: int, dims: int, exact: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a task, its block of data first, then its queries."""
    now, ids, rows, data = None, [], [], None
    for batch in batches:
        tasks, kind = batch.column("task").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, (tasks[1:] != tasks[:-1]) | (kind[1:] != kind[:-1]))), len(tasks))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if tasks[lo] != now:
                now, ids, rows, data = tasks[lo], [], [], None
            part = batch.slice(lo, hi - lo)
            x, own = _matrix(part.column("v"), dims), part.column("id").to_numpy()
            x = x.astype(float) if exact else x
            if kind[lo] == 0:
                ids.append(own)
                rows.append(x)
                continue
            if not ids:  # repeated ids may leave a part of a cell empty
                continue
            if data is None:
                every = np.concatenate(ids)
                order = np.argsort(every, kind="stable")
                every, data = every[order], np.concatenate(rows)[order]
            step = max(1, (1 << 20) // len(data))
            for at in range(0, len(x), step):
                score = (x[at : at + step] @ data.T).astype(np.int64)
                q = own[at : at + step]
                others = q[:, None] != every
                floor = np.iinfo(np.int64).min
                score = np.where(others, score, floor)
                least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(q), floor)
                i, j = np.nonzero((score >= least[:, None]) & others)
                order = np.lexsort((j, -score[i, j], i))  # j: by id
                i, j = i[order], j[order]
                first = np.searchsorted(i, i)
                best = np.arange(len(i)) - first < k
                i, j = i[best], j[best]
                yield C.batch_of({"query_id": q[i], "vec_id": every[j], "score": score[i, j]})


def nearest(df: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where queries holds, the k rows with other ids and the greatest
    integer inner products, ties to smaller ids."""
    spark = df.sparkSession
    rows = _integers(df, id_col, vector_col, scale)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dims, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    n, dims, most = n or 0, max(1, dims or 0), float(most or 0.0)
    count = int(min(MOST_PIVOTS, max(1, n**0.5 / 2)))
    drawn = lambda x, m: _matrix(x.orderBy(F.xxhash64("id", "v"), "id").limit(m).select("v").toArrow().column("v").combine_chunks(), dims)
    sample = drawn(rows, count)
    space = _Space(np.unique(sample, axis=0) if len(sample) else np.zeros((1, dims), np.int64), most)
    data = C.cut(rows.mapInArrow(lambda b: _assigned(b, space, dims), "id long, v array<long>, cell int, d double"), "cells")
    asked = _integers(df.where(queries).select(*{id_col, vector_col}), id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = C.cut(asked, "queries")
    copies = data.join(asked.select("id"), "id", "left_semi").groupBy("id").count()
    own = copies.agg(F.max("count")).first()[0] or 1
    kept = k + min(own, MOST_OWN)  # shorter lists only loosen the bound
    partial = data.select("cell", "d").mapInArrow(lambda b: _summaries(b, kept), "cell int, n long, near array<double>, far double")
    found = {r.cell: r for r in partial.groupBy("cell").agg(F.sum("n").alias("n"), F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, kept).alias("near"), F.max("far").alias("far")).collect()}  # a row for each pivot
    every = range(len(space.pivots))
    cells = _Cells(np.array([found[c].n if c in found else 0 for c in every], np.int64), [np.array(found[c].near if c in found else []) for c in every], np.array([found[c].far if c in found else 0.0 for c in every]), k, own)
    centers = _chosen_centers(space, cells, drawn(asked, SAMPLE), sample if len(sample) else space.pivots)
    groups = _Groups(len(centers))
    summed = asked.mapInArrow(lambda b: _grouped(b, space, cells, centers, dims), "g int, m int, n long, bound double, low double, high double")
    for r in summed.groupBy("g", "m").agg(F.sum("n"), F.max("bound"), F.min("low"), F.max("high")).collect():  # the square of the centers
        groups.n[r[0]], groups.bound[r[0]], groups.low[r[0], r[1]], groups.high[r[0], r[1]] = r[2:]
    block = max(64, BLOCK_BYTES // (8 * dims))
    between = space.distances(space.pivots, False)[:, centers]
    rows_of = groups.needs(between, cells.far).T.astype(np.int64) @ cells.n  # of each group, at most
    blocks, parts = np.maximum(1, -(-rows_of // block)), -(-groups.n // block)
    first = np.cumsum(blocks * parts) - blocks * parts  # tasks are numbered by group, part of its queries, block of its data
    tasks = max(1, int((blocks * parts).sum()))

    @C.lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Data, to a block of each group that may need it, for each part of the group's queries."""
        seen = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x, ids = _matrix(part.column("v"), dims), part.column("id").to_numpy()
                i, g = np.nonzero(groups.needs(space.distances(x, False)[:, centers]))
                at = (C.mix(ids[i].view(np.uint64) + np.uint64(seen) + i.astype(np.uint64)) % blocks[g].astype(np.uint64)).astype(np.int64)
                again = parts[g]
                i, g, at, p = np.repeat(i, again), np.repeat(g, again), np.repeat(at, again), np.arange(again.sum()) - np.repeat(np.cumsum(again) - again, again)
                seen += part.num_rows
                yield C.batch_of({"task": first[g] + p * blocks[g] + at, "kind": np.zeros(len(i), np.int8), "id": ids[i], "v": _lists(x[i])})

    @C.lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries, to all blocks of their group."""
        for batch in batches:
            x, ids = _matrix(batch.column("v"), dims), batch.column("id").to_numpy()
            for lo in range(0, len(x), 64):
                g = space.distances(x[lo : lo + 64], True)[:, centers].argmin(axis=1)
                p = (C.mix(ids[lo : lo + 64].view(np.uint64)) % parts[g].astype(np.uint64)).astype(np.int64)
                times = blocks[g]
                i = np.repeat(np.arange(len(g)), times)
                at = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                yield C.batch_of({"task": first[g[i]] + p[i] * blocks[g[i]] + at, "kind": np.ones(len(i), np.int8), "id": ids[lo + i], "v": _lists(x[lo + i])})

    schema = "task long, kind byte, id long, v array<long>"
    both = data.select("id", "v").mapInArrow(place, schema).unionByName(asked.mapInArrow(send, schema))
    shares = min(tasks, max(C.partitions(spark), 20_000))
    dealt = both.repartitionById(shares, (F.col("task") % shares).cast("int")).sortWithinPartitions("task", "kind")
    exact = most < 2.0**52
    best = dealt.mapInArrow(lambda b: _solve(b, k, dims, exact), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _chosen_centers(space: _Space, cells: _Cells, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The most centers for which a row of the sample goes to REPLICAS groups at most; one, if none do."""
    order = _centers(space, MOST_CENTERS)
    if not len(queries):
        return order[:1]
    d = np.concatenate([space.distances(queries[lo : lo + 64], True) for lo in range(0, len(queries), 64)])
    bound = np.concatenate([cells.bound(d[lo : lo + 64], space) for lo in range(0, len(d), 64)])
    own = space.distances(rows, False)
    m = len(order)
    while m > 1:
        groups = _Groups(m)
        groups.add(d[:, order[:m]], bound)
        if len(queries) >= 4 * m and groups.needs(own[:, order[:m]]).sum() <= REPLICAS * len(rows):
            break
        m = (m + 1) // 2
    return order[:m]


def op3_voronoi_knn(spark, sf_dir: str) -> DataFrame:
    return nearest(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
