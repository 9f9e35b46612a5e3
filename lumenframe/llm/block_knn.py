"""Nearest neighbours by inner product as a block matrix join.

Queries and candidates are cut into blocks; each pair of blocks is one tile. Vectors are rounded to int8 with one scale
a vector, so a product of int8 tiles gives every inner product with a known error bound. Pairs whose upper bound does
not reach the k-th lower bound of the query so far are out; the rest are recomputed in double precision and merged in
a heap for each query.

Tiles run in rounds. In the first, every query meets one group of candidates; in each later one, four times as many
groups as it has met, to which it takes the k-th best score so far as its floor and which return only what reaches it.
That is about 4 k pairs a round and query, so what returns grows with the logarithm of the number of groups. Groups of
queries are as large as memory allows, as each candidate is copied once for each of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import partitions_for, place, plain, written

TILE = 1024  # candidates multiplied at a time
QUERY_BLOCK = 256


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and the L1 norms of the rounded vectors; |x - scale * q| <= scale / 2 in each place."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.abs(q.astype(np.int32)).sum(axis=1).astype(np.float64)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last in double precision."""
    out = np.zeros(a.shape[0])
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class Tiles:
    """One block of queries and the k best candidates of each so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.x, self.k = ids, x, k
        self.q, self.scale, self.norm = quantised(x)
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.least = np.full(ids.size, -np.inf) if floor is None else floor  # scores below are of no use
        self.floor = self.least.copy()

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        q, scale, norm = quantised(x)
        # int8 products are whole numbers below 2**24 up to 1040 dimensions; wider vectors are multiplied in double.
        kind = np.float32 if x.shape[1] <= 1040 else np.float64
        dot = (self.q.astype(kind) @ q.astype(kind).T).astype(np.float64)
        unit = self.scale[:, None] * scale[None, :]
        bound = unit * (0.5 * self.norm[:, None] + 0.5 * norm[None, :] + 0.25 * x.shape[1]) * (1 + 1e-9) + 1e-300
        about = dot * unit
        if ids.size > self.k:
            low = np.where(self.ids[:, None] == ids[None, :], -np.inf, about - bound)
            kth = np.partition(low, ids.size - self.k, axis=1)[:, ids.size - self.k]
            floor = np.maximum(self.floor, kth)
        else:
            floor = self.floor
        i, j = np.nonzero((about + bound >= floor[:, None]) & (self.ids[:, None] != ids[None, :]))
        for at in range(0, i.size, 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            for row, score, other in zip(a.tolist(), exact(self.x[a], x[b]).tolist(), (-ids[b]).tolist()):
                heap = self.best[row]
                if score < self.least[row]:
                    continue
                if len(heap) < self.k:
                    heapq.heappush(heap, (score, other))
                elif (score, other) > heap[0]:
                    heapq.heapreplace(heap, (score, other))
        for row in np.unique(i).tolist():
            if len(self.best[row]) == self.k:
                self.floor[row] = max(self.floor[row], self.best[row][0][0])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _join(k: int):
    """Rows (tile, part, vid, vec, floor) ordered by tile and part: the tile's queries (part 0), then its candidates."""

    def flush(tiles: Tiles):
        rows = [(int(i), -v, s) for i, heap in zip(tiles.ids.tolist(), tiles.best) for s, v in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, waiting, blocks = None, [], None
        for batch in batches:
            tiles, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edge = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(parts) != 0)) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(tiles)]):
                if tiles[s] != tile:
                    if blocks:
                        for b in blocks:
                            yield flush(b)
                    tile, waiting, blocks = tiles[s], [], None
                vec = batch.column(3).slice(s, e - s)
                dim = len(vec[0])
                ids, x = batch.column(2).slice(s, e - s).to_numpy(), _matrix(vec, dim)
                if parts[s] == 0:
                    waiting.append((ids, x, batch.column(4).slice(s, e - s).fill_null(float("-inf")).to_numpy()))
                    continue
                if blocks is None and waiting:
                    ids_q, x_q, floor = (np.concatenate(c) for c in zip(*waiting))
                    blocks = [Tiles(*(c[a : a + QUERY_BLOCK] for c in (ids_q, x_q)), k, floor[a : a + QUERY_BLOCK]) for a in range(0, ids_q.size, QUERY_BLOCK)]
                for a in range(0, ids.size, TILE):
                    for b in blocks or []:
                        b.add(ids[a : a + TILE], x[a : a + TILE])
        for b in blocks or []:
            yield flush(b)

    return run


def _merge(k: int):
    """Rows (query_id, vec_id, score) ordered by query: the k best of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def ranked(done):
            best = sorted(((s, v) for s, v in done[1]), reverse=True)
            return [(done[0], r + 1, -v, s) for r, (s, v) in enumerate(best)]

        def out(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64())],
                names=["query_id", "rank", "vec_id", "score"],
            )

        for batch in batches:
            rows = []
            for q, v, s in zip(*(c.to_pylist() for c in batch.columns)):
                if q != query:
                    if heap:
                        rows += ranked((query, heap))
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
            if rows:
                yield out(rows)
        if heap:
            yield out(ranked((query, heap)))

    return run


def block_knn(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, query_bytes: int = 16 << 20, candidate_rows: int = 1 << 16) -> DataFrame:
    """Each query's k candidates of largest inner product: query_id, rank from 1, vec_id, score; ties to the smaller id.

    Every row of `vectors` is a candidate of every query but the one with its own id, and results are exact: scores are
    inner products of the original vectors in double precision. Null, empty and zero vectors, vectors with a null or a
    non-finite component and rows without an id take no part; vectors of unlike dimensions raise an error, as do ids that
    are no whole numbers. Rows that repeat an id and vector count once; one id with two vectors has two entries. A query
    without candidates has no rows, and an empty table gives an empty result. A group of queries holds about `query_bytes`
    of vectors, one of candidates `candidate_rows`.
    """
    spark = vectors.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        vid, vec = plain(df).schema[place(df, id_col)], plain(df).schema[place(df, vec_col)]
        if vid.dataType.typeName() not in ("byte", "short", "integer", "long"):
            raise ValueError(f"{id_col} must be a whole number")
        # Single precision travels as such; products are in double precision all the same.
        kind = "array<float>" if vec.dataType.simpleString() == "array<float>" else "array<double>"
        df = plain(df).select(F.col(vid.name).cast("long").alias("vid"), F.col(vec.name).cast(kind).alias("vec")).filter("vid is not null and vec is not null and size(vec) > 0")
        fine = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
        return df.filter(fine).distinct()

    cand, query = written(sound(vectors), "vectors"), written(sound(queries), "asked")
    count = cand.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("least"), F.max(F.size("vec")).alias("most")).first()
    asked = query.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("least"), F.max(F.size("vec")).alias("most")).first()
    sizes = {v for r in (count, asked) if r["n"] for v in (r["least"], r["most"])}
    if len(sizes) > 1:
        raise ValueError("vectors differ in dimension")
    # The grid: n_q query groups by n_c candidate groups; each query row goes to n_c tiles, each candidate to n_q.
    n_q = max(1, math.ceil(asked["n"] * 8 * max(sizes, default=1) / query_bytes))
    n_c = max(16, math.ceil(count["n"] / candidate_rows))
    group = lambda n, salt: F.pmod(F.xxhash64("vid", F.lit(salt)), F.lit(n))
    cand = cand.withColumn("g", group(n_c, 2))
    tiles = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def near(asking: DataFrame, first: int, last: int) -> DataFrame:
        """Scores of the queries (vid, vec, floor) with the candidates of groups first to last."""
        rows = (
            asking.withColumn("q", group(n_q, 1)).withColumn("o", F.explode(F.sequence(F.lit(first), F.lit(last))))
            .select((F.col("q") * (n_c + 1) + F.col("o")).alias("tile"), F.lit(0).alias("part"), "vid", "vec", "floor")
            .unionByName(
                cand.filter(F.col("g").between(first, last)).withColumn("q", tiles(n_q))
                .select((F.col("q") * (n_c + 1) + F.col("g")).alias("tile"), F.lit(1).alias("part"), "vid", "vec", F.lit(None).cast("double").alias("floor"))
            )
        )
        parts = partitions_for(spark, max(1, n_q * (last - first + 1)))
        return rows.repartition(parts, "tile").sortWithinPartitions("tile", "part").mapInArrow(_join(k), "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        return (
            found.repartition(partitions_for(spark, 1 << 20), "query_id").sortWithinPartitions("query_id")
            .mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
        )

    floors = query.select("vid").distinct().withColumn("floor", F.lit(None).cast("double"))
    known, first = None, 0
    while True:
        last = min(n_c - 1, 4 * first)
        found = near(query.join(floors, "vid", "left").select("vid", "vec", "floor"), first, last)
        known = best(found if known is None else known.select("query_id", "vec_id", "score").unionByName(found))
        if last == n_c - 1:
            return known
        known = written(known, "best")
        # The floor of an id with several vectors is that of all its entries together, so it is the k-th best of them.
        floors = known.filter(F.col("rank") == k).select(F.col("query_id").alias("vid"), F.col("score").alias("floor"))
        first = last + 1
