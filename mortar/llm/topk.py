"""Exact top-k search by inner product with a pivot-distance index.

Vectors are lifted by one coordinate so that all have the same length: an inner product is
then a falling function of a distance, and the triangle inequality bounds it. The index keys
every vector by its nearest pivot and its distance from it; a search walks the vectors of a
pivot outwards from the query's own distance, annulus by annulus, and stops where the bound
shows that no better score can follow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_scratch

PIVOTS = 16
#: Consecutive vectors of a pivot that are stored as a row, and searched as a unit.
SLAB = 8_192
ANNULUS = 512
#: Queries that are searched together.
QUERY_BLOCK = 256
#: Copies of a block that leave a task in one Arrow batch.
CELLS_AT_ONCE = 64
#: Room for rounding in bounds, as a part of the squared length; scores themselves are exact.
SLACK = 1e-9


def scaled(vector: Column) -> Column:
    """floor(256 x) of every component, or null if the vector or a component is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(wide, lambda x: F.floor(x * 256)))


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """A matrix of the vectors; shorter ones are filled up with zeros, which leaves scores alone."""
    out = np.zeros((len(column), dim), dtype=np.int64)
    for i, v in enumerate(column.to_numpy(zero_copy_only=False)):
        out[i, : len(v)] = v
    return out


def distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every lifted row to every lifted pivot (their last coordinate is the lift)."""
    squared = (x * x).sum(axis=1) + lift**2
    cross = x @ pivots[:, :-1].T + lift[:, None] * pivots[:, -1]
    return np.sqrt(np.maximum(squared[:, None] - 2 * cross + (pivots * pivots).sum(axis=1), 0.0))


class Best:
    """The k best (score, id) of each query of a block: higher scores first, ties to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor  # floor: a score that k rows are known to reach
        self.scores = [np.zeros(0, dtype=np.int64)] * n
        self.ids = [np.zeros(0, dtype=np.int64)] * n

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor[i]
        scores, ids = np.concatenate([self.scores[i], scores[keep]]), np.concatenate([self.ids[i], ids[keep]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[i], self.ids[i] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[i] = max(self.floor[i], scores[order[-1]])


def build_index(vectors: DataFrame, id_col: str, vector_col: str, n_pivots: int, slab: int) -> tuple[DataFrame, np.ndarray, int, int] | None:
    """Slabs of the index, pivots, dimension and largest squared length; None without usable vectors.

    The pivots are a sample of ``n_pivots`` vectors (smallest hash of the id). Every vector is
    indexed: range-partitioned by (pivot, distance, id), so equal vectors spread as well.
    """
    usable = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), scaled(F.col(f"`{vector_col}`")).alias("v")).where("id is not null and v is not null")
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    top = usable.agg(F.max(norm).alias("longest"), F.max(F.size("v")).alias("dim")).first()
    if top["longest"] is None:
        return None
    longest, dim = int(top["longest"]), int(top["dim"])
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    pivots = np.zeros((len(sample), dim + 1))
    for i, r in enumerate(sample):
        pivots[i, : len(r["v"])] = r["v"]
    pivots[:, -1] = np.sqrt(np.maximum(longest - (pivots[:, :-1] ** 2).sum(axis=1), 0))
    kind = kind_of(longest)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch.column("v"), dim)
            d = distances(x, np.sqrt((longest - (x * x).sum(axis=1)).astype(float)), pivots)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())],
                names=["id", "pivot", "d", "x"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held = TaskContext.get().partitionId(), 0, []

        def close() -> pa.RecordBatch:
            nonlocal n
            rows = pa.Table.from_batches(held)
            d = rows["d"].to_numpy()
            n += 1  # slabs of a task follow each other in distance
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + n]), pa.array([rows["pivot"][0].as_py()], pa.int32()), pa.array([d[0]]), pa.array([d[-1]]),
                    pa.array([rows["id"].to_numpy().tobytes()], pa.binary()), pa.array([d.tobytes()], pa.binary()), pa.array([b"".join(rows["x"].to_pylist())], pa.binary()),
                ],
                names=["slab", "pivot", "d_min", "d_max", "ids", "ds", "xs"],
            )

        for batch in batches:
            pivot = batch.column("pivot").to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
            for a, b in zip(borders, borders[1:]):
                while a < b:
                    if held and (held[0].column("pivot")[0].as_py() != pivot[a] or sum(map(len, held)) >= slab):
                        yield close()
                        held = []
                    take = min(b - a, slab - sum(map(len, held)))
                    held.append(batch.slice(a, take))
                    a += take
        if held:
            yield close()

    order = ["pivot", "d", "id"]
    rows = usable.mapInArrow(keyed, "id long, pivot int, d double, x binary")
    slabs = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, "slab long, pivot int, d_min double, d_max double, ids binary, ds binary, xs binary")
    return write_scratch(slabs, "slabs"), pivots, dim, longest


def cells_of(slabs: DataFrame) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Slabs with the ``cell`` that each belongs to, and the list of all cells.

    A cell is a run of neighbouring slabs of one pivot, written by one task of the index: a
    ball shell of vectors. There are about as many as the square root of the number of vectors
    (or as the slabs, if these are fewer), beside one for each pivot and partition of the
    index, so tasks of a search grow in number with the table. The list holds the cells' places, pivots
    and least and largest distances; its size is bounded by that root (10 MB for 10^11
    vectors), so it is read to the driver and shipped to the tasks.
    """
    n = slabs.agg(F.count(F.lit(1)).alias("slabs"), F.sum(F.octet_length("ids") / 8).alias("rows")).first()
    run = max(1, math.ceil(n["slabs"] / max(1.0, math.sqrt(n["rows"] or 0))))
    place = F.struct("pivot", F.shiftright("slab", 32).alias("part"), F.floor(F.col("slab").bitwiseAND(F.lit((1 << 32) - 1)) / run).alias("run"))
    placed = slabs.withColumn("cell", F.xxhash64(place))
    # a shared hash would only make one wider cell of two: pivot is part of the grouping
    found = placed.groupBy("cell", "pivot").agg(F.min("d_min").alias("d_min"), F.max("d_max").alias("d_max")).toArrow()
    return placed, {c: found[c].to_numpy() for c in found.column_names}


def search(slabs: DataFrame, pivots: np.ndarray, dim: int, longest: int, k: int, every: int, query_block: int) -> DataFrame:
    """The ``k`` best of each vector whose id is divisible by ``every``, among all others.

    First each query is scored against the slab it lies in itself: its k-th score there is a
    floor. Blocks of queries then go to the cells that can hold a score of at least the
    floor, and to no others, meet the slabs there, and walk their annuli. What is left of
    each pair, at most ``k`` rows a query, is merged.
    """
    placed, cells = cells_of(slabs)
    pairs = pairs_of(blocks_of(slabs, cells, pivots, dim, longest, k, every, query_block), placed)
    # one pair at a time: a row holds a slab
    found = pairs.select("ids", "ds", "xs", "q_ids", "q_xs", "floors", "q_ds").mapInArrow(walker(dim, longest, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pairs_of(blocks: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks of queries with each slab that they can reach in the cells they were sent to."""
    near = (F.col("q_min") <= F.col("d_max")) & (F.col("q_max") >= F.col("d_min"))
    return blocks.join(placed, ["cell", "pivot"]).where(near)


def kind_of(longest: int) -> str:
    """How components are stored: each is at most the root of the longest squared length."""
    return "<i2" if longest < 1 << 30 else "<i8"


def slack_of(longest: int) -> float:
    return SLACK * max(1, longest)


def matrix(data: bytes, dim: int, longest: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind_of(longest)).reshape(-1, dim)


def score(q: np.ndarray, x: np.ndarray, longest: int) -> np.ndarray:
    """Inner products; whole numbers below 2^53 are exact as doubles, whose product is fast."""
    return np.rint(q.astype(float) @ x.astype(float).T).astype(np.int64) if longest < 1 << 52 else q.astype(np.int64) @ x.astype(np.int64).T


def blocks_of(slabs: DataFrame, cells: dict[str, np.ndarray], pivots: np.ndarray, dim: int, longest: int, k: int, every: int, query_block: int) -> DataFrame:
    """A row for each block of queries and each cell that it can reach.

    A block holds neighbouring queries of one slab with their floors. ``q_min`` and ``q_max``
    are the distances from the cell's pivot between which anything that reaches a floor lies.
    """

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                r = batch.slice(i, 1).to_pylist()[0]
                ids, x = np.frombuffer(r["ids"], dtype=np.int64), matrix(r["xs"], dim, longest)
                mine = np.flatnonzero(ids % every == 0)
                for a in range(0, len(mine), query_block):
                    at = mine[a : a + query_block]
                    found = score(x[at], x, longest)
                    floors = np.full(len(at), np.iinfo(np.int64).min)
                    for q in range(len(at)):
                        others = found[q][ids != ids[at[q]]]
                        if len(others) >= k:
                            floors[q] = np.partition(others, len(others) - k)[len(others) - k]
                    d = distances(x[at].astype(np.int64), np.zeros(len(at)), pivots)
                    squared = (x[at].astype(np.int64) ** 2).sum(axis=1)
                    # d(query, x)^2 = |query|^2 + longest - 2 score: no farther than this
                    reach = np.sqrt(np.maximum(np.where(floors == np.iinfo(np.int64).min, np.inf, squared + longest - 2.0 * floors + slack_of(longest)), 0))
                    least, most = (d - reach[:, None]).min(axis=0), (d + reach[:, None]).max(axis=0)
                    to = np.flatnonzero((least[cells["pivot"]] <= cells["d_max"]) & (most[cells["pivot"]] >= cells["d_min"]))
                    for b in range(0, len(to), CELLS_AT_ONCE):
                        cell = to[b : b + CELLS_AT_ONCE]
                        pivot, m = cells["pivot"][cell], len(cell)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(cells["cell"][cell]), pa.array(pivot), pa.array(least[pivot]), pa.array(most[pivot]),
                                pa.array([ids[at].tobytes()] * m, pa.binary()), pa.array([x[at].tobytes()] * m, pa.binary()), pa.array([floors.tobytes()] * m, pa.binary()),
                                pa.array([d[:, j].tobytes() for j in pivot], pa.binary()),
                            ],
                            names=["cell", "pivot", "q_min", "q_max", "q_ids", "q_xs", "floors", "q_ds"],
                        )

    return slabs.select("ids", "xs").mapInArrow(start, "cell long, pivot int, q_min double, q_max double, q_ids binary, q_xs binary, floors binary, q_ds binary")


def walker(dim: int, longest: int, k: int):
    """The task function that walks a slab's annuli for a block of queries, nearest first."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                r = batch.slice(i, 1).to_pylist()[0]
                ids, x = np.frombuffer(r["ids"], dtype=np.int64), matrix(r["xs"], dim, longest)
                ds = np.frombuffer(r["ds"])
                q_ids, q = np.frombuffer(r["q_ids"], dtype=np.int64), matrix(r["q_xs"], dim, longest)
                q_ds, squared = np.frombuffer(r["q_ds"]), (q.astype(np.int64) ** 2).sum(axis=1)
                best = Best(len(q), k, np.frombuffer(r["floors"], dtype=np.int64).copy())
                begins = np.arange(0, len(ids), ANNULUS)
                near, far = ds[begins], ds[np.minimum(begins + ANNULUS, len(ids)) - 1]
                # the triangle inequality: nothing in an annulus is nearer to the query than this
                bound = np.maximum(0, np.maximum(q_ds[:, None] - far, near - q_ds[:, None]))
                most = (squared[:, None] + longest - bound**2 + slack_of(longest)) / 2
                for j in np.argsort(bound.min(axis=0), kind="stable"):
                    left = np.flatnonzero(most[:, j] >= best.floor)
                    if not len(left):
                        if (most.max(axis=1) < best.floor).all():
                            break
                        continue
                    ring = slice(begins[j], begins[j] + ANNULUS)
                    for i_q, row in zip(left, score(q[left], x[ring], longest)):
                        other = ids[ring] != q_ids[i_q]
                        best.add(i_q, row[other], ids[ring][other])
                n = [len(x) for x in best.ids]
                if sum(n):
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, n)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.scores))], names=["query_id", "vec_id", "score"])

    return walk


def top_k(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    every: int = 50,
    n_pivots: int = PIVOTS,
    slab: int = SLAB,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact top ``k`` by integer inner product: (query_id, rank, vec_id, score).

    Components become floor(256 x). Queries are the rows whose id is divisible by ``every``;
    every row with another id is a candidate; ties go to the smaller id, and a query has
    fewer rows if there are fewer candidates. Defined results: vectors that are null, or hold
    a null or a component that is not finite, take no part, nor do rows with a null id;
    vectors of different lengths are compared as if filled up with zeros; rows that repeat a
    query id are one query for each distinct row, whose answers are merged; an empty table
    gives an empty result; other columns are left alone. Scores must fit a long.
    """
    spark = vectors.sparkSession
    index = build_index(vectors, id_col, vector_col, n_pivots, slab)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return search(*index, k, every, query_block)
