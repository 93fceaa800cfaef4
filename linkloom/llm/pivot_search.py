"""Exact search for the largest inner products, with a pivot-distance index.

Vectors are whole numbers.  With one more component, sqrt(M - |v|^2) for the largest
squared length M, all of them lie on a sphere, and the largest inner product with a query
(whose extra component is 0) is the smallest distance from it.  Each vector is keyed by
its nearest pivot and its distance from that.  A *cell* is a ring (annulus) around one
pivot.  By the triangle inequality no vector of a ring is nearer to the query than the
ring's distance bounds allow.

Pivots and rings come from a bounded sample (``SAMPLE`` vectors by hash of their id); every
vector is in the index.  A query first looks into the rings with the best bounds, as many
as hold enough vectors, then into all others whose bound still beats its k-th best.  So
results are exact.  Queries go to rings in blocks, and rings are stored in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.scratch import written

SAMPLE = 4096
PIVOTS = 32
RINGS = 8
BLOCK = 512
#: Inner products below this are exact in floating point.
_EXACT = 2.0**53
_LONG = (1 << 63) - 1


def whole_vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: each component as floor(256 * x), from files.

    Rows without an id, and vectors that are NULL or have a component that is NULL or not
    finite, take no part.  Components beyond the range of a long count as its ends.
    """
    x = F.col(f"`{embedding}`")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.where(F.col(f"`{vec_id}`").isNotNull() & x.isNotNull() & finite)
    whole = F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))
    return written(rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("v")), "vectors")


class PivotIndex:
    """What routes vectors and queries: of fixed size, however many vectors there are."""

    def __init__(self, sample: list[list[int]], most: float, width: int, largest: float):
        self.most, self.width, self.largest = most, width, largest
        points = self._lifted(self.matrix(sample)) if sample else np.zeros((1, width + 1))
        chosen = [0]
        nearest = self._distances(points, points[:1])[:, 0]
        while len(chosen) < PIVOTS and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self._distances(points, points[chosen[-1:]])[:, 0])
        self.pivots = points[chosen]
        distances = self._distances(points, self.pivots)
        owner = distances.argmin(1)
        #: Upper ends of all but the last ring of each pivot.
        self.ends = np.zeros((len(chosen), RINGS - 1))
        for p in range(len(chosen)):
            own = distances[owner == p, p]
            if len(own):
                self.ends[p] = np.quantile(own, np.arange(1, RINGS) / RINGS)
        #: Distances are trusted up to this.
        self.slack = 1e-6 * (1.0 + np.sqrt(most))

    def matrix(self, vectors: list[list[int]]) -> np.ndarray:
        """Rows of equal width; a shorter vector counts as filled up with zeros."""
        found = np.zeros((len(vectors), self.width), np.int64)
        for i, v in enumerate(vectors):
            found[i, : len(v)] = v
        return found

    def _lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(float)
        return np.concatenate([x, np.sqrt(np.maximum(self.most - (x * x).sum(1), 0))[:, None]], 1)

    @staticmethod
    def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([np.sqrt(((a - y) ** 2).sum(1)) for y in b], 1)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector, and its distance from the pivot."""
        distances = self._distances(self._lifted(vectors), self.pivots)
        pivot = distances.argmin(1)
        distance = distances[np.arange(len(pivot)), pivot]
        ring = (distance[:, None] > self.ends[pivot]).sum(1)
        return pivot * RINGS + ring, distance

    def from_pivots(self, queries: np.ndarray) -> np.ndarray:
        x = queries.astype(float)
        return self._distances(np.concatenate([x, np.zeros((len(x), 1))], 1), self.pivots)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and cell the largest inner product that a vector there can have."""
        zero, ever = np.zeros((len(self.pivots), 1)), np.full((len(self.pivots), 1), np.inf)
        low, high = np.concatenate([zero, self.ends], 1), np.concatenate([self.ends, ever], 1)
        d = self.from_pivots(queries)[:, :, None]
        return self.best_product(queries, np.maximum(d - high, low - d)).reshape(len(queries), -1)

    def best_product(self, queries: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The largest inner product at no less than this distance."""
        x = queries.astype(float)
        square = (x * x).sum(1).reshape((-1,) + (1,) * (distance.ndim - 1))
        near = np.maximum(distance - self.slack, 0)
        return (square + self.most - near * near) / 2 * (1 + 1e-9) + self.slack

    def products(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        if self.largest * self.largest * max(1, self.width) < _EXACT:
            return np.rint(queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
        exact = queries.astype(object) @ vectors.astype(object).T
        return np.clip(exact, -_LONG - 1, _LONG).astype(np.int64)


def fit(vectors: DataFrame) -> PivotIndex:
    """Pivots and rings from a sample, and the largest length from all vectors."""
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = vectors.select(length.alias("n"), F.size("v").alias("w"), F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))).alias("m"))
    all_rows = size.agg(F.max("n"), F.max("w"), F.max("m")).first()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    return PivotIndex([r["v"] for r in sample], all_rows[0] or 0.0, all_rows[1] or 0, all_rows[2] or 0.0)


def build(vectors: DataFrame, index: PivotIndex) -> DataFrame:
    """``cell, low, high, ids, rows``: blocks of vectors of one cell, ordered by distance.

    Blocks come from a shuffle by cell, distance and id, so a cell with many vectors is
    spread over tasks.  Rows that are the same in id and vector count once.
    """
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = index.matrix(batch.column("v").to_pylist())
            cell, distance = index.cells(matrix)
            raw = [x.tobytes() for x in matrix]
            columns = [pa.array(cell.astype(np.int32)), pa.array(distance), batch.column("vec_id"), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "distance", "vec_id", "v"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []

        def block() -> pa.RecordBatch:
            ids, raw = [r[1] for r in rows], b"".join(r[2] for r in rows)
            values = [[cell], [rows[0][0]], [rows[-1][0]], [ids], [raw]]
            kinds = [pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["cell", "low", "high", "ids", "rows"]
            )

        for batch in batches:
            for c, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if rows and row == rows[-1] and c == cell:
                    continue
                if rows and (c != cell or len(rows) == BLOCK):
                    yield block()
                    rows = []
                cell = c
                rows.append(row)
        if rows:
            yield block()

    keys = ["cell", "distance", "vec_id", "v"]
    placed = vectors.mapInArrow(place, "cell int, distance double, vec_id long, v binary")
    placed = placed.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    return written(placed.mapInArrow(pack, "cell int, low double, high double, ids array<long>, rows binary"), "index")


def _floor(least: np.ndarray) -> np.ndarray:
    """What an inner product must reach; the least long stands for any."""
    return np.where(least == -_LONG - 1, -np.inf, least.astype(float))


def _routed(queries: DataFrame, index: PivotIndex, counts: np.ndarray, k: int, first: bool) -> DataFrame:
    """Blocks of queries for each cell that they have to look into.

    ``first``: the best cells that hold more than ``k`` vectors; else all others that can
    still hold one as good as ``least``, the query's k-th best so far.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                matrix = index.matrix(part.column("v").to_pylist())
                bounds = index.bounds(matrix)
                order = np.argsort(-bounds, 1, kind="stable")
                held = np.cumsum(counts[order], 1)
                early = held - counts[order] <= k
                want = np.zeros(bounds.shape, bool)
                np.put_along_axis(want, order, early, 1)
                ids, least = part.column("vec_id").to_numpy(), np.full(part.num_rows, -_LONG - 1)
                if not first:
                    least = part.column("least").fill_null(-_LONG - 1).to_numpy()
                    want = ~want & (bounds >= _floor(least)[:, None])
                want &= counts > 0
                for cell in np.flatnonzero(want.any(0)).tolist():
                    own = want[:, cell]
                    values = [[cell], [ids[own].tolist()], [least[own].tolist()], [matrix[own].tobytes()]]
                    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(values, kinds, strict=True)], ["cell", "query_ids", "least", "queries"]
                    )

    return queries.mapInArrow(route, "cell int, query_ids array<long>, least array<long>, queries binary")


def _compared(routed: DataFrame, blocks: DataFrame, index: PivotIndex, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of each block for each query that looks into it."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1).to_pylist()[0]
                queries = np.frombuffer(part["queries"], np.int64).reshape(len(part["query_ids"]), index.width)
                query_ids, least = np.array(part["query_ids"]), np.array(part["least"])
                from_pivot = index.from_pivots(queries)[:, part["cell"] // RINGS]
                gap = np.maximum(from_pivot - part["high"], part["low"] - from_pivot)
                near = index.best_product(queries, gap) >= _floor(least)
                if not near.any():
                    continue
                queries, query_ids, least = queries[near], query_ids[near], least[near]
                ids = np.array(part["ids"])
                vectors = np.frombuffer(part["rows"], np.int64).reshape(len(ids), index.width)
                by_id = np.argsort(ids, kind="stable")
                ids = ids[by_id]
                scores = index.products(queries, vectors[by_id])
                own = query_ids[:, None] == ids
                best = np.argsort(np.where(own, np.inf, -scores.astype(float)), 1, kind="stable")
                if np.abs(scores).max() >= _EXACT:  # floats would tie what differs
                    best = np.lexsort((np.broadcast_to(np.arange(len(ids)), scores.shape), ~scores, own), axis=1)
                best = best[:, :k]
                score = np.take_along_axis(scores, best, 1)
                kept = ~np.take_along_axis(own, best, 1) & (score >= least[:, None])
                who = np.broadcast_to(query_ids[:, None], best.shape)
                columns = [pa.array(who[kept]), pa.array(ids[best][kept]), pa.array(score[kept])]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    pairs = routed.join(blocks, "cell")
    return pairs.mapInArrow(compare, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query.

    Both are from ``whole_vectors``.  Ties go to the smaller ``vec_id``; rows with the
    query's own id are not candidates.  Rows that repeat a candidate's id with another
    vector are candidates of their own; of such queries the smallest vector asks.  With
    fewer than ``k`` candidates a query gets all of them.  Scores beyond a long's range
    count as its ends.
    """
    index = fit(vectors)
    blocks = build(vectors, index)
    counts = np.zeros(len(index.pivots) * RINGS, np.int64)
    for r in blocks.groupBy("cell").agg(F.sum(F.size("ids")).alias("n")).collect():  # a row for each cell
        counts[r["cell"]] = r["n"]
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    first = written(_best(_compared(_routed(asked, index, counts, k, True), blocks, index, k), k), "first-best")
    least = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    least = least.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") == k, F.col("least")).alias("least"))
    again = _routed(asked.join(least, "vec_id", "left"), index, counts, k, False)
    rest = _compared(again, blocks, index, k)
    found = first.select("query_id", "vec_id", "score").union(rest.select("query_id", "vec_id", "score"))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
