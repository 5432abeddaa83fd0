"""Nearest neighbours by collision counting with query-aware windows.

Vectors are turned by random orthonormal bases; each coordinate is one projection and has an array of
its own, sorted. A query looks at a window around its own coordinate in every array, and a
vector collides as often as it lies in a window. Vectors above a collision threshold are verified by the exact
measure. While too few are above it, the windows are widened (virtual rehashing: the arrays stay as they are, only
the new rims of the windows are read).

Largest inner products become smallest distances by one more coordinate, ``sqrt(longest**2 - |v|**2)``, for the
vectors, and 0 for the queries, which are scaled to the same length.

The rows are spread at random over blocks of bounded size, each with arrays of its own, and every query visits
every block in groups of queries; a block returns as many rows per query as are wanted, and the best of
all blocks stay. Recall was measured against brute force (README); the share of a block that must be
above the threshold sets it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.staging import staged

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
FIRST_WINDOW = 1.0  # half width, in units of the root mean square of a coordinate
WIDER = 1.15
THRESHOLD = 0.7  # collisions, as a share of the projections
VERIFIED = 0.12  # share of a block's vectors above the threshold at which the windows stop growing


def usable(vector: Column) -> Column:
    """A vector that is there, has no null or non-finite component, and is not zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _bases(dimension: int, projections: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    turns = [np.linalg.qr(draw.standard_normal((dimension, dimension)))[0] for _ in range(-(-projections // dimension))]
    return np.concatenate(turns, axis=1)[:, :projections]


class CollisionIndex:
    """Sorted projections of one block of vectors (ids ascending, equal vectors once with their first ids)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, copies: int, seed: int = 1):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        raw = (vectors + 0.0).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
        _, one, which = np.unique(raw, return_index=True, return_inverse=True)
        by_vector = np.argsort(which, kind="stable")
        starts = np.searchsorted(which[by_vector], np.arange(len(one)))
        self.ids = [ids[by_vector[b : min(e, b + copies)]] for b, e in zip(starts, np.append(starts[1:], len(ids)), strict=True)]
        self.vectors, self.longest = vectors[one], longest
        squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        lifted = np.column_stack([self.vectors, np.sqrt(np.maximum(longest**2 - squares, 0))])
        self._basis = _bases(lifted.shape[1], lifted.shape[1], seed)
        turned = lifted @ self._basis
        # All sorted arrays one after the other, each moved up beyond the one before, so that one search serves all.
        self._reach = 4 * longest + 1
        self._shift = np.arange(turned.shape[1]) * 2 * self._reach
        self._order = np.argsort(turned, axis=0, kind="stable").T.ravel()
        self._sorted = (np.sort(turned, axis=0) + self._shift).T.ravel()
        self._unit = longest / np.sqrt(lifted.shape[1])

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Numbers of the vectors above the threshold when there are enough of them (all, if the windows span everything)."""
        n, m = len(self.vectors), len(self._shift)
        enough = min(n, wanted + int(np.ceil(VERIFIED * n)))
        at = np.append(query * (self.longest / np.linalg.norm(query)), 0.0) @ self._basis
        counts = np.zeros(n, np.int64)
        low = high = None
        width = FIRST_WINDOW * self._unit
        while True:
            reach = min(width, self._reach)
            new_low = np.searchsorted(self._sorted, at + self._shift - reach)
            new_high = np.searchsorted(self._sorted, at + self._shift + reach, side="right")
            bounds = [(new_low, new_high)] if low is None else [(new_low, low), (high, new_high)]
            rims = [self._order[b:e] for begin, end in bounds for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
            counts += np.bincount(np.concatenate(rims), minlength=n)
            low, high = new_low, new_high
            found = np.flatnonzero(counts >= THRESHOLD * m)
            if len(found) >= enough or width >= self._reach:
                return found
            width *= WIDER

    def nearest(self, query_id: int, query: np.ndarray, wanted: int) -> tuple[list[int], list[float]]:
        """Ids and inner products of the best verified rows but the query's own; ties to smaller ids."""
        found = self.candidates(query, wanted + 1)
        # a sum along each row is the same wherever the row stands
        scores = (self.vectors[found] * query).sum(axis=1)
        if len(found) > wanted + 1:
            least = np.partition(scores, len(scores) - wanted - 1)[len(scores) - wanted - 1]
            found, scores = found[scores >= least], scores[scores >= least]
        pairs = [(-s, i) for f, s in zip(found.tolist(), scores.tolist(), strict=True) for i in self.ids[f].tolist() if i != query_id]
        pairs = sorted(pairs)[:wanted]
        return [i for _, i in pairs], [-s for s, _ in pairs]


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    wanted: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For each row where ``queries`` is true its ``wanted`` nearest of all other rows: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score`` (inner product in double precision), nearest first, ties to smaller ids.

    Rows without an id, and vectors that are null, zero, or hold null or non-finite components, take no part. Rows that repeat an id
    count as that id's own and each can be found. With fewer candidates than wanted all are returned. Only vectors of the
    commonest length (of equally common ones the longest) take part. An empty table gives no rows; other columns are not read.
    """
    usable_rows = staged(
        df.select(
            F.col(f"`{id_column}`").cast("bigint").alias("id"),
            F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
        )
        .filter(F.col("id").isNotNull() & usable(F.col("vector")))
        .withColumn("square", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)),
        "vectors",
    )
    lengths = usable_rows.groupBy(F.size("vector").alias("length")).count()
    most = lengths.agg(F.max(F.struct("count", "length"))["length"].alias("length")).first()["length"]
    rows = usable_rows.filter(F.size("vector") == F.lit(most))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"), F.max("square").alias("square")).first()
    blocks = max(1, -(-size["n"] // block_rows))
    groups = max(1, -(-size["q"] // query_rows))
    longest = float(np.sqrt(size["square"] or 1.0))

    spread = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    indexed = rows.select(spread.alias("block"), every(groups).alias("group"), "id", "vector")
    asking = rows.filter("asks").select(
        every(blocks).alias("block"), F.pmod(F.xxhash64("id", F.lit(8)), F.lit(groups)).cast("int").alias("group"), "id", "vector"
    )

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = table["vector"].combine_chunks().flatten().to_numpy()
        return table["id"].to_numpy(), flat.reshape(table.num_rows, -1)

    schema = "query_id long, vec_id long, score double"
    arrow = pa.schema({"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()})

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if block.num_rows and asked.num_rows:
            index = CollisionIndex(*matrix(block), longest, wanted + 1)
            for query_id, query in zip(*matrix(asked), strict=True):
                ids, scores = index.nearest(int(query_id), query, wanted)
                out["query_id"] += [int(query_id)] * len(ids)
                out["vec_id"] += ids
                out["score"] += scores
        return pa.table(out, schema=arrow)

    keys = ["block", "group"]
    found = indexed.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")
