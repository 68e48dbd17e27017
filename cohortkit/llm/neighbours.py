"""Nearest neighbours of a stated query set by a block matrix join.

Queries and candidates are dealt into blocks; each pair of a query block
and a candidate block is one task. There the vectors are quantised to int8
with a scale per vector, and the product of the two code matrices gives
every distance up to the sum of both quantisation errors. Only pairs whose
lower bound does not exceed the query's k-th smallest upper bound are
computed again from the original vectors in double precision, and kept in a
heap per query. The heaps of all candidate blocks are merged at the end.
The bounds never exclude a true neighbour, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import quoted

TILE_ROWS, TILE_COLUMNS = 512, 4096
PAIRS_AT_ONCE = 1 << 18
EXACT_FLOAT32 = 1024  # so many products of two int8 sum to less than 2**24


class Codes:
    """int8 codes of vectors, their scales and the lengths of what the codes leave out."""

    def __init__(self, vectors: np.ndarray):
        self.scale = np.abs(vectors).max(axis=1) / 127.0
        codes = np.rint(vectors / self.scale[:, None])
        self.codes = codes.astype(np.int8)
        self.error = np.sqrt(np.square(vectors - codes * self.scale[:, None]).sum(axis=1))
        self.square = np.square(codes * self.scale[:, None]).sum(axis=1)

    def __getitem__(self, at: slice) -> "Codes":
        part = object.__new__(Codes)
        for name in ("codes", "scale", "error", "square"):
            setattr(part, name, getattr(self, name)[at])
        return part


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_FLOAT32):
        x, y = a[:, i:i + EXACT_FLOAT32], b[:, i:i + EXACT_FLOAT32]
        out += x.astype(np.float32) @ y.astype(np.float32).T
    return out


def bounds(q: Codes, c: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two sets of vectors."""
    with np.errstate(all="ignore"):
        square = q.square[:, None] + c.square[None, :] \
            - 2.0 * q.scale[:, None] * c.scale[None, :] * products(q.codes, c.codes)
        middle = np.sqrt(np.maximum(square, 0.0))
        # rounding in the difference of squares, seen through the root
        off = (q.error + 1e-7 * np.sqrt(q.square))[:, None] + (c.error + 1e-7 * np.sqrt(c.square))[None, :]
        low, high = middle - off, middle + off
    return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, summed dimension by dimension."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore"):
        for j in range(a.shape[1]):
            d = a[:, j] - b[:, j]
            total += d * d
    return np.sqrt(total)


def tile_neighbours(q_ids: np.ndarray, q_vectors: np.ndarray, c_ids: np.ndarray, c_vectors: np.ndarray,
                    k: int) -> list[list[tuple[float, int]]]:
    """Each query's ``k`` nearest candidates but itself: (distance, id), nearest first."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]  # of negated pairs: the worst on top
    q_codes, c_codes = Codes(q_vectors), Codes(c_vectors)
    for a in range(0, len(q_ids), TILE_ROWS):
        rows = slice(a, a + TILE_ROWS)
        worst = np.full(len(q_ids[rows]), np.inf)
        for b in range(0, len(c_ids), TILE_COLUMNS):
            columns = slice(b, b + TILE_COLUMNS)
            low, high = bounds(q_codes[rows], c_codes[columns])
            own = q_ids[rows][:, None] == c_ids[columns][None, :]
            low[own] = high[own] = np.inf
            limit = worst
            if high.shape[1] > k:
                limit = np.minimum(worst, np.partition(high, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero((low <= limit[:, None]) & ~own)
            score = np.empty(len(i))
            for s in range(0, len(i), PAIRS_AT_ONCE):
                part = slice(s, s + PAIRS_AT_ONCE)
                score[part] = distances(q_vectors[a + i[part]], c_vectors[b + j[part]])
            ids = c_ids[b + j]
            order = np.lexsort((ids, score, i))
            i, score, ids = i[order], score[order], ids[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            for r, d, v in zip(i[best].tolist(), score[best].tolist(), ids[best].tolist()):
                heap = heaps[a + r]
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -v))
                else:
                    heapq.heappushpop(heap, (-d, -v))
            for r in np.unique(i[best]).tolist():
                if len(heaps[a + r]) == k:
                    worst[r] = -heaps[a + r][0][0]
    return [sorted((-d, -v) for d, v in heap) for heap in heaps]


def by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a table, by the vectors' length."""
    table = table.combine_chunks()
    ids = table["id"].to_numpy().astype(np.int64)
    vectors = table["vector"].combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.chunk(0) if vectors.num_chunks else pa.array([], vectors.type)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = {}
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        out[n] = ids[at], flat[ends[at][:, None] + np.arange(n)[None, :]]
    return out


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): one row per id, vectors finite and not zero."""
    rows = df.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite
                      & F.exists("vector", lambda x: x != 0))
    return good.groupBy("id").agg(F.min("vector").alias("vector"))


def nearest_neighbours(queries: DataFrame, candidates: DataFrame, *, id_col: str = "vec_id",
                       vector_col: str = "embedding", k: int = 10, query_block: int = 8192,
                       candidate_block: int = 16384) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score`` (double): each query's
    ``k`` candidates at the smallest Euclidean distance but itself, ties to the smaller id.

    Fewer than ``k`` candidates give all of them. Vectors that are NULL, zero,
    empty or hold NULL or non-finite components take no part, nor do rows
    without an id; vectors of other lengths than the query's are no candidates
    for it. Of repeated ids the row with the smallest vector counts. Other
    columns are not read. Empty tables give an empty result.

    A task holds ``query_block`` and ``candidate_block`` vectors on average;
    each query travels to every candidate block and back comes a heap of ``k``.
    """
    q, c = usable(queries, id_col, vector_col), usable(candidates, id_col, vector_col)
    rows, columns = max(1, -(-queries.count() // query_block)), max(1, -(-candidates.count() // candidate_block))

    def cell(n: int, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = q.select(cell(rows, 1).alias("r"), every(columns).alias("c"), "id", "vector")
    c = c.select(every(rows).alias("r"), cell(columns, 2).alias("c"), "id", "vector")

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, float, int]] = []
        if left.num_rows and right.num_rows:
            inside = by_length(right)
            for n, (q_ids, q_vectors) in by_length(left).items():
                if n in inside:
                    for i, best in zip(q_ids.tolist(), tile_neighbours(q_ids, q_vectors, *inside[n], k)):
                        found += [(i, d, v) for d, v in best]
        return pa.table({"query_id": pa.array([x[0] for x in found], pa.int64()),
                         "score": pa.array([x[1] for x in found], pa.float64()),
                         "vec_id": pa.array([x[2] for x in found], pa.int64())})

    parts = q.groupBy("r", "c").cogroup(c.groupBy("r", "c")).applyInArrow(
        tile, "query_id long, score double, vec_id long")

    def merge(group: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip(group["score"].to_pylist(), group["vec_id"].to_pylist()))
        return pa.table({"query_id": group["query_id"].slice(0, len(best)),
                         "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in best], pa.int64()),
                         "score": pa.array([d for d, _ in best], pa.float64())})

    return parts.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
