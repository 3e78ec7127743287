"""Nearest neighbours by blocked int8 matrix products with error bounds.

Queries go out in blocks of bounded size; each task multiplies tiles of its
candidates with a block.  Both sides are unit vectors rounded to int8 with one
scale each, so a product of tiles gives all cosines up to a bound that follows
from the two rounding errors.  Pairs whose upper bound reaches the k-th best
lower bound are computed again in double precision, and heaps keep the k best.
The result is exact: only pairs that cannot be among the k best are left out.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows with a null id.  Vectors are compared with vectors of the
same length.  Equal scores rank by the smaller id.  An id that occurs in several
rows is several candidates.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import table

K = 5
#: bytes of one block of queries (float64 and int8 images), the bound of each broadcast
BLOCK_BYTES = 64 << 20
#: candidates and queries of one product tile
TILE, QUERY_TILE = 2048, 1024


class Block:
    """Vectors of one length: ids, originals, norms and their int8 image."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        unit = vectors / self.norms[:, None]
        scale = np.abs(unit).max(axis=1) / 127.0
        codes = np.rint(unit / scale[:, None])
        self.error = np.sqrt(np.einsum("ij,ij->i", e := unit - codes * scale[:, None], e))
        self.scale, self.codes = scale, codes.astype(np.int8)

    def take(self, which) -> Block:
        part = object.__new__(Block)
        for name in ("ids", "vectors", "norms", "error", "scale", "codes"):
            setattr(part, name, getattr(self, name)[which])
        return part


def blocks(ids: pa.Array, vectors: pa.Array) -> dict[int, Block]:
    """The vectors that take part, by length."""
    values = vectors.flatten() if hasattr(vectors, "flatten") else vectors.values
    flat = np.asarray(values.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    sizes = np.array([0 if n is None else n for n in pc.list_value_length(vectors).to_pylist()], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    known = np.asarray(ids.is_valid())
    out = {}
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero((sizes == size) & known)
        matrix = flat[begin[rows][:, None] + np.arange(size)]
        with np.errstate(over="ignore", invalid="ignore"):
            square = np.einsum("ij,ij->i", matrix, matrix)
        fine = np.isfinite(matrix).all(axis=1) & (square > 0) & np.isfinite(square)
        if fine.any():
            row_ids = np.array([ids[int(r)].as_py() for r in rows[fine]], dtype=np.int64)
            out[size] = Block(row_ids, matrix[fine])
    return out


def _product(queries: Block, candidates: Block) -> tuple[np.ndarray, np.ndarray]:
    """All cosines from the int8 images, and the bounds of their errors."""
    exact = np.float32 if queries.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64  # whole numbers stay exact
    near = (queries.codes.astype(exact) @ candidates.codes.astype(exact).T).astype(np.float64)
    near *= queries.scale[:, None] * candidates.scale[None, :]
    bound = candidates.error[None, :] + queries.error[:, None] * (1 + candidates.error[None, :]) + 1e-9
    return near, bound


def _smallest_copies(block: Block, k: int) -> Block:
    """Without those copies of one vector that k smaller ids and a query's own row always precede."""
    _, group = np.unique(block.vectors, axis=0, return_inverse=True)
    group = group.reshape(-1)
    order = np.lexsort((block.ids, group))
    sorted_group = group[order]
    first = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    # equal ids may fill all places before, so copies of one id count once
    return block.take(np.sort(order[rank < k + 1])) if len(set(block.ids.tolist())) == len(block.ids) else block


class Nearest:
    """The k best candidates of each query so far, in heaps of (score, -id)."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.least = np.full(len(queries.ids), -np.inf)  # the k-th best score of each query

    def add(self, tile: Block) -> None:
        tile = _smallest_copies(tile, self.k)
        for at in range(0, len(self.queries.ids), QUERY_TILE):
            self._add(at, self.queries.take(slice(at, at + QUERY_TILE)), tile)

    def _add(self, at: int, queries: Block, tile: Block) -> None:
        near, bound = _product(queries, tile)
        own = queries.ids[:, None] == tile.ids[None, :]
        low = np.where(own, -np.inf, near - bound)
        least = self.least[at:at + len(queries.ids)]
        if low.shape[1] >= self.k:
            least = np.maximum(least, np.partition(low, -self.k, axis=1)[:, -self.k])
        q, c = np.nonzero((near + bound >= least[:, None]) & ~own)
        score = np.empty(len(q))
        for i in range(0, len(q), 65536):
            s = slice(i, i + 65536)
            score[s] = np.einsum("ij,ij->i", queries.vectors[q[s]], tile.vectors[c[s]]) / (queries.norms[q[s]] * tile.norms[c[s]])
        order = np.lexsort((tile.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, int)
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        for row, value, vec in zip(q[rank < self.k].tolist(), score[rank < self.k].tolist(), tile.ids[c[rank < self.k]].tolist()):
            heap = self.heaps[at + row]
            if len(heap) < self.k:
                heapq.heappush(heap, (value, -vec))
            elif (value, -vec) > heap[0]:
                heapq.heapreplace(heap, (value, -vec))
            if len(heap) == self.k:
                self.least[at + row] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int, float]]:
        for query, heap in zip(self.queries.ids.tolist(), self.heaps):
            for score, vec in heap:
                yield query, -vec, score


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest rows of ``vectors`` (largest cosine) of every row of ``queries``.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``.  The queries
    are dealt into as many blocks as keep each below ``block_bytes``; a block is
    one pass over ``vectors``.
    """
    spark = vectors.sparkSession
    queries = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL AND size(vector) > 0")
    vectors = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    size = queries.agg(F.sum(F.size("vector").cast("long") * 18 + 64)).first()[0] or 0
    parts = -(-size * 5 // 4 // block_bytes) if size > block_bytes else 1  # a quarter more for uneven hashing

    found = None
    for part in range(parts):
        chosen = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part) if parts > 1 else queries
        block = spark.sparkContext.broadcast(blocks_of(chosen))

        def nearest(batches: Iterator[pa.RecordBatch], block=block, k=k) -> Iterator[pa.RecordBatch]:
            best = {size: Nearest(b, k) for size, b in block.value.items()}
            for batch in batches:
                for length, candidates in blocks(batch.column(0), batch.column(1)).items():
                    if length in best:
                        for at in range(0, len(candidates.ids), TILE):
                            best[length].add(candidates.take(slice(at, at + TILE)))
            for own in best.values():
                rows = list(own.rows())
                if rows:
                    q, v, s = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                                     names=["query_id", "vec_id", "score"])

        rows = vectors.mapInArrow(nearest, "query_id long, vec_id long, score double")
        found = rows if found is None else found.unionByName(rows)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def blocks_of(queries: DataFrame) -> dict[int, Block]:
    """A bounded set of queries as blocks on the driver."""
    rows = queries.toArrow()
    merged = rows.combine_chunks()
    if not merged.num_rows:
        return {}
    column = lambda i: merged.column(i).chunk(0)
    out = blocks(column(0), column(1))
    # a query that occurs twice is one query
    return {size: b.take(np.sort(np.unique(b.ids, return_index=True)[1])) for size, b in out.items()}


def op6_block_search(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of every row whose vec_id is divisible by 50, exact, over all rows."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE = """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
