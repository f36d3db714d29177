"""Exact top-k search by inner product with vector-approximation files.

Vectors become whole numbers, ``floor(256 x)`` per component. Candidates lie in
blocks; a block keeps an approximation file: each component as one byte, the
number of its cell between the block's least and largest value. The cells of a
candidate bound its score with a query from above. A query scans the bounds of a
block, then reads exact vectors in the order of their bounds until no unread
candidate can be among the best k any more. Each block sends on at most k rows a
query; the best of these over all blocks are the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.blocks import search_blocks
from tidewater.llm.common import column, find_package, materialise, schema_of

K = 5
SCALE = 256
BLOCK_MEMBERS = 16_384
_CELLS = 255
_READ = 64
#: Sums below this are exact in doubles.
_EXACT = 2.0**53
_LONG = 2**63 - 1
#: Components beyond this have no cells.
_FAR = 2.0**100


def scorable(vector) -> Column:
    """True unless the vector is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def whole_vectors(col: pa.Array, width: int) -> np.ndarray:
    """``floor(256 x)`` of each component, as doubles (whole numbers)."""
    from tidewater.llm.embeddings import _matrix

    return np.floor(SCALE * _matrix(col, width))


class VectorFile:
    """The members of one block with their approximation."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")  # ties of a score go to the smaller id
        self.ids, self.x = ids[order], x[order]
        self.rows = self.ids if rows is None else rows[order]
        self.largest = np.abs(self.x).max(initial=0)
        within = np.clip(self.x, -_FAR, _FAR)
        low, high = within.min(axis=0), within.max(axis=0)
        self.low, self.step = low, np.maximum((high - low) / _CELLS, np.finfo(float).tiny)
        self.cells = np.clip(np.floor((within - low) / self.step), 0, _CELLS - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No candidate's exact score is above its bound (queries x members).

        Far components have no bound, so such candidates are always read."""
        with np.errstate(over="ignore", invalid="ignore"):
            bounds = self._bounds(queries)
        far = (self.largest > _FAR) | ~np.isfinite(bounds)
        return np.where(far, np.inf, bounds)

    def _bounds(self, queries):
        scaled = queries * self.step
        middle = scaled @ (self.cells.astype(np.float64).T + 0.5) + (queries @ self.low)[:, None]
        half = np.abs(scaled).sum(axis=1) / 2
        size = (np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.low + _CELLS * self.step)))
        return middle + (half * (1 + 1e-9) + size * 1e-12 + 1e-6)[:, None]

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores; beyond a long they are the nearest long."""
        if float(self.largest) * float(np.abs(query).max(initial=0)) * max(1, len(query)) < _EXACT:
            return (self.x[rows] @ query).astype(np.int64)
        q = [int(v) for v in query]
        sums = [sum(int(a) * b for a, b in zip(x, q)) for x in self.x[rows].tolist()]
        return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], dtype=np.int64)

    def best(self, row: int, query: np.ndarray, bound: np.ndarray, k: int):
        """Positions and scores of the ``k`` best members but the query's own row."""
        bound = np.where(self.rows == row, -np.inf, bound)
        found, values = np.empty(0, np.int64), np.empty(0, np.int64)
        left, take = np.arange(len(bound)), _READ
        while len(left):
            if len(left) > take:
                split = np.argpartition(-bound[left], take)
                read, left = left[split[:take]], left[split[take:]]
            else:
                read, left = left, left[:0]
            read = read[bound[read] > -np.inf]
            found = np.concatenate([found, read])
            values = np.concatenate([values, self.scores(query, read)])
            order = np.lexsort((self.ids[found], ~values))[:k]  # ~: the least long has no negative
            found, values = found[order], values[order]
            if len(found) == k:
                left = left[bound[left] >= values[-1]]
            take *= 2
        return found, values


class _Block:
    def __init__(self, batches, width, k):
        self.width, self.k = width, k
        self.file = VectorFile(np.concatenate([b.column(3).to_numpy() for b in batches]),
                               np.concatenate([whole_vectors(b.column(4), width) for b in batches]),
                               np.concatenate([b.column(2).to_numpy() for b in batches]))

    def own(self):
        return ()

    def close(self):
        return ()

    def links(self, batch):
        rows, ids = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        queries = whole_vectors(batch.column(4), self.width)
        for at in range(0, len(ids), 128):
            bounds = self.file.bounds(queries[at:at + 128])
            out = [self.file.best(r, q, b, self.k) for r, q, b in zip(rows[at:at + 128], queries[at:at + 128], bounds)]
            n = [len(found) for found, _ in out]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(rows[at:at + 128], n)), pa.array(np.repeat(ids[at:at + 128], n)),
                pa.array(np.concatenate([self.file.ids[found] for found, _ in out])),
                pa.array(np.concatenate([v for _, v in out]))], ["row", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best scores of each query.

    ``is_query`` is a condition on a column ``id``. Every row but the query's own
    is a candidate; all of them, if there are fewer than ``k``. Ties go to the
    smaller id. Vectors that are null or hold null or non-finite components, and
    rows without an id, take no part. Of rows that repeat an id each is a candidate,
    for the others too, and each query row gets its own ranks. A shorter vector counts as padded with zeros. Scores beyond a
    long are given as the nearest long.
    """
    find_package(vectors.sparkSession)
    rows = vectors.select(column(vectors, id_col).cast("bigint").alias("id"),
                          column(vectors, vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & scorable(F.col("v")))
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("row"), "id", "v"), "search")
    n, width = rows.agg(F.count("*"), F.coalesce(F.greatest(F.max(F.size("v")), F.lit(1)), F.lit(1))).first()
    blocks = max(1, -(-n // BLOCK_MEMBERS))
    members = rows.select(F.expr(f"pmod(xxhash64(row), {blocks})").alias("block"),
                          F.lit(0).cast("tinyint").alias("kind"), "row", "id", "v")
    # Every query is set against every block of candidates.
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    queries = rows.where(is_query).select(F.explode(every).alias("block"), F.lit(1).cast("tinyint").alias("kind"), "row", "id", "v")
    schema = schema_of(row="bigint", query_id="bigint", vec_id="bigint", score="bigint")
    found = search_blocks(members.union(queries), blocks, lambda batches: _Block(batches, width, k), schema)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
