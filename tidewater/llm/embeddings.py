"""Embedding near-dedup: spherical k-means cells, blocked cosine products.

Vectors are grouped by content first, so copies are one row. Each distinct
vector is a member of its nearest cell. A pair in two cells is found if one of
its vectors also visits the other's cell: for unit vectors x (cell a) and y
(cell b), ``x.(a - b) <= |x - y| |a - b|`` times the cosine between ``x - y``
and ``a - b``. A vector visits each later cell b with
``x.(a - b) <= slack |a - b|``. With ``slack = sqrt(2 - 2 t)`` this bound is
exact. The default takes the direction of ``x - y`` as independent of the
centroids: four standard deviations of its cosine with a fixed direction. Their
size is that of the direction in which the sample varies most inside its cells,
``sqrt(largest eigenvalue / trace)``, in even data ``1 / sqrt(dimensions)``.
Recall against brute force is tested.

Vectors may differ in length. Cells, products and memory use the first ``width``
components, a length that all but a hundredth of the rows keep within; only two
longer vectors have more to add, and where that could reach the threshold their
rests are multiplied too. So a long row costs no other row anything.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.blocks import dense_star, search_blocks
from tidewater.llm.common import column, find_package, materialise, schema_of, splitmix, stable_sample
from tidewater.llm.components import connected_components

THRESHOLD = 0.9
DEVIATIONS = 4.0
#: Distinct vectors that the cells are fitted on, at most (all are indexed), and
#: their components together.
SAMPLE, SAMPLE_NUMBERS = 20_000, 1 << 23
#: Share of the rows that may be longer than the width, and the most the width can be.
LONG_ROWS, MAX_WIDTH = 0.01, 4_096
MAX_CELLS = 1_024
ROUNDS = 10
BLOCK_MEMBERS = 4_096


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centroids of the unit rows of ``x`` (fixed seed)."""
    draw = np.random.default_rng(11)
    centers = x[draw.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        cell = np.argmax(x @ centers.T, axis=1)
        total = np.zeros_like(centers)
        np.add.at(total, cell, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centers = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centers)
    return centers


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter vectors are padded with zeros."""
    lengths = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = flat
    return out


class _Units:
    """Unit vectors of a list column: their first ``width`` components as rows of
    ``x``, and of longer ones what is left (``rests``, by row) with its length."""

    def __init__(self, cols: list[pa.Array], width: int):
        parts, at, self.rests = [], 0, {}
        for col in cols:
            lengths = np.diff(col.offsets.to_numpy())
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(lengths) - lengths
            row = np.repeat(np.arange(len(lengths)), lengths)
            if len(lengths):
                flat /= np.maximum.reduceat(np.abs(flat), starts)[row]  # no overflow of the squares
                flat /= np.sqrt(np.add.reduceat(flat * flat, starts))[row]
            place = np.arange(len(flat)) - starts[row]
            inside = place < width
            x = np.zeros((len(lengths), width))
            x[row[inside], place[inside]] = flat[inside]
            parts.append(x)
            for i in np.flatnonzero(lengths > width).tolist():
                self.rests[at + i] = flat[starts[i] + width:starts[i] + lengths[i]].copy()
            at += len(lengths)
        self.x = np.concatenate(parts) if parts else np.zeros((0, width))
        self.long = np.array(sorted(self.rests), dtype=np.int64)
        self.rest_size = np.array([np.linalg.norm(self.rests[i]) for i in self.long.tolist()])

    def add_rests(self, dots: np.ndarray, first: int, others: _Units, threshold: float) -> None:
        """Complete the products ``dots`` of rows from ``first`` on with all rows of
        ``others``, where two long rows could reach the threshold."""
        if not len(others.long):
            return
        own = (self.long >= first) & (self.long < first + len(dots))
        for i, size in zip(self.long[own].tolist(), self.rest_size[own].tolist()):
            most = dots[i - first, others.long] + size * others.rest_size
            for j in others.long[most >= threshold - 1e-9].tolist():
                a, b = self.rests[i], others.rests[j]
                n = min(len(a), len(b))
                dots[i - first, j] += a[:n] @ b[:n]


def largest_share(x: np.ndarray, centers: np.ndarray) -> float:
    """Standard deviation along the direction in which the rows vary most around
    their centroids, as a share of all their variation (1 if there is none)."""
    if not len(x):
        return 1.0
    rest = x - centers[np.argmax(x @ centers.T, axis=1)]
    spread = rest.T @ rest
    total = np.trace(spread)
    return math.sqrt(np.linalg.eigvalsh(spread)[-1] / total) if total > 1e-12 else 1.0


def usable(vector) -> F.Column:
    """True if a vector has a direction: no null, no non-finite, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


#: Rows of a block search: links (a, b), and links counted for a vector (a, key, n).
_LINK_NAMES = ["a", "b", "key", "n"]
_LINKS = "a bigint, b bigint, key bigint, n bigint"


class _Block:
    def __init__(self, batches, width, threshold):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.reps = rows.column("rep").to_numpy()
        self.copies = rows.column("copies").to_numpy()
        self.keys = rows.column("key").to_numpy()
        self.units = _Units([b.column(5) for b in batches], width)
        self.width, self.threshold = width, threshold
        self.seen = np.zeros(len(self.reps), np.int64)

    def own(self):
        yield from self._compare(self.reps, self.keys, self.copies, self.units, own=True)

    def links(self, b):
        rep, key, copies = (b.column(i).to_numpy() for i in (2, 3, 4))
        yield from self._compare(rep, key, copies, _Units([b.column(5)], self.width))

    def close(self):
        found = np.flatnonzero(self.seen)
        yield _counted(self.reps[found], self.keys[found], self.seen[found])

    def _compare(self, reps, keys, copies, units, own=False):
        for k in range(0, len(reps), 512):
            dots = units.x[k:k + 512] @ self.units.x.T
            units.add_rests(dots, k, self.units, self.threshold)
            linked = dots >= self.threshold
            if own:
                linked[np.arange(len(linked)), k + np.arange(len(linked))] = False
            if not linked.any():
                continue
            part = reps[k:k + 512]
            n = linked @ self.copies
            r, to, c, c_to = dense_star(linked)
            yield _counted(part[r], keys[k:k + 512][r], n[r])
            if not own:
                self.seen += copies[k:k + 512] @ linked
            a, b = np.concatenate([part[r], self.reps[c]]), np.concatenate([self.reps[to], self.reps[c_to]])
            keep = a != b
            none = pa.nulls(int(keep.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), none, none], _LINK_NAMES)


def _counted(reps, keys, n):
    none = pa.nulls(len(reps), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(reps), none, pa.array(keys), pa.array(n)], _LINK_NAMES)


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = THRESHOLD, deviations: float | None = DEVIATIONS) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row of ``vectors``.

    ``n_links`` counts the other rows whose cosine with this one is at least
    ``threshold``, in double precision; ``component_id`` is the smallest id that
    links reach; ``kept`` marks the one representative of each group. Vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing. A shorter vector counts as padded with zeros. Rows that repeat an
    id are vectors of their own, which the id connects, and every row with the
    group's smallest id is kept; a row with a null id links with nothing, is its own (null) component
    and is kept. ``deviations=None`` takes the exact bound.
    """
    find_package(vectors.sparkSession)
    rows = vectors.select(column(vectors, id_col).cast("bigint").alias("id"),
                          column(vectors, vector_col).alias("v"))
    linkable = F.col("id").isNotNull() & usable(F.col("v"))
    distinct = materialise(
        rows.where(linkable).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                              F.max(F.size("v")).alias("width"))
        .withColumn("key", F.xxhash64("v")), "vectors")
    n, width = distinct.agg(F.count("*"), F.percentile_approx("width", 1 - LONG_ROWS, 10_000)).first()
    found = materialise(_found(distinct, n, min(width or 1, MAX_WIDTH), threshold, deviations), "vector-links")
    links = (found.where("b is null").groupBy(F.col("a").alias("rep"), "key").agg(F.sum("n").alias("others")))
    groups = connected_components(found.where("b is not null"))
    out = (distinct.join(links, ["rep", "key"], "left")
           .join(groups, F.col("rep") == groups["node"], "left")
           .select("v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("component", "rep").alias("component_id")))
    used = rows.where(linkable).join(out, "v").select("id", "n_links", "component_id")
    rest = rows.where(~linkable).select("id", F.lit(0).cast("bigint"), F.col("id"))
    return used.union(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _found(distinct, n, width, threshold, deviations):
    # Only unit vectors of the width come to the driver, however long a row is.
    def units(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                x = _Units([b.column(0).slice(at, 1024)], width).x
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], ["x"])

    drawn = stable_sample(distinct.select("rep", "v"), F.col("rep"), min(SAMPLE, max(1, SAMPLE_NUMBERS // width)), n)
    sample = drawn.select("v").mapInArrow(units, "x binary").collect()
    k = max(1, min(MAX_CELLS, len(sample) // 16, round(math.sqrt(n) / 2)))
    x = np.array([np.frombuffer(r.x) for r in sample]).reshape(-1, width)
    centers = spherical_kmeans(x, k) if len(x) else np.zeros((1, width))
    slack = math.sqrt(max(0.0, 2 - 2 * threshold))
    if deviations is not None:
        slack *= min(1.0, deviations * largest_share(x, centers))

    def cells(batches):
        for b in batches:
            cell, count = np.unique(np.argmax(_Units([b.column(0)], width).x @ centers.T, axis=1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(count)], ["cell", "n"])

    # One row a cell, at most MAX_CELLS.
    counts = dict(distinct.select("v").mapInArrow(cells, "cell bigint, n bigint")
                  .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    parts = np.array([-(-counts.get(i, 1) // BLOCK_MEMBERS) for i in range(k)])
    first = np.concatenate([[0], np.cumsum(parts)])
    schema = schema_of(block="bigint", kind="tinyint", rep="bigint", key="bigint", copies="bigint",
                       v=distinct.schema["v"].dataType)

    def routed(batches):
        between = np.sqrt(np.maximum(0, 2 - 2 * centers @ centers.T))
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                reps, keys, copies, vectors = b.columns
                near = _Units([vectors], width).x @ centers.T
                cell = np.argmax(near, axis=1)
                # Dealt by a hash, so that ids of any stride fill all blocks of a cell.
                dealt = splitmix(reps.to_numpy().view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
                own = first[cell] + (dealt % parts[cell].astype(np.uint64)).astype(np.int64)
                visit = near >= near[np.arange(len(cell)), cell][:, None] - slack * between[cell] - 1e-9
                for row_ids, block, kind in _targets(cell, own, visit):
                    take = pa.array(row_ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(block, pa.int64()), pa.array(np.full(len(block), kind, np.int8)),
                        reps.take(take), keys.take(take), copies.take(take), vectors.take(take)], schema.fieldNames())

    def _targets(cell, own, visit):
        yield np.arange(len(cell)), own, 0
        visit &= np.arange(k)[None, :] >= cell[:, None]
        row, to = np.nonzero(visit)
        blocks = np.repeat(first[to], parts[to])
        row = np.repeat(row, parts[to])
        step = np.arange(len(blocks)) - np.repeat(np.cumsum(parts[to]) - parts[to], parts[to])
        blocks = blocks + step
        later = own[row] < blocks
        yield row[later], blocks[later], 1

    routes = distinct.select("rep", "key", "copies", "v").mapInArrow(routed, schema)
    return search_blocks(routes, int(first[-1]), lambda batches: _Block(batches, width, threshold),
                         _LINKS)
