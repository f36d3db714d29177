"""SimHash near-dedup: 64-bit fingerprints linked by Hamming distance.

Two fingerprints within r bits agree on whole segments of their bits: of r + 1
segments on one at least, of r + a on a. A shard holds the fingerprints that agree
on one choice of a segments, so each distinct fingerprint is in a fixed number of
shards, and no ball around it overlaps another shard of the same choice.

Inside a shard a vantage-point tree prunes branches by the triangle bound (the
distances of two linked fingerprints to a vantage point differ by r at most), and
its leaves are compared exactly. A shard with many members is cut into blocks by a
tree over a bounded sample: a fingerprint is a member of one block, and a query to
every later block whose region its ball of radius r overlaps. So every pair within
r bits is found.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.blocks import dense_star, search_blocks
from tidewater.llm.common import column, fresh_names, id_text, materialise, raw_texts, schema_of, stable_sample
from tidewater.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints of large shards that the tree of their blocks is fitted on, at most.
SAMPLE = 20_000
#: Beyond this many members a shard is cut into blocks, and a block into parts.
BLOCK_MEMBERS = 4_096
#: Unrelated fingerprints a shard, at most about this many.
SHARD_MEMBERS = 256
LEAF = 256
#: Rows of shards searched by one task, about.
TASK_ROWS = 20_000
_SHINGLE_CHUNK = 4096


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of word shingles (XXH64, seed 42); 0 without words."""
    found = text.lower().split()  # bytes: ASCII letters and white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), (ends[-n:] - 1).tolist())
    hashes = np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _SHINGLE_CHUNK):
        bits = np.unpackbits(hashes[k:k + _SHINGLE_CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)``: the fingerprint of each whole text, as a signed long."""
    rows = id_text(docs, id_col, text_col)
    schema = schema_of(id=rows.schema["id"].dataType, fp="bigint")

    def hashed(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in raw_texts(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], schema.fieldNames())

    return rows.mapInArrow(hashed, schema)


class VantageTree:
    """A vantage-point tree; nodes are ``(point, radius, inner, outer)``.

    A child is a node number, or ``~leaf``. Of a few candidate points the one
    with the fewest points near its boundary is taken.
    """

    def __init__(self, points: np.ndarray, leaf: int, reach: int, candidates: int = 8):
        self.nodes: list[list] = []
        self.leaves: list[np.ndarray] = []
        self.reach = reach
        self._points = points
        self.root = ~0 if not len(points) else None
        work = [(np.arange(len(points)), None, 0)]
        draw = np.random.default_rng(7)
        while work:
            rows, parent, side = work.pop()
            split = self._split(rows, candidates, draw) if len(rows) > leaf else None
            if split is None:
                ref = ~len(self.leaves)
                self.leaves.append(rows)
            else:
                point, radius, inner = split
                ref = len(self.nodes)
                self.nodes.append([point, radius, None, None])
                work += [(rows[inner], ref, 2), (rows[~inner], ref, 3)]
            if parent is None:
                self.root = ref
            else:
                self.nodes[parent][side] = ref

    def _split(self, rows, candidates, draw):
        best, sample = None, self._points[rows[:4096]]
        for point in self._points[draw.choice(rows, candidates)]:
            d = np.bitwise_count(sample ^ point).astype(np.int64)
            for radius in np.unique(np.percentile(d, (40, 50, 60)).astype(np.int64)):
                share = (d <= radius).mean()
                if 0 < share < 1:
                    near = (np.abs(d - radius) <= self.reach).mean() + abs(share - 0.5)
                    if best is None or near < best[0]:
                        best = (near, point, int(radius))
        if best is None:
            return None
        inner = np.bitwise_count(self._points[rows] ^ best[1]) <= best[2]
        return (best[1], best[2], inner) if 0 < inner.sum() < len(rows) else None

    def home(self, fps: np.ndarray) -> np.ndarray:
        """The leaf in whose region each fingerprint lies."""
        out = np.zeros(len(fps), np.int64)
        work = [(self.root, np.arange(len(fps)))]
        while work:
            ref, rows = work.pop()
            if ref < 0:
                out[rows] = ~ref
            elif len(rows):
                point, radius, inner, outer = self.nodes[ref]
                d = np.bitwise_count(fps[rows] ^ point)
                work += [(inner, rows[d <= radius]), (outer, rows[d > radius])]
        return out

    def reached(self, fps: np.ndarray):
        """``(leaf, rows)`` for each leaf that the balls of some rows overlap."""
        work = [(self.root, np.arange(len(fps)))]
        while work:
            ref, rows = work.pop()
            if not len(rows):
                continue
            if ref < 0:
                yield ~ref, rows
                continue
            point, radius, inner, outer = self.nodes[ref]
            d = np.bitwise_count(fps[rows] ^ point).astype(np.int64)
            work += [(inner, rows[d <= radius + self.reach]), (outer, rows[d > radius - self.reach])]


_EDGES = "a bigint, b bigint"
#: Kinds of rows sent to a block; at home a query only meets the block's other parts.
MEMBER, QUERY, AT_HOME = 0, 1, 2


class _Shard:
    """The members of one block, with their own tree."""

    def __init__(self, batches, reach):
        self.fps = np.concatenate([b.column(2).to_numpy() for b in batches]).view(np.uint64)
        self.reps = np.concatenate([b.column(3).to_numpy() for b in batches])
        self.reach = reach
        self.tree = VantageTree(self.fps, LEAF, reach, candidates=3)

    def own(self):
        yield from self._search(self.fps, self.reps)

    def links(self, batch):
        yield from self._search(batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy())

    def close(self):
        return ()

    def _search(self, fps, reps):
        a, b, held = [], [], 0
        for leaf, rows in self.tree.reached(fps):
            inside = self.tree.leaves[leaf]
            step = max(1, 4_000_000 // len(inside))
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                near = np.bitwise_count(fps[part][:, None] ^ self.fps[inside][None, :]) <= self.reach
                if not near.any():
                    continue
                r, to, c, c_to = dense_star(near)
                a += [reps[part[r]], self.reps[inside[c]]]
                b += [self.reps[inside[to]], self.reps[inside[c_to]]]
                held += len(r) + len(c)
            if held > 500_000:
                yield _edges(a, b)
                a, b, held = [], [], 0
        if a:
            yield _edges(a, b)


def _edges(a, b):
    a, b = np.concatenate(a), np.concatenate(b)
    keep = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def segment_masks(n: int, reach: int) -> list[int]:
    """Masks of the choices of segments that shards agree on.

    With more fingerprints shards agree on more segments, so that unrelated
    fingerprints fill no shard; whatever the choice, no pair within reach is lost.
    """
    agree = 1
    while n > SHARD_MEMBERS << (64 * agree // (reach + agree)) and agree < 4:
        agree += 1
    edges = [64 * i // (reach + agree) for i in range(reach + agree + 1)]
    segments = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(segments, agree)]


def hamming_links(distinct: DataFrame, reach: int = MAX_BITS) -> DataFrame:
    """``(a, b)`` links that connect the ``rep`` values of all fingerprints
    within ``reach`` bits, directly or over other links; ``distinct`` has one
    row ``(fp, rep)`` per fingerprint and is read several times."""
    n = distinct.count()
    masks = [m - (1 << 64) if m >> 63 else m for m in segment_masks(n, reach)]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in masks])
    rows = distinct.select(F.posexplode(keys).alias("choice", "bits"), "fp", "rep")
    large = materialise(rows.groupBy("choice", "bits").agg(F.count("*").alias("members"))
                        .where(F.col("members") > BLOCK_MEMBERS), "large-shards")
    n_large, n_members = large.agg(F.count("*"), F.coalesce(F.sum("members"), F.lit(0))).first()
    # Shards whose numbers meet by chance are searched as one; all pairs are compared exactly.
    shard = F.shiftrightunsigned(F.xxhash64("choice", "bits"), 2)
    member = F.lit(MEMBER).cast("tinyint").alias("kind")
    small = rows if not n_large else rows.join(large, ["choice", "bits"], "left_anti")
    blocks = small.select(shard.alias("block"), member, "fp", "rep")
    if n_large:
        blocks = blocks.union(_blocks_of(rows.join(large, ["choice", "bits"], "left_semi"), n_members, reach))
    n_tasks = -(-n * len(masks) // TASK_ROWS) or 1
    return search_blocks(blocks, n_tasks, lambda batches: _Shard(batches, reach), _EDGES)


def _blocks_of(rows: DataFrame, n: int, reach: int) -> DataFrame:
    """Members and queries of the blocks of large shards."""
    sample = stable_sample(rows.select("fp"), F.col("fp"), SAMPLE, n).collect()
    points = np.unique(np.array([r.fp for r in sample], dtype=np.int64).view(np.uint64))
    tree = VantageTree(points, max(16, round(BLOCK_MEMBERS * len(sample) / n)), reach)
    fields = ["choice", "bits", "leaf", "kind", "fp", "rep"]

    def routed(batches):
        for b in batches:
            fps = b.column(2).to_numpy().view(np.uint64)
            home, every = tree.home(fps), np.arange(len(fps))
            yield sent(b, every, home, MEMBER)
            yield sent(b, every, home, AT_HOME)
            for leaf, to in tree.reached(fps):
                yield sent(b, to[home[to] < leaf], leaf, QUERY)

    def sent(b, to, leaf, kind):
        part = b.take(pa.array(to))
        return pa.RecordBatch.from_arrays([
            *part.columns[:2], pa.array(np.broadcast_to(leaf, len(to)), pa.int32()),
            pa.array(np.full(len(to), kind, np.int8)), *part.columns[2:]], fields)

    routes = materialise(rows.mapInArrow(routed, "choice int, bits bigint, leaf int, kind tinyint, fp bigint, rep bigint"),
                         "routes")
    place = ["choice", "bits", "leaf"]
    parts = materialise(routes.where(F.col("kind") == MEMBER).groupBy(*place).agg(
        F.expr(f"cast(ceil(count(*) / {BLOCK_MEMBERS}) as int)").alias("parts")), "block-parts")
    dealt = routes.join(parts, place).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # A query goes to all parts of a later block, and at home to the parts after its own.
    to = (F.when(F.col("kind") == MEMBER, F.array("own"))
          .when(F.col("kind") == QUERY, F.sequence(F.lit(0), F.col("parts") - 1))
          .when(F.col("own") + 1 < F.col("parts"), F.sequence(F.col("own") + 1, F.col("parts") - 1)))
    block = F.shiftrightunsigned(F.xxhash64("choice", "bits", "leaf", "part"), 2)
    kind = F.when(F.col("kind") == MEMBER, MEMBER).otherwise(QUERY).cast("tinyint")
    return dealt.withColumn("part", F.explode(to)).select(block.alias("block"), kind.alias("kind"), "fp", "rep")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = SHINGLE_WORDS, reach: int = MAX_BITS) -> DataFrame:
    """``(id, fp, component_id)`` per row of ``docs``; ids are whole numbers.

    Documents without words have fingerprint zero and link like any other. Rows
    that repeat an id each get a row. A row with a null id gets its fingerprint,
    links with nothing, and has a null component. Equal fingerprints are one
    node, so a group of copies costs one row after the partial aggregation.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, words).withColumn("id", F.col("id").cast("bigint")), "fps")
    distinct = materialise(fps.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "distinct-fps")
    links = connected_components(hamming_links(distinct, reach))
    component = (distinct.join(links, distinct["rep"] == links["node"], "left")
                 .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return (fps.join(component, "fp", "left")
            .select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
             reach: int = MAX_BITS) -> DataFrame:
    """One document of each linked group, the one with the smallest id, with its columns.

    Of rows that share that id one stays, that with the smallest hash over all
    columns. Rows without an id link with nothing and all stay.
    """
    (key,) = fresh_names(docs, "kept_id")
    kept = (simhash_components(docs, id_col, text_col, words, reach).where("id = component_id")
            .select(F.col("id").alias(key)).distinct())
    here = column(docs, id_col).cast("bigint")
    rows = docs.withColumn(key, here).join(kept, key, "left_semi")
    fields = [column(rows, c) for c in docs.columns]
    one = rows.groupBy(key).agg(F.min_by(F.struct(*fields), F.xxhash64(*fields)).alias("row"))
    one = one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return one.union(docs.where(here.isNull()))


def hex_fingerprint(fp: str = "fp"):
    """The unsigned fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
