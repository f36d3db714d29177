"""Line dedup: a sharded minimal perfect hash over the distinct line hashes.

1. Each document gives its distinct line hashes (128 bits); documents a hash are
   counted (aggregated by hash and document first, so repeats count once).
2. Hashes are dealt to shards. A shard is a minimal perfect hash (levels of bit
   arrays with ranks) that leads a hash to its slot in two compact arrays, its
   64-bit fingerprint and its count of documents.
3. Documents probe the arrays. Hashes in more than one document line of 10,000
   (at most 10,000 such hashes, whatever the input) are in one small shard that
   every task holds. The rest are probed shard by shard: a task loads a shard's
   arrays and the probes stream past. Lines are never joined with lines.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import column, fresh_names, id_text, materialise, raw_texts, schema_of, splitmix

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 200_000
#: A hash with more than this share of all probes is in the common shard.
COMMON_SHARE = 1e-4
_GAMMA = 2.0


class PerfectHash:
    """Slots 0..n-1 for n distinct 128-bit hashes, with fingerprints and counts."""

    def __init__(self, levels, ranks, fingerprints, counts):
        self.levels, self.ranks, self.fingerprints, self.counts = levels, ranks, fingerprints, counts

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> PerfectHash:
        levels, ranks = [], []
        prints, held = np.empty(len(hi), np.uint64), np.empty(len(hi), np.uint32)
        left, base = np.arange(len(hi)), 0
        while len(left):
            size = max(64, int(_GAMMA * len(left)) // 64 * 64 + 64)
            at = _place(hi[left], lo[left], len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            words = np.packbits(bits, bitorder="little").view("<u8")
            rank = base + np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
            slot = _rank(words, rank, at[alone])
            prints[slot], held[slot] = lo[left[alone]], np.minimum(counts[left[alone]], 2**32 - 1)
            levels.append(words)
            ranks.append(rank)
            left, base = left[~alone], int(rank[-1])
        return cls(levels, ranks, prints, held)

    def counts_of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The count of each hash, 0 where the fingerprint differs."""
        out, left = np.zeros(len(hi), np.int64), np.arange(len(hi))
        for level, (words, rank) in enumerate(zip(self.levels, self.ranks)):
            at = _place(hi[left], lo[left], level, 64 * len(words))
            hit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            slot = _rank(words, rank, at[hit])
            same = self.fingerprints[slot] == lo[left[hit]]
            out[left[hit][same]] = self.counts[slot[same]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, fingerprints=self.fingerprints, counts=self.counts,
                 **{f"level{i}": w for i, w in enumerate(self.levels)},
                 **{f"rank{i}": r for i, r in enumerate(self.ranks)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        with np.load(io.BytesIO(data)) as f:
            n = sum(k.startswith("level") for k in f.files)
            return cls([f[f"level{i}"] for i in range(n)], [f[f"rank{i}"] for i in range(n)],
                       f["fingerprints"], f["counts"])


def _place(hi, lo, level, size):
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (splitmix(splitmix(hi ^ salt) + lo) % np.uint64(size)).astype(np.int64)


def _rank(words, rank, at):
    below = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
    return rank[at >> 6] + np.bitwise_count(below).astype(np.int64)


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def _line_hash(line: bytes, min_chars: int) -> bytes | None:
    key = line_key(line)
    if len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(digests: bytes):
    table = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    return table[:, 0], table[:, 1]


def line_hashes(rows: DataFrame, min_chars: int, common: bytes | None = None, min_docs: int = 0) -> DataFrame:
    """``(id, hi, lo, sure)``: the distinct line hashes of each row.

    With a ``common`` shard, its hashes are answered here: those in at least
    ``min_docs`` documents come out as ``sure``, its others not at all.
    """
    schema = schema_of(id=rows.schema["id"].dataType, hi="bigint", lo="bigint", sure="boolean")

    def hashed(batches):
        index = PerfectHash.from_bytes(common) if common else None
        for b in batches:
            row, digests = [], []
            for i, text in enumerate(raw_texts(b.column(1))):
                own = {_line_hash(line, min_chars) for line in text.split(b"\n")}
                own.discard(None)
                row.extend([i] * len(own))
                digests.extend(own)
                if len(row) > 500_000 or i == b.num_rows - 1:
                    yield _hash_batch(b.column(0), row, b"".join(digests), index)
                    row, digests = [], []

    def _hash_batch(ids, row, digests, index):
        hi, lo = _halves(digests)
        row, sure = np.array(row, dtype=np.int64), np.zeros(len(hi), bool)
        if index is not None:
            counts = index.counts_of(hi, lo)
            keep = (counts == 0) | (counts >= min_docs)
            row, hi, lo, sure = row[keep], hi[keep], lo[keep], counts[keep] > 0
        return pa.RecordBatch.from_arrays([
            ids.take(pa.array(row)), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(sure),
        ], schema.fieldNames())

    return rows.mapInArrow(hashed, schema)


def line_index(rows: DataFrame, min_chars: int):
    """Counts of documents per line hash (a table), and the common shard."""
    counts = materialise(
        line_hashes(rows, min_chars).groupBy("hi", "lo").agg(F.count_distinct(F.struct("id")).alias("docs")), "lines")
    keys, probes = counts.agg(F.count("*"), F.coalesce(F.sum("docs"), F.lit(0))).first()
    least = max(1, int(COMMON_SHARE * probes))
    # At most 1 / COMMON_SHARE hashes have more than that share of all probes.
    top = counts.where(F.col("docs") > least).collect()
    hi, lo, n = (np.array([r[i] for r in top], dtype=np.int64) for i in range(3))
    common = PerfectHash.build(hi.view(np.uint64), lo.view(np.uint64), n)
    n_shards = max(1, -(-keys // SHARD_KEYS))
    return counts.where(F.col("docs") <= least), n_shards, common


def shards(counts: DataFrame, n_shards: int) -> DataFrame:
    """``(shard, arrays)``: one row per shard of the line index."""

    def build(table: pa.Table) -> pa.Table:
        hi, lo = (table.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo"))
        arrays = PerfectHash.build(hi, lo, table.column("docs").to_numpy()).to_bytes()
        return pa.table({"shard": table.column("shard").slice(0, 1), "arrays": pa.array([arrays], pa.binary())})

    return counts.withColumn("shard", _shard(n_shards)).groupBy("shard").applyInArrow(build, "shard int, arrays binary")


def _shard(n_shards):
    return F.expr(f"cast(pmod(hi, {n_shards}) as int)")


def frequent_lines(rows: DataFrame, texts: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """``(id, hi, lo)``: line hashes of each of ``texts`` (id, text) that ``min_docs``
    documents of ``rows`` hold."""
    counts, n_shards, common = line_index(rows, min_chars)
    probes = materialise(line_hashes(texts, min_chars, common.to_bytes(), min_docs), "probes")
    kind = texts.schema["id"].dataType
    none = F.lit(None).cast(kind)
    asked = probes.where("not sure").select(_shard(n_shards).alias("shard"), F.lit(None).cast("binary").alias("arrays"),
                                            "id", "hi", "lo")
    held = shards(counts, n_shards).select("shard", "arrays", none.alias("id"), F.lit(0).cast("bigint").alias("hi"),
                                           F.lit(0).cast("bigint").alias("lo"))
    schema = schema_of(id=kind, hi="bigint", lo="bigint")

    def probe(batches):
        index, now = None, None
        for b in batches:
            shard = np.asarray(b.column(0).to_numpy())
            loads = np.flatnonzero(np.asarray(b.column(1).is_valid()))
            for s, e in zip([0, *loads.tolist()], [*loads.tolist(), len(shard)]):
                if s == e:
                    continue
                part = b.slice(s, e - s)
                if part.column(1)[0].is_valid:
                    index, now = PerfectHash.from_bytes(part.column(1)[0].as_py()), shard[s]
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                if index is None or (part.column(0).to_numpy() != now).any():
                    raise ValueError("a probe came to a task without its shard")
                hi, lo = (part.column(i).to_numpy().view(np.uint64) for i in (3, 4))
                hit = pa.array(np.flatnonzero(index.counts_of(hi, lo) >= min_docs))
                yield pa.RecordBatch.from_arrays([part.column(i).take(hit) for i in (2, 3, 4)], schema.fieldNames())

    # As many partitions as shards, within reason: a shard's rows come to one task,
    # its arrays first, and no hash in it has more than COMMON_SHARE of all probes.
    n = max(1, min(n_shards, 20_000))
    found = (held.union(asked).repartitionById(n, F.expr(f"cast(shard % {n} as int)"))
             .sortWithinPartitions("shard", F.col("arrays").isNull()).mapInArrow(probe, schema))
    return found.union(probes.where("sure").select("id", "hi", "lo"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the kept text, and ``n_lines``, ``n_dropped`` (new names if taken).

    Lines end at ``\\n``; a null or empty text is one empty line, and an absent
    text becomes the empty one. A line's key has ASCII white space stripped at
    both ends and A-Z lower-cased. Keys of ``min_chars`` code points or more
    found in ``min_docs`` documents or more lose all their lines everywhere;
    the other lines stay as they are, joined by ``\\n``. Rows that share an id
    count as one document, as do all rows without an id. Every row comes back,
    with all its columns.
    """
    rows = id_text(docs, id_col, text_col)
    # Lists belong to a text under its id, so none is longer than the text's lines,
    # however many rows share an id or have none. Should two texts share a hash, their
    # list is longer, but still of frequent lines only.
    mark = F.xxhash64("id", "text")
    drops = frequent_lines(rows, rows.select(mark.alias("id"), "text"), min_docs, min_chars).distinct().groupBy("id").agg(
        F.collect_list(F.struct("hi", "lo")).alias("drop"))
    key, drop, total, gone = fresh_names(docs, "line_doc", "line_drop", "n_lines", "n_dropped")
    (marked,) = fresh_names(docs.withColumn(key, F.lit(0)).withColumn(drop, F.lit(0)), "line_text")
    drops = drops.select(F.col("id").alias(key), F.col("drop").alias(drop))
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    joined = docs.withColumn(marked, F.xxhash64(column(docs, id_col), text)).join(
        drops, F.col(marked) == F.col(key), "left").drop(key, marked)
    text_at, drop_at = joined.columns.index(text_col), joined.columns.index(drop)
    schema = docs.select(*[column(docs, c).cast("string").alias(c) if c == text_col else column(docs, c)
                           for c in docs.columns]).schema
    for name in (total, gone):
        schema = schema.add(name, "long")

    def kept(batches):
        for b in batches:
            texts, n, dropped = [], [], []
            spans = b.column(drop_at)
            for text, drop in zip(raw_texts(b.column(text_at)), spans):
                lines = text.split(b"\n")
                stay = lines
                if drop.is_valid:
                    hi, lo = (drop.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    frequent = np.column_stack([hi, lo]).astype("<i8").tobytes()
                    frequent = {frequent[i:i + 16] for i in range(0, len(frequent), 16)}
                    stay = [x for x in lines if _line_hash(x, min_chars) not in frequent]
                texts.append(b"\n".join(stay))
                n.append(len(lines))
                dropped.append(len(lines) - len(stay))
            cols = [b.column(i) for i in range(b.num_columns) if i != drop_at]
            cols[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(dropped, pa.int64())],
                                             schema.fieldNames())

    return joined.mapInArrow(kept, schema)


def sha256_hex(text_col: str):
    return F.sha2(F.col(text_col).cast("binary"), 256)


def sha256_of(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()
