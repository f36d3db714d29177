"""Best-fit packing of documents into fixed-length training sequences.

Bounded-space best-fit: at most ``OPEN_BINS`` bins are open at a time. They are
kept by free space, and a bitset has bit f set if some open bin has f free
tokens, so the tightest fit is the lowest set bit at or above a piece's length.
When a bin must be opened beyond the bound, the fullest open one closes first.

Pieces come in rounds of at most ``OPEN_BINS`` pieces, each round with the same mix
of lengths, longest first: long pieces open no more bins than stay open until
the small ones that fill them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import id_text, materialise, schema_of
from tidewater.llm.tokens import public_path, tokenizer

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
OPEN_BINS = 4096
#: Pieces packed by one task; the number of tasks follows from the input.
TASK_PIECES = 250_000


def best_fit(lengths, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
    """``(bins, offsets)`` for pieces of 1..capacity tokens, in the given order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits, n_open, n_bins = 0, 0, 0
    for i, size in enumerate(lengths):
        fits = bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                bits ^= 1 << free
            n_open -= 1
        else:
            free, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - free
        free -= size
        if not free:
            continue
        if n_open == open_bins:  # the fullest closes
            low = (bits & -bits).bit_length() - 1
            if low > free:
                continue  # this bin is the fullest itself
            by_free[low].pop()
            if not by_free[low]:
                bits ^= 1 << low
            n_open -= 1
        by_free[free].append(b)
        bits |= 1 << free
        n_open += 1
    return bins, offsets


def best_fit_in_rounds(lengths: np.ndarray, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
    """``best_fit`` of lengths sorted longest first, dealt out one by one to rounds
    of at most ``open_bins`` pieces; results in the order of ``lengths``."""
    rounds = -(-len(lengths) // open_bins)
    order = np.argsort(np.arange(len(lengths)) % rounds, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins[order], offsets[order] = best_fit(lengths[order].tolist(), capacity, open_bins)
    return bins, offsets


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: documents cut into pieces.

    Ids are those of the tokenizers library, which adds no special tokens but knows
    their strings in a text, then ``end_id``. Only a longer document than ``capacity`` is cut; its first piece
    takes what the full ones after it leave.
    """
    path = vocabulary or public_path(VOCABULARY)
    rows = id_text(docs, id_col, text_col)
    schema = schema_of(id=rows.schema["id"].dataType, piece="int", start="bigint", length="bigint", ids_crc32="bigint")
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(tokenizer(path).encode(b.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                stop = (n - 1) % capacity + 1
                while at < n:
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(ids[4 * at:4 * stop]))
                    at, stop, k = stop, stop + capacity, k + 1
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ], schema.fieldNames())

    return rows.mapInArrow(pieces, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Pieces are dealt out evenly whatever their documents, some 250,000 to a
    task, and each task feeds them in rounds of mixed lengths to its own bins. A
    sequence id is the task's number and the bin's. Pieces of one length are dealt
    to the rounds in the order of id and piece.
    """
    table = materialise(pieces, "pieces")
    n_tasks = -(-table.count() // task_pieces) or 1
    schema = schema_of(**{f.name: f.dataType for f in table.schema}, sequence_id="bigint", offset="bigint")

    def packed(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        rows = list(batches)
        if not rows:
            return
        whole = pa.Table.from_batches(rows)
        bins, offsets = best_fit_in_rounds(whole.column("length").to_numpy(), capacity, open_bins)
        whole = whole.append_column("sequence_id", pa.array(bins + base))
        yield from whole.append_column("offset", pa.array(offsets)).to_batches(max_chunksize=50_000)

    return (table.repartition(n_tasks).sortWithinPartitions(F.desc("length"), "id", "piece", "ids_crc32")
            .mapInArrow(packed, schema))
