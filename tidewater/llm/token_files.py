"""Token-ID / binary output: per-document zstandard frames with a shared dictionary.

File format (a folder):

* ``dictionary/``: one row ``(dictionary, sha256, id_type)``; the dictionary is
  trained on pieces of the serialised ids of a bounded sample of documents.
* ``blocks/``: rows ``(part, block, first_id, last_id, n_docs, n_tokens,
  dictionary_sha256, index, payload)``. The payload holds one zstandard frame a
  document, one after the other. The index is a table of little-endian unsigned
  64-bit numbers, per document the frame's end in the payload and its number of
  ids; ``ids`` holds the document ids. A short document is read by its block's
  id range (pushed to the scan) and its own frame only.
* ``starts/``: rows ``(part, start)``: the ids of all parts before.

Documents lie in ascending id order over parts and blocks.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm.common import id_text, schema_of
from tidewater.llm.tokens import id_type, public_path, tokenizer

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: About this many documents are drawn for the dictionary and encoded whole; of
#: their ids, in pieces of ``PIECE_IDS``, it is trained on ``SAMPLE_PIECES`` at most.
SAMPLE_DOCS = 2_000
SAMPLE_PIECES = 2_000
PIECE_IDS = 2_048
DICTIONARY_BYTES = 64 * 1024
BLOCK_DOCS = 512
BLOCK_IDS = 1 << 20


def _encoded(texts, path, end_id):
    end = np.array([end_id], dtype="<u4").tobytes()
    return [np.frombuffer(ids + end, dtype="<u4") for ids in tokenizer(path).encode(texts)]


def train_dictionary(docs: DataFrame, path: str, end_id: int, width: str) -> bytes:
    """A dictionary from a bounded sample; empty if there are too few samples."""
    import zstandard

    total, grain = docs.count(), 1 << 40
    drawn = F.pmod(F.xxhash64(F.lit("dictionary"), "id", "text"), F.lit(grain)) < max(1, SAMPLE_DOCS * grain // max(1, total))

    def pieces(batches):
        for b in batches:
            ids = [x[at:at + PIECE_IDS].astype(width).tobytes()
                   for x in _encoded(b.column(1).to_pylist(), path, end_id) for at in range(0, len(x), PIECE_IDS)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    found = docs.where(drawn).mapInArrow(pieces, "ids binary")
    rows = [bytes(r.ids) for r in found.orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_PIECES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(rows), k=512, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too uniform samples
        return b""


def write_token_files(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode whole texts and write the token files under ``out``.

    Ids are those of the tokenizers library, which adds no special tokens but knows
    their strings in a text, then ``end_id``. Documents are range-partitioned by (id, text hash), so neither
    a hot source nor many rows of one id make a large partition; rows of one id
    are ordered by text. A null id sorts first. An empty table gives empty files.
    """
    import zstandard

    path = vocabulary or public_path(VOCABULARY)
    spark, rows = docs.sparkSession, id_text(docs, id_col, text_col)
    width = id_type(path)
    trained = train_dictionary(rows, path, end_id, width)
    sha = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(trained, sha, width)], "dictionary binary, sha256 string, id_type string") \
        .coalesce(1).write.parquet(f"{out}/dictionary")
    kind = rows.schema["id"].dataType
    schema = schema_of(part="int", block="int", first_id=kind, last_id=kind, n_docs="int", n_tokens="bigint",
                       dictionary_sha256="string", ids=f"array<{kind.simpleString()}>", index="binary",
                       payload="binary")

    def blocks(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        shared = zstandard.ZstdCompressionDict(trained) if trained else None
        press = zstandard.ZstdCompressor(level=3, dict_data=shared)
        held, counts, frames = [], [], []
        names = schema.fieldNames()

        def block():
            ends = np.cumsum([len(f) for f in frames], dtype="<u8")
            index = np.column_stack([ends, np.array(counts, dtype="<u8")]).astype("<u8").tobytes()
            ids = pa.array(held, type=id_arrow)
            known = ids.drop_null()  # documents without an id come first and are in no range
            first, last = (known[:1], known[-1:]) if len(known) else (ids[:1], ids[:1])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([n], pa.int32()), first, last,
                pa.array([len(held)], pa.int32()), pa.array([sum(counts)], pa.int64()), pa.array([sha]),
                pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), ids),
                pa.array([index], pa.binary()), pa.array([b"".join(frames)], pa.binary()),
            ], names)

        for b in batches:
            id_arrow = b.column(0).type
            for key, ids in zip(b.column(0).to_pylist(), _encoded(b.column(1).to_pylist(), path, end_id)):
                held.append(key)
                counts.append(len(ids))
                frames.append(press.compress(ids.astype(width).tobytes()))
                if len(held) >= BLOCK_DOCS or sum(counts) >= BLOCK_IDS:
                    yield block()
                    n += 1
                    held, counts, frames = [], [], []
        if held:
            yield block()

    spread = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("id"), spread).sortWithinPartitions("id", spread, "text")
    ordered.mapInArrow(blocks, schema).write.parquet(f"{out}/blocks")
    # One row a part comes to the driver, as many as the job had tasks.
    totals = (spark.read.parquet(f"{out}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .orderBy("part").collect())
    starts, at = [], 0
    for r in totals:
        starts.append((r.part, at))
        at += r.n
    spark.createDataFrame(starts, "part int, start bigint").coalesce(1).write.parquet(f"{out}/starts")


def _dictionary(spark: SparkSession, out: str):
    row = spark.read.parquet(f"{out}/dictionary").first()
    data = bytes(row.dictionary)
    if hashlib.sha256(data).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary of {out} does not have its hash")
    return data, row.sha256, row.id_type


def _decoder(data: bytes, sha: str, width: str):
    import zstandard

    shared = zstandard.ZstdCompressionDict(data) if data else None
    press = zstandard.ZstdDecompressor(dict_data=shared)

    def frames(block_sha, index, payload):
        if block_sha != sha:
            raise ValueError("a block was written with another dictionary")
        table = np.frombuffer(index, dtype="<u8").reshape(-1, 2)
        at = 0
        for end, n in table.tolist():
            ids = np.frombuffer(press.decompress(payload[at:end]), dtype=width)
            if len(ids) != n:
                raise ValueError("a frame does not hold the ids of its index")
            yield ids
            at = end

    return frames


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32, ids)`` per document, from the files.

    ``start`` counts the ids of all documents before, in file order.
    """
    data, sha, width = _dictionary(spark, out)
    blocks, starts = spark.read.parquet(f"{out}/blocks"), spark.read.parquet(f"{out}/starts")
    kind = blocks.schema["first_id"].dataType
    before = (
        blocks.select("part", "block", "n_tokens").join(F.broadcast(starts), "part")  # a row a part: bounded by the tasks
        .selectExpr("part", "block", "start + coalesce(sum(n_tokens) over (partition by part order by block "
                    "rows between unbounded preceding and 1 preceding), 0) as start")
    )
    schema = schema_of(id=kind, start="bigint", n_tokens="bigint", ids_crc32="bigint", ids="array<int>")

    def decode(batches):
        frames = _decoder(data, sha, width)
        for b in batches:
            for ids_of, index, payload, sha_of, start in zip(*(b.column(i) for i in range(5))):
                at, keys = start.as_py(), ids_of.values
                arrays = list(frames(sha_of.as_py(), index.as_py(), payload.as_py()))
                for s in cut_docs(arrays):
                    part = arrays[s]
                    n = [len(x) for x in part]
                    yield pa.RecordBatch.from_arrays([
                        keys[s.start:s.stop], pa.array(at + np.cumsum([0, *n[:-1]]), pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in part], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()),
                                                 pa.array(np.concatenate(part).astype("<i4"))),
                    ], schema.fieldNames())
                    at += sum(n)

    return (blocks.join(before, ["part", "block"])
            .select("ids", "index", "payload", "dictionary_sha256", "start").mapInArrow(decode, schema))


def cut_docs(arrays):
    from tidewater.llm.common import cut

    return list(cut(arrays, [len(a) for a in arrays], 1 << 20))


def read_document(spark: SparkSession, out: str, doc_id) -> list[list[int]]:
    """The ids of the documents with this id: its blocks by range, one frame each."""
    import zstandard

    data, sha, width = _dictionary(spark, out)
    shared = zstandard.ZstdCompressionDict(data) if data else None
    press = zstandard.ZstdDecompressor(dict_data=shared)
    found = []
    rows = (spark.read.parquet(f"{out}/blocks")
            .where((F.col("first_id") <= F.lit(doc_id)) & (F.col("last_id") >= F.lit(doc_id)))
            .orderBy("part", "block"))
    for r in rows.toLocalIterator():
        if r.dictionary_sha256 != sha:
            raise ValueError("a block was written with another dictionary")
        ends = np.frombuffer(bytes(r["index"]), dtype="<u8").reshape(-1, 2)[:, 0]
        for i, key in enumerate(r.ids):
            if key == doc_id:
                frame = bytes(r.payload)[int(ends[i - 1]) if i else 0:int(ends[i])]
                found.append(np.frombuffer(press.decompress(frame), dtype=width).tolist())
    return found
