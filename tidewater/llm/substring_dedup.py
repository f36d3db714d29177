"""Substring dedup by line hashing with original offsets.

A text is cut into units: lines, and within a line the sentences that end with
``.``, ``!`` or ``?`` and white space. A sentence of fewer than ``UNIT_WORDS``
words forms a unit with those after it, so that every longer sentence ends a unit
wherever its line began, and shouted words are no units. Inside a sentence a unit
also ends before each word with no smaller hash among the ``REACH`` words on
either side, so two copies of a passage share their inner units wherever their
sentences begin and end, and no such unit has fewer words than ``REACH``. A unit is
normalised (white space runs
become one blank, A-Z lower-cased, other ASCII marks dropped) and hashed. Equal
digests are grouped over all documents; the earliest occurrence by document id
and position stays. Later occurrences are removed where they stand in a run of
such units with ``MIN_WORDS`` words or more, so a repeated passage goes wherever
it stands in a line, and a short sentence that recurs by chance stays.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import column, fresh_names, id_text, materialise, schema_of

MIN_WORDS = 20
UNIT_WORDS = 4
#: Words on either side that decide whether a word begins a unit.
REACH = 4
_CACHE_WORDS = 400_000
_SENTENCE = re.compile(rb"[^\n]*?(?:[.!?]+(?=[ \t\r\x0b\x0c])|\n|\Z)", re.S)
_MARKS = bytes(b if b >= 128 or chr(b).isalnum() or b in b" \t\n\r\x0b\x0c" else 32 for b in range(256))


_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


class _Ranks(dict):
    """Hashes of the words met so far."""

    def __missing__(self, word):
        if len(self) > _CACHE_WORDS:
            self.clear()
        rank = self[word] = xxhash.xxh3_64_intdigest(word)
        return rank


_ranks = _Ranks()


def inner_starts(found: list[bytes]) -> list[int]:
    """The words of a sentence that begin a unit: no smaller hash among the
    ``REACH`` words on either side. Of equal hashes those ``REACH`` apart count, so
    a word or phrase said over and over is cut into equal units."""
    ranks = [_ranks[w] for w in found] if len(found) > 2 * REACH else []
    out, i = [], REACH
    while i < len(ranks) - REACH:
        near = ranks[i - REACH:i + REACH + 1]
        least = min(near)
        if near[REACH] == least:
            out.append(i)
            i += REACH
        elif least in near[REACH + 1:]:
            i += near.index(least, REACH + 1) - REACH
        else:  # no word nearer than this can be a least one
            i += near.index(least) + 1
    return out


def units(text: bytes) -> list[tuple[int, int, list[bytes]]]:
    """Byte spans and words of the units of a text; together they cover it."""
    out, start, held = [], 0, []
    for m in _SENTENCE.finditer(text):
        end = m.end()
        if end == m.start():
            continue
        found, used = normal(text[m.start():end]), 0
        inner = inner_starts(found)
        if inner:
            places = [w.start() for w in _WORD.finditer(text[m.start():end].lower().translate(_MARKS))]
            for k in inner:
                cut = m.start() + places[k]
                out.append((start, cut, held + found[used:k]))
                start, held, used = cut, [], k
        held += found[used:]
        if len(held) >= UNIT_WORDS or text[end - 1] == 10 or end == len(text):
            out.append((start, end, held))
            start, held = end, []
    return out


def normal(unit: bytes) -> list[bytes]:
    """The words of a unit, without ASCII marks, A-Z lower-cased."""
    return unit.lower().translate(_MARKS).split()


def unit_digests(rows: DataFrame) -> DataFrame:
    """``(id, pos, hi, lo)`` for every unit with words; ``pos`` counts all units."""
    schema = schema_of(id=rows.schema["id"].dataType, row="bigint", pos="int", hi="bigint", lo="bigint")

    def hashed(batches):
        for b in batches:
            row, pos, digests = [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                text = text.encode()
                for k, (_, _, found) in enumerate(units(text)):
                    if found:
                        row.append(i)
                        pos.append(k)
                        digests.append(xxhash.xxh3_128_digest(b" ".join(found)))
                if len(row) > 500_000 or i == b.num_rows - 1:
                    table = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                    take = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(take), b.column(2).take(take), pa.array(pos, pa.int32()),
                        pa.array(table[:, 0]), pa.array(table[:, 1])], schema.fieldNames())
                    row, pos, digests = [], [], []

    return rows.select("id", "text", "row").mapInArrow(hashed, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the kept text, and ``removed`` (a new name if taken).

    ``removed`` holds ``(start, end, first_id)`` per removed run: character
    offsets in the original text, and the id of the document with the earliest
    occurrence of the run's first unit. Documents rank by id (none first), rows
    that share an id by the hash of their text, and whole copies among those are
    one document: each of them keeps what the first keeps. A null or empty text
    has no units and comes back empty. Every row comes back with all columns.
    """
    row, gone, key, mark = fresh_names(docs, "text_hash", "removed", "unit_doc", "unit_row")
    base = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    found = materialise(unit_digests(base), "units")
    first = F.min(F.struct("id", "row", "pos")).alias("first")
    # A digest of many documents is one row a task before the shuffle. As a table
    # of its own the result joins by plain shuffles, of which Spark splits a hot one.
    repeated = materialise(
        found.groupBy("hi", "lo").agg(first, F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    here = F.struct("id", "row", "pos")
    later = (found.join(repeated, ["hi", "lo"]).where(~here.eqNullSafe(F.col("first")))
             .select("id", "row", "pos", F.col("first.id").alias("first_id")).distinct())
    per_doc = later.groupBy("id", "row").agg(F.collect_list(F.struct("pos", "first_id")).alias(gone))  # its own units
    per_doc = per_doc.select(F.col("id").alias(key), F.col("row").alias(mark), gone)
    hashed = docs.withColumn(row, F.xxhash64(F.coalesce(column(docs, text_col).cast("string"), F.lit(""))))
    joined = hashed.join(per_doc, column(hashed, id_col).eqNullSafe(F.col(key))
                         & (F.col(row) == F.col(mark)), "left").drop(key, mark, row)
    text_at, gone_at = joined.columns.index(text_col), joined.columns.index(gone)
    id_kind = docs.schema[id_col].dataType
    schema = docs.select(*[column(docs, c).cast("string").alias(c) if c == text_col else column(docs, c)
                           for c in docs.columns]).schema
    spans = schema_of(start="int", end="int", first_id=id_kind)
    schema = schema.add(gone, schema_of(x=f"array<{spans.simpleString()}>")[0].dataType)

    def kept(batches):
        for b in batches:
            texts, removed = [], []
            for text, marks in zip(b.column(text_at).to_pylist(), b.column(gone_at).to_pylist()):
                out, runs = cut_runs((text or "").encode(), {m["pos"]: m["first_id"] for m in marks or ()}, min_words)
                texts.append(out)
                removed.append(runs)
            cols = list(b.columns)
            cols[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            id_type = b.schema.field(gone_at).type.value_type.field("first_id").type
            cols[gone_at] = pa.array(removed, pa.list_(pa.struct([
                ("start", pa.int32()), ("end", pa.int32()), ("first_id", id_type)])))
            yield pa.RecordBatch.from_arrays(cols, schema.fieldNames())

    return joined.mapInArrow(kept, schema)


def cut_runs(text: bytes, repeats: dict, min_words: int):
    """The text without runs of repeated units, and these runs as ``(start, end,
    first_id)`` in characters. Units without words belong to the run around them."""
    if not repeats:
        return text, []
    spans, runs, run = units(text), [], None
    for k, (s, e, found) in enumerate(spans):
        n = len(found)
        if k in repeats:
            if run is None:
                run = [s, e, repeats[k], 0]
            run[1] = e
            run[3] += n
        elif n and run is not None:
            runs.append(run)
            run = None
    if run is not None:
        runs.append(run)
    out, places, at, chars = [], [], 0, 0
    for s, e, first_id, n in runs:
        if n >= min_words:
            chars += len(text[at:s].decode())
            size = len(text[s:e].decode())
            places.append({"start": chars, "end": chars + size, "first_id": first_id})
            out.append(text[at:s])
            at, chars = e, chars + size
    return b"".join([*out, text[at:]]), places
