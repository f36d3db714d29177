"""Fill-in-middle transformation: two cuts of a text found in an indexable skip list.

A text is a sequence of units (white space and the word after it, or white space
at the end). Its skip list has one node a unit; every lane's link carries how
many units it passes, and how many code points and UTF-8 bytes they hold. A
search for a rank goes along the highest lane while the units passed do not
exceed the rank, then down a lane, adding the widths on its way: it ends with the
number of units, code points and bytes before the cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidewater.llm.common import id_text, raw_texts, schema_of, splitmix

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: One node in this many goes on to the next lane.
LANE_STEP = 8


def unit_ends(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of a UTF-8 text, in bytes and in code points."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    ends = np.append(ends, len(raw))  # the last unit is a word, or white space alone
    if text.isascii():
        return ends, ends
    points = np.cumsum((raw & 0xC0) != 0x80)
    return ends, points[ends - 1]


class SkipList:
    """An indexable skip list over units.

    ``lanes[k]`` holds a lane's links in order as ``(units, chars, bytes, down)``:
    the widths that a link passes, and the number of the link below that starts at
    the same node. Link 0 of a lane starts at the head. A node's height is drawn
    from a hash of its number, so a list is the same wherever it is built.
    """

    def __init__(self, char_ends: np.ndarray, byte_ends: np.ndarray, step: int = LANE_STEP):
        nodes = np.arange(1, len(char_ends) + 1)  # node i ends unit i; 0 is the head
        chars, size = (np.concatenate([[0], x]) for x in (char_ends, byte_ends))
        self.units = len(nodes)
        self.lanes: list[tuple] = []
        draw, below = splitmix(nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), None
        level = nodes
        while True:
            stops = np.concatenate([[0], level])
            down = np.zeros(len(stops), np.int64) if below is None else np.searchsorted(below, stops)
            self.lanes.append((np.diff(stops), np.diff(chars[stops]), np.diff(size[stops]), down))
            below = stops
            level = level[draw[level - 1] % np.uint64(step ** len(self.lanes)) == 0]
            if not len(level):
                break

    def seek(self, rank: int) -> tuple[int, int]:
        """Code points and bytes of the first ``rank`` units."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        units = chars = size = link = 0
        for w_units, w_chars, w_bytes, down in reversed(self.lanes):
            while link < len(w_units) and units + w_units[link] <= rank:
                units += w_units[link]
                chars += w_chars[link]
                size += w_bytes[link]
                link += 1
            if units == rank:
                break
            link = down[link]
        return int(chars), int(size)


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """The four numbers that decide on a document; no id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(text: bytes, doc_id, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> tuple:
    """``(n_units, form, prefix_chars, middle_chars, output)`` of a UTF-8 text."""
    byte_ends, char_ends = unit_ends(text)
    n = len(byte_ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= fim_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(char_ends, byte_ends)
    (c1, b1), (c2, b2) = (units.seek(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:b1], text[b1:b2], text[b2:]
    if h4 % 100 < spm_percent:
        return n, "spm", c1, c2 - c1, b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return n, "psm", c1, c2 - c1, b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])


def restore(output: bytes, form: str) -> bytes:
    """The text of an output. No marker is in the text and none overlaps itself or
    another, so the first of each kind after the one before is the one put in."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError("the output does not start with its marker")
    at = output.index(second, len(first))
    end = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first):at], output[at + len(second):end], output[end + len(MIDDLE):]
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` per row of ``docs``.

    Whole texts are cut; a null text counts as empty. An empty text, and one that
    holds a marker, stays plain. Rows that repeat an id are cut by the same draws,
    each over its own units; a row without an id is cut by the draws of no digits.
    """
    rows = id_text(docs, id_col, text_col)
    schema = schema_of(id=rows.schema["id"].dataType, n="bigint", form="string", prefix_chars="bigint",
                       middle_chars="bigint", output="string")

    def cut(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [transform(t, i, seed, fim_percent, spm_percent)
                         for i, t in zip(part.column(0).to_pylist(), raw_texts(part.column(1)))]
                n, form, prefix, middle, output = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    schema.fieldNames())

    return rows.mapInArrow(cut, schema)


def restore_texts(cut: DataFrame) -> DataFrame:
    """``cut`` (with ``form`` and ``output``) and the column ``restored``."""
    schema = T.StructType([*cut.schema, T.StructField("restored", T.StringType())])
    form, output = cut.columns.index("form"), cut.columns.index("output")

    def rebuilt(batches):
        for b in batches:
            texts = [restore(o, f) for f, o in zip(b.column(form).to_pylist(), raw_texts(b.column(output)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                             schema.fieldNames())

    return cut.mapInArrow(rebuilt, schema)
