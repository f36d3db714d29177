"""Periodic run detection by maximal pairs, and texts without the repeats.

Two equal stretches of words that differ in the word before and in the word after
are a maximal pair. If their distance q is at most their length, both together
have period q and no neighbouring word keeps it: the pair is a run, and every run
is such a pair at its smallest period. Pairs at a multiple of that period cover
the same stretch, so of equal stretches the smallest distance is the period.

Pairs come from the LCP-interval tree of the suffix array, walked bottom up. A
node keeps its positions in lists by the word to their left. When a child joins,
each position of the smaller side meets those positions of the other side that
have another left word and lie within the node's depth; these are the pairs. As
a run has ``min_words`` words or more, only nodes of half that depth count, and
only suffixes whose first words repeat in their document are sorted at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import id_text, raw_texts, schema_of

MIN_WORDS = 12
#: Words whose suffixes are sorted together, about; a longer text is sorted alone.
BATCH_WORDS = 1 << 17
#: Positions of a chunk of a sorted list, at most.
_CHUNK = 1024


class _Positions:
    """A sorted list of numbers in chunks, so that putting one in stays cheap."""

    __slots__ = ("chunks", "lows")

    def __init__(self, first: int):
        self.chunks, self.lows = [[first]], [first]

    def add(self, x: int) -> None:
        at = max(0, bisect_left(self.lows, x) - 1)
        chunk = self.chunks[at]
        insort(chunk, x)
        if len(chunk) > _CHUNK:
            self.chunks[at:at + 1] = chunk[:_CHUNK // 2], chunk[_CHUNK // 2:]
            self.lows.insert(at + 1, self.chunks[at + 1][0])
        self.lows[at] = self.chunks[at][0]

    def within(self, low: int, high: int):
        """Numbers from ``low`` to ``high``, both included."""
        at = max(0, bisect_left(self.lows, low) - 1)
        for chunk in self.chunks[at:]:
            for k in range(bisect_left(chunk, low), len(chunk)):
                if chunk[k] > high:
                    return
                yield chunk[k]

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk


class _Node:
    """Positions below a node of the interval tree, in lists by left word."""

    __slots__ = ("size", "classes", "every")

    def __init__(self, position: int, left: int):
        self.size, self.every = 1, _Positions(position)
        self.classes = {left: self.every}  # of one class, both lists are the same

    def pairs_with(self, position: int, left: int, depth: int):
        """Positions of another class within ``depth``; the fewer of all near ones
        and of the classes are looked through."""
        classes = self.classes
        if len(classes) == 1 and left in classes:
            return []
        near = []
        for other in self.every.within(position - depth, position + depth):
            near.append(other)
            if len(near) > 2 * len(classes):
                break
        else:
            return near
        return [x for word, found in classes.items() if word != left
                for x in found.within(position - depth, position + depth)]

    def take(self, other: _Node) -> None:
        if len(self.classes) == 1 and (len(other.classes) > 1 or next(iter(other.classes)) not in self.classes):
            (word, found), = self.classes.items()
            self.every = _copy(found)
        for word, found in other.classes.items():
            mine = self.classes.get(word)
            for x in found:
                if mine is None:
                    mine = self.classes[word] = _Positions(x)
                else:
                    mine.add(x)
                if mine is not self.every:
                    self.every.add(x)
        self.size += other.size


def _copy(found: _Positions) -> _Positions:
    out = _Positions(0)
    out.chunks, out.lows = [list(c) for c in found.chunks], list(found.lows)
    return out


def _ranks(key: np.ndarray) -> np.ndarray:
    """Ranks of keys: how many smaller ones there are; equal keys share theirs."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    out = np.empty(len(key), np.int64)
    out[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    return out


def _sorted_repeats(words: np.ndarray, doc: np.ndarray, real: np.ndarray, first: int):
    """Positions whose first ``first`` words occur again in their document, in the
    order of their suffixes, and their group by those words."""
    wide = int(words.max()) + 1
    rank, length = _ranks((doc * wide + words)), 1
    while length < first:
        # Of two overlapping stretches, so that exactly ``first`` words count in the end.
        step = min(length, first - length)
        later = np.concatenate([rank[step:], np.zeros(step, np.int64)])
        rank = _ranks(rank * len(rank) + later)
        length += step
    size = np.bincount(rank, minlength=len(rank))
    left = np.flatnonzero((size[rank] > 1) & real)
    left = left[np.argsort(rank[left], kind="stable")]
    every, group = left, rank[left].copy()
    while len(left):
        # Ranks are refined until no two suffixes share one; ``later`` of a real
        # position is never beyond the padding of its document.
        later = rank[np.minimum(left + length, len(rank) - 1)]
        order = np.lexsort((later, rank[left]))
        left, later = left[order], later[order]
        old = rank[left]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = new_old | np.concatenate([[True], later[1:] != later[:-1]])
        at = np.arange(len(left))
        start = np.maximum.accumulate(np.where(new_old, at, 0))
        inside = np.maximum.accumulate(np.where(new, at, 0))
        rank[left] = old + inside - start
        size = np.diff(np.append(np.flatnonzero(new), len(left)))
        left = left[np.repeat(size, size) > 1]
        length *= 2
    order = np.argsort(rank[every], kind="stable")
    return every[order], group[order]


def _common(words: list, order: list, group: list) -> list:
    """Words that a suffix shares with the one before it in its group (else 0)."""
    before = {}
    for k in range(1, len(order)):
        if group[k] == group[k - 1]:
            before[order[k]] = order[k - 1]
    shared, h, last = {}, 0, -2
    for p in sorted(before):  # in text order: one word fewer than the suffix before it, at least
        h = h - 1 if p == last + 1 and h else 0
        q = before[p]
        while words[p + h] == words[q + h]:
            h += 1
        shared[p], last = h, p
    return [shared.get(p, 0) for p in order]


def runs_of(texts: list[list], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of each list of words, by start and period.

    A run is a stretch with smallest period ``period``, of ``min_words`` words and
    twice its period at least, that no neighbouring word extends.
    """
    first = max(1, -(-min_words // 2))  # a run's pair has this length at least
    known: dict = {}
    number = known.setdefault
    ids, starts, at = [], [], 0
    for words in texts:
        starts.append(at)
        ids += [number(w, len(known) + 1) for w in words]
        ids += [0] * first  # padding: ends every stretch of the document
        at += len(words) + first
    out: list[dict] = [{} for _ in texts]
    words = np.array(ids, dtype=np.int64)
    if not len(words):
        return [[] for _ in texts]
    doc = np.repeat(np.arange(len(texts)), np.diff([*starts, at]))
    order, group = _sorted_repeats(words, doc, words > 0, first)
    if not len(order):
        return [[] for _ in texts]
    # Padding differs by document and place, so that no comparison runs over it.
    ids = np.where(words > 0, words, -1 - np.arange(len(words))).tolist()
    begin = np.array(starts)[doc[order]].tolist()
    number_of = doc[order].tolist()
    order, group = order.tolist(), group.tolist()
    shared = _common(ids, order, group)

    def found(a: int, b: int, depth: int, runs: dict, base: int) -> None:
        low, q = (a, b - a) if a < b else (b, a - b)
        if q <= depth and q + depth >= min_words:
            key = low - base, q + depth
            if runs.get(key, q) >= q:
                runs[key] = q

    k, n = 0, len(order)
    while k < n:
        end = k + 1
        while end < n and group[end] == group[k]:
            end += 1
        base, runs = begin[k], out[number_of[k]]
        stack: list = []  # open nodes as [depth, node]

        def join(at_depth, into, child):
            small, large = (child, into) if child.size <= into.size else (into, child)
            for left, positions in small.classes.items():
                for p in positions:
                    for x in large.pairs_with(p, left, at_depth):
                        if ids[x - 1] != ids[p - 1] or x == base or p == base:
                            found(p, x, at_depth, runs, base)
            large.take(small)
            return large

        for i in range(k, end):
            p = order[i]
            # At a document's start there is no left word: a class of its own.
            child = _Node(p, ids[p - 1] if p > base else 0)
            depth = shared[i + 1] if i + 1 < end else 0
            while stack and stack[-1][0] > depth:
                d, node = stack.pop()
                child = join(d, node, child)
            if stack and stack[-1][0] == depth:
                stack[-1][1] = join(depth, stack[-1][1], child)
            elif i + 1 < end:
                stack.append([depth, child])
        k = end
    return [sorted((s, length, q) for (s, length), q in runs.items()) for runs in out]


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that no run contains after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, n, runs, collapsed)`` per row of ``docs``.

    ``n`` counts the words, stretches without ASCII white space; ``runs`` are
    structs ``(start, length, period)`` by start, then period; ``collapsed`` holds
    the words that no run contains after its first period, joined by one blank. A
    null text counts as empty: no words, no runs, an empty text. Every row is
    looked at alone, also rows that repeat an id or have none.
    """
    rows = id_text(docs, id_col, text_col)
    schema = schema_of(id=rows.schema["id"].dataType, n="bigint",
                       runs="array<struct<start:bigint,length:bigint,period:bigint>>", collapsed="string")
    fields = [pa.field(x, pa.int64()) for x in ("start", "length", "period")]

    def answer(ids, texts):
        found = runs_of(texts, min_words)
        flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
        ends = np.cumsum([0, *[len(runs) for runs in found]])
        runs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=fields)
        kept = [b" ".join(kept_words(w, r)) for w, r in zip(texts, found)]
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(w) for w in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
            pa.array(kept, pa.binary()).cast(pa.string())], schema.fieldNames())

    def detect(batches):
        for b in batches:
            held, size, start = [], 0, 0
            for i, text in enumerate(raw_texts(b.column(1))):
                held.append(text.split())  # bytes: ASCII white space only
                size += len(held[-1])
                if size >= BATCH_WORDS:
                    yield answer(b.column(0).slice(start, i + 1 - start), held)
                    held, size, start = [], 0, i + 1
            if held:
                yield answer(b.column(0).slice(start), held)

    return rows.mapInArrow(detect, schema)
