"""Block search: members of a block stay in memory, queries stream past them.

Rows carry a block number; ``kind`` 0 marks the block's members, 1 the queries
sent to it. A block's members are bounded by construction (a large cell is cut
into several blocks and each query goes to all of them), so memory is bounded
however large a cell is, and the blocks of a hot cell run as separate tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Above this, several blocks share a task.
MAX_TASKS = 20_000


def search_blocks(rows: DataFrame, n_blocks: int, make_index: Callable, schema) -> DataFrame:
    """Search each block of ``rows`` (columns ``block, kind, ...``).

    ``make_index(batches)`` gets the members of one block as Arrow batches and
    returns an object with ``own()`` (links among members), ``links(batch)``
    (links of queries) and ``close()``; each yields Arrow batches.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, index = None, [], None
        for b in batches:
            block, kind = (np.asarray(b.column(i).to_numpy()) for i in (0, 1))
            edge = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(block)]):
                if s == e:
                    continue
                if block[s] != now:
                    yield from _finish(members, index, make_index)
                    now, members, index = block[s], [], None
                if kind[s] == 0:
                    members.append(b.slice(s, e - s))
                elif members:
                    if index is None:
                        index = make_index(members)
                        yield from index.own()
                    yield from index.links(b.slice(s, e - s))
        yield from _finish(members, index, make_index)

    n = max(1, min(n_blocks, MAX_TASKS))
    return (rows.repartitionById(n, (F.col("block") % n).cast("int"))
            .sortWithinPartitions("block", "kind").mapInArrow(search, schema))


def _finish(members, index, make_index):
    if not members:
        return
    if index is None:
        index = make_index(members)
        yield from index.own()
    yield from index.close()


def dense_star(linked: np.ndarray):
    """Few links with the components of a boolean (queries x members) matrix.

    Returns ``(rows, members_of_rows, members, members_of_members)``: positions
    of linked queries with one member of their component, and of members with
    that member.
    """
    rows, cols = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    sub = linked[np.ix_(rows, cols)]
    label, far = np.arange(len(cols)), len(cols)
    while len(cols):
        of_row = np.where(sub, label, far).min(1)
        new = np.minimum(label, np.where(sub, of_row[:, None], far).min(0))
        new = new[new]
        if np.array_equal(new, label):
            return rows, cols[of_row], cols, cols[label]
        label = new
    return rows, rows, cols, cols
