"""The first ``n`` rows in key order, without a single oversized merge task.

``orderBy(...).limit(n)`` plans as a per-task top-``n`` followed by one task
that merges every task's top-``n``: ``partitions x n`` rows. That is fine for a
preview, but for a large ``n`` over a large input it funnels billions of rows
into one task. ``first_rows`` keeps that plan only for an ``n`` of a preview's
size. Past that it selects the ``n``-th key by refining histograms:

1. the keys in an interval that holds the ``n``-th one (at first all keys) are
   cut by bounds drawn from them, at most ``BUCKETS``;
2. one aggregation counts the rows of each bound and between the bounds; where the
   ``n``-th one lies is the next interval;
3. when that is between two bounds and holds few enough rows, everything before it
   is taken by a filter and only its own rows are merged; when it is a bound, its
   rows are ties, and their first ones are told apart by numbers that prefix sums
   over the tasks give, so nothing is merged.

An interval shrinks by about ``BUCKETS`` a round, whatever the input size, the skew
of the leading key and the number of ties: a hot key is soon a bound of its own. The
result is exact; some hundred keys come to the driver a round. Nulls sort first. A
filter's leading column goes on its own too, so that the scan can prune row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this n every task's top-n goes straight into the final merge.
PLAIN_ROWS = 1_000
# Bounds drawn from the keys of an interval.
BUCKETS = 32
# Rows that the final merge sorts in one task, at most.
MERGE_ROWS = 100_000


def first_rows(
    df: DataFrame,
    order_cols: list[str] | tuple[str, ...],
    n: int,
    plain_rows: int = PLAIN_ROWS,
    merge_rows: int = MERGE_ROWS,
) -> DataFrame:
    """Exactly the first ``n`` rows of ``df`` ordered by ``order_cols``
    (ascending), or all rows if fewer. Of rows with equal keys any may be taken.
    The result is not ordered; sort it afterwards if needed."""
    if n < 0:
        raise ValueError("n must be >= 0")
    cols = list(order_cols)
    order = [F.col(c).asc() for c in cols]
    if n <= plain_rows:
        return df.orderBy(*order).limit(n)
    low, high, before, inside = None, None, 0, df.count()
    if inside <= n:
        return df
    while inside > merge_rows:
        bounds = _bounds(_between(df, cols, low, high), cols, inside)
        counts = _histogram(_between(df, cols, low, high), cols, bounds)
        at = 0
        while before + counts[at] < n:
            before += counts[at]
            at += 1
        if at % 2:  # a bound: the rows before it, and as many of its ties as are missing
            tied = bounds[at // 2]
            return df.filter(_less(df, cols, tied)).unionByName(_first_of_ties(df.filter(_is(df, cols, tied)), n - before))
        low, high, inside = (bounds[at // 2 - 1] if at else low), (bounds[at // 2] if at // 2 < len(bounds) else high), counts[at]
    rest = _between(df, cols, low, high).orderBy(*order).limit(n - before)
    return rest if low is None else df.filter(_less(df, cols, low, or_equal=True)).unionByName(rest)


def _typed(df: DataFrame, cols: list[str], key: tuple) -> list[Column]:
    return [F.lit(v).cast(df.schema[c].dataType) for c, v in zip(cols, key)]


def _key(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def _is(df: DataFrame, cols: list[str], key: tuple) -> Column:
    same = F.lit(True)
    for c, v in zip(cols, _typed(df, cols, key)):
        same = same & F.col(c).eqNullSafe(v)
    return same


def _less(df: DataFrame, cols: list[str], bound: tuple, or_equal: bool = False) -> Column:
    """``(cols) < bound`` in lexicographic order (a struct comparison, exact,
    nulls smallest), plus the same for ``cols[0]`` on its own so the scan can
    use it."""
    typed = _typed(df, cols, bound)
    lead = F.col(cols[0]).isNull()
    if bound[0] is not None:
        lead = lead | (F.col(cols[0]) <= typed[0])
    return lead & (_key(cols) <= F.struct(*typed) if or_equal else _key(cols) < F.struct(*typed))


def _more(df: DataFrame, cols: list[str], bound: tuple) -> Column:
    typed = _typed(df, cols, bound)
    lead = F.lit(True) if bound[0] is None else F.col(cols[0]) >= typed[0]
    return lead & (_key(cols) > F.struct(*typed))


def _between(df: DataFrame, cols: list[str], low: tuple | None, high: tuple | None) -> DataFrame:
    """Rows with ``low < key < high``; None is no bound."""
    if low is not None:
        df = df.filter(_more(df, cols, low))
    return df if high is None else df.filter(_less(df, cols, high))


def _bounds(rows: DataFrame, cols: list[str], n: int) -> list[tuple]:
    """Distinct keys in order, at most ``BUCKETS``, that cut ``rows`` about evenly.

    They are drawn from the rows whose hash is least, a sample that comes out the
    same when it is drawn again; a few hundred keys come to the driver.
    """
    grain, wanted = 1 << 40, 16 * BUCKETS
    drawn = F.pmod(F.xxhash64(*cols, F.monotonically_increasing_id()), F.lit(grain))
    sample = rows.select(*cols, drawn.alias("__draw")).filter(F.col("__draw") <= wanted * 2 * grain // n)
    keys = sample.orderBy("__draw").limit(wanted).drop("__draw")
    found = [tuple(r) for r in keys.orderBy(*[F.col(c).asc() for c in cols]).collect()]
    step = -(-len(found) // BUCKETS)
    return list(dict.fromkeys(found[step // 2::step]))


def _histogram(rows: DataFrame, cols: list[str], bounds: list[tuple]) -> list[int]:
    """Rows before the first bound, at it, between it and the second, and so on."""
    bucket = F.when(F.lit(False), 0)
    for i, bound in enumerate(bounds):
        typed = F.struct(*_typed(rows, cols, bound))
        bucket = bucket.when(_key(cols) < typed, 2 * i).when(_is(rows, cols, bound), 2 * i + 1)
    counts = dict(rows.groupBy(bucket.otherwise(2 * len(bounds)).alias("bucket")).count().collect())
    return [counts.get(i, 0) for i in range(2 * len(bounds) + 1)]


def _first_of_ties(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of rows that all have one key: numbers within a task come from its
    increasing ids, and a task's start from the counts of those before it."""
    part, place = "__part", "__place"
    numbered = rows.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id())
    starts = numbered.groupBy(part).agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    starts = starts.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    met = numbered.join(starts, part)
    return met.filter(F.col(place) - F.col("__first") + F.col("__start") < n).select(*rows.columns)


def spread_bounded(df: DataFrame, rows_bound: int, partitions: int | None = None) -> DataFrame:
    """Round-robin a result known to hold at most ``rows_bound`` rows (such as
    a top-n) so that work generated from it runs on all task slots."""
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    if rows_bound <= 1 or target <= 1:
        return df
    return df.repartition(target)
