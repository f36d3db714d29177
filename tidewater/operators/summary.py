"""Fact-by-dimension summary: per dimension name, how many facts and their
average measure, as formatted text, ordered by the numeric average.

Semantics (kept from the reference job):

* the fact is the left side: facts whose key has no dimension row, and facts
  with a null key, fall into the null-name group;
* the count is ``count(fact_key)``: a null key is in the null-name group but is
  not counted, though its measure still enters the average;
* a duplicated dimension key multiplies its facts; names with no facts vanish;
* the average ignores null measures; the ordering is ascending on the numeric
  average with nulls first; the text keeps two decimals (half-even).

Three plans compute the same rows:

``auto``    aggregate the fact by key first (sum, non-null count, key count),
            join the per-key rows to the dimension and re-aggregate by name.
            The big side shrinks to one row per key before any join, and a key
            holding a third of all rows costs one partial row per task. The
            per-key rows are already partitioned by key, so the join hashes the
            dimension partition by partition: nothing is broadcast, so nothing
            has to be measured first, whatever the dimension's size.
``preagg``  the same with a sort-merge join, which also spills its input.
``direct``  broadcast the dimension into the fact scan, then a partial/final
            aggregation by name: one shuffle fewer for facts whose keys hardly
            repeat. The dimension is measured first (one small job); beyond the
            bound the plan is ``preagg``.

All are exact for integral measures (sums are carried in 64-bit integers); the
tests check they agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.numbers import format_2dp
from tidewater.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast
from tidewater.operators.layout import input_bytes

# Output column names of the summary (fixed values of the reference's output).
NAME_COL = "AIRLINE_NAME"
COUNT_COL = "FLIGHTS_COUNT"
AVG_TEXT_COL = "AVG_ARRIVAL_DELAY_MINUTES"
AVG_COL = "AVG_ARRIVAL_DELAY"

# Up to this size of the dimension's files the result is sorted in one task.
ONE_PARTITION_BYTES = 8 * 1024 * 1024

STRATEGIES = ("auto", "direct", "preagg")


def summary_aggregate(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    measure: str,
    dim_key: str,
    dim_name: str,
    strategy: str = "auto",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``(NAME_COL, COUNT_COL, AVG_COL)`` with the numeric average."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    names = dim.select(F.col(dim_key).alias("_dim_key"), F.col(dim_name).alias(NAME_COL))
    if strategy == "direct" and fits_broadcast(names, max_broadcast_rows):
        facts = fact.select(F.col(fact_key).alias("_key"), F.col(measure).alias("_m"))
        joined = facts.join(F.broadcast(names), F.col("_key") == F.col("_dim_key"), "left")
        return joined.groupBy(NAME_COL).agg(
            F.count("_key").alias(COUNT_COL), F.avg("_m").alias(AVG_COL)
        )
    per_key = fact.groupBy(F.col(fact_key).alias("_key")).agg(
        F.count(fact_key).alias("_n"),
        F.sum(measure).alias("_s"),
        F.count(measure).alias("_c"),
    )
    right = names.hint("shuffle_hash" if strategy == "auto" else "shuffle_merge")
    joined = per_key.join(right, F.col("_key") == F.col("_dim_key"), "left")
    return joined.groupBy(NAME_COL).agg(
        F.sum("_n").alias(COUNT_COL),
        (F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))).cast("double").alias(AVG_COL),
    )


def dimension_summary(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    measure: str,
    dim_key: str,
    dim_name: str,
    strategy: str = "auto",
    ordered: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    output_names: tuple[str, str, str] = (NAME_COL, COUNT_COL, AVG_TEXT_COL),
) -> DataFrame:
    """``(NAME_COL, COUNT_COL, AVG_TEXT_COL)``, ascending by the numeric average.

    The result has one row per dimension name plus the null group. It is
    range-partitioned and sorted; where the dimension's files are small, so
    that the result is too, it is sorted in one partition instead, which saves
    the sampling of range bounds. ``ordered=False`` leaves ordering to the sink (see
    ``sinks.write_sorted_single_file``). ``output_names`` renames the three
    output columns.
    """
    agg = summary_aggregate(
        fact, dim, fact_key, measure, dim_key, dim_name, strategy, max_broadcast_rows
    ).withColumn(AVG_TEXT_COL, format_2dp(AVG_COL))
    if ordered:
        key = F.col(AVG_COL).asc_nulls_first()
        small = input_bytes(dim) <= ONE_PARTITION_BYTES
        agg = agg.repartition(1).sortWithinPartitions(key) if small else agg.orderBy(key)
    name, count, text = output_names
    return agg.select(
        F.col(NAME_COL).alias(name), F.col(COUNT_COL).alias(count),
        F.col(AVG_TEXT_COL).alias(text),
    )
