"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def input_bytes(df: DataFrame) -> int:
    """The size that Spark knows for ``df`` before running it: for files, their
    bytes; for sources without a known size, a huge number. Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rows read from fewer files than there are task slots.

    A file written as one row group is read by one task however the file is
    split, which serialises CPU-heavy row work (regex parsing, tokenising).
    When the input has fewer files than ``min_partitions`` (default: the
    cluster's parallelism) its rows are redistributed; a large input spans
    many files and row groups, so it is left as it is and nothing extra is
    shuffled.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    return df.repartition(target)
