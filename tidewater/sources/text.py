"""Plain text files, one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as a ``value`` column.

    ``\\n``, ``\\r\\n`` and ``\\r`` all end a line. Files are split across tasks
    by size, so a single large file is still read in parallel.
    """
    return spark.read.text(path)


def read_lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Lines with columns that sort them in file order: ``(file, block, row)``.

    Files are split across tasks and Spark packs splits into partitions by
    size, not by position, so partition order is not file order. A line's
    file, the start offset of its split and its increasing id within the task
    do sort lines exactly as a sequential reader would see them.
    """
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
