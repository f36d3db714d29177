"""Copy one database table to a new one, partitioned on both ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.sinks.jdbc import write_table
from tidewater.sources.jdbc import qualified_name, read_table


def copy_table(
    spark: SparkSession,
    conn: dict[str, str],
    schema: str | None,
    from_table: str,
    to_table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
    target_conn: dict[str, str] | None = None,
    mode: str = "errorifexists",
    before_write: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Read ``schema.from_table`` and create ``schema.to_table`` from it.

    The read is split into ``num_partitions`` ranges of ``partition_column``
    (bounds asked from the database); each task inserts its range in batches.
    The target must not exist (``mode="errorifexists"``). ``before_write``
    gets the source frame first (a preview). Returns the source frame.
    """
    source = read_table(
        spark,
        conn,
        qualified_name(schema, from_table),
        partition_column=partition_column,
        num_partitions=num_partitions,
    )
    if before_write is not None:
        before_write(source)
    write_table(
        source,
        target_conn or conn,
        qualified_name(schema, to_table),
        mode=mode,
        batch_size=batch_size,
        num_partitions=num_partitions,
    )
    return source
