"""Database table sink over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    conn: dict[str, str],
    table: str,
    mode: str = "errorifexists",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    isolation_level: str | None = None,
) -> None:
    """Create ``table`` and insert the rows; fails if the table exists.

    Every task writes its partition through its own connection in batches;
    ``num_partitions`` caps the number of concurrent connections.
    """
    writer = (
        df.write.format("jdbc")
        .options(**conn)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .mode(mode)
    )
    if num_partitions is not None:
        writer = writer.option("numPartitions", str(num_partitions))
    if isolation_level is not None:
        writer = writer.option("isolationLevel", isolation_level)
    writer.save()
