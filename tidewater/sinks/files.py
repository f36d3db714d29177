"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; null fields are left out of each object.

    The default mode fails if ``path`` exists, as a plain ``write.json`` does.
    """
    df.write.mode(mode).json(path)


# Rows that one task may sort and write as one file.
MAX_SINGLE_FILE_ROWS = 1_000_000


def write_sorted_single_file(
    df: DataFrame,
    path: str,
    sort_cols: list[Column | str],
    fmt: str = "json",
    mode: str = "errorifexists",
    drop_cols: list[str] | None = None,
    rows_bound: int | None = None,
    max_rows: int = MAX_SINGLE_FILE_ROWS,
    **options: str,
) -> None:
    """One ordered output file, or ordered part files beyond ``max_rows``.

    A result of at most ``max_rows`` rows is moved into one partition by a
    shuffle *after* the upstream work ran in parallel (a ``coalesce(1)`` would
    instead pull the upstream stage into one task) and sorted there. A larger
    one is range-partitioned: part files in name order hold the same order.
    ``rows_bound`` is what the caller knows the result cannot exceed; without it
    the rows are counted. ``drop_cols`` are removed after sorting, so a helper
    sort column need not be written.
    """
    if rows_bound is None:
        rows_bound = df.count()
    if rows_bound <= max_rows:
        ordered = df.repartition(1).sortWithinPartitions(*sort_cols)
    else:
        ordered = df.orderBy(*sort_cols)
    if drop_cols:
        ordered = ordered.drop(*drop_cols)
    writer = ordered.write.mode(mode)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.format(fmt).save(path)
