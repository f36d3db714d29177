"""Event-time window counts over (timestamp, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's window (size = slide = 1 minute) and its
# output column names.
WINDOW_SIZE = "1 minute"
OUTPUT_COLUMNS = ("START_TIME", "END_TIME", "WORD", "COUNT")


def windowed_counts(
    words: DataFrame,
    ts_col: str = "timestamp",
    value_col: str = "value",
    size: str = WINDOW_SIZE,
    slide: str | None = None,
    wall_clock: bool = False,
) -> DataFrame:
    """``(START_TIME, END_TIME, WORD, COUNT)`` per window and value.

    Tumbling when ``slide`` is omitted; a shorter slide gives sliding windows.
    The count is planned as a partial aggregation before the shuffle, so a hot
    value (one word in every record) costs one row per task, not one per word.
    ``wall_clock=True`` returns window bounds as TIMESTAMP_NTZ in the session
    time zone (for comparisons with zone-less engines).
    """
    window = F.window(F.col(ts_col), size, slide or size)
    counts = words.groupBy(window.alias("window"), F.col(value_col).alias("WORD")).agg(
        F.count(F.lit(1)).alias("COUNT")
    )
    time_type = "timestamp_ntz" if wall_clock else "timestamp"
    return counts.select(
        F.col("window.start").cast(time_type).alias("START_TIME"),
        F.col("window.end").cast(time_type).alias("END_TIME"),
        F.col("WORD"),
        F.col("COUNT").cast("long").alias("COUNT"),
    )
