"""Windowed counts with a table of the rows that came too late.

Spark's state operator drops a row whose window has closed and only counts it in
its progress. Here a micro-batch is split first: rows whose window ends at or before
the watermark go to a side table as they are, all others are counted and added to
the result so far. Counted rows and late rows together are the input.

The watermark of a batch is the greatest time of all batches before it, less the
delay, as with a single watermark for late rows and for closing windows. Each batch
leaves its greatest time behind, so a batch that runs again splits the same way; the
side table of a batch is overwritten and its counts are published last, once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.windows import WINDOW_SIZE, windowed_counts
from tidewater.streaming.snapshots import _Folder, publish_batches, read_snapshot

COUNT_KEYS = ["START_TIME", "END_TIME", "WORD"]
LATE_SCHEMA = "timestamp timestamp, value string, watermark timestamp, batch_id bigint"


def _watermark(spark: SparkSession, path: str, batch_id: int, delay: str) -> dt.datetime | None:
    """The greatest time of the batches before, less the delay."""
    marks = _Folder(spark, f"{path}/marks")
    before = [int(n) for n in marks.names() if int(n) < batch_id and (marks / f"{n}/_SUCCESS").exists()]
    if not before:
        return None
    rows = spark.read.schema("top timestamp").json(f"{path}/marks/{max(before)}")
    row = rows.select((F.col("top") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()
    return row.mark if row else None


def split_batches(path: str, delay: str, window: str = WINDOW_SIZE):
    """A ``foreachBatch`` function over parsed words (``timestamp``, ``value``)."""
    publish = publish_batches(f"{path}/counts", COUNT_KEYS, ["COUNT"])

    def write(words: DataFrame, batch_id: int) -> None:
        spark = words.sparkSession
        mark = _watermark(spark, path, batch_id, delay)
        words = words.select("timestamp", "value").persist()
        try:
            late = F.lit(False)
            if mark is not None:
                late = F.coalesce(F.window("timestamp", window)["end"] <= F.lit(mark), F.lit(False))
            marked = words.withColumn("late", late)
            side = marked.where("late").select("timestamp", "value", F.lit(mark).cast("timestamp").alias("watermark"))
            side.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            top = words.agg(F.max("timestamp").alias("top"))
            if mark is not None:  # the greatest time so far
                so_far = F.lit(mark) + F.expr(f"INTERVAL {delay}")
                top = top.select(F.greatest("top", so_far).alias("top"))
            top.coalesce(1).write.mode("overwrite").json(f"{path}/marks/{batch_id}")
            publish(windowed_counts(marked.where("not late").drop("late"), size=window), batch_id)
        finally:
            words.unpersist()
        marks = _Folder(spark, f"{path}/marks")
        for old in marks.names():
            if int(old) < batch_id - 1:
                (marks / old).delete()

    return write


def start_split_counts(words: DataFrame, path: str, checkpoint: str, delay: str, window: str = WINDOW_SIZE,
                       trigger: str | None = None) -> StreamingQuery:
    """Count a stream of parsed words under ``path`` and keep its late rows."""
    writer = words.writeStream.foreachBatch(split_batches(path, delay, window)).option("checkpointLocation", checkpoint)
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_split_counts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(counts, late)``: the counts so far, and every late row with the watermark
    it was behind and its batch."""
    return read_snapshot(spark, f"{path}/counts"), spark.read.schema(LATE_SCHEMA).parquet(f"{path}/late")
