"""Reading what a stopped or running query keeps in its checkpoint.

Spark's ``statestore`` and ``state-metadata`` sources read a checkpoint as tables:
nothing is replayed and the query is not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``(START_TIME, END_TIME, WORD, COUNT)`` that a counting query holds in state.

    With a watermark these are the windows that have not closed; append mode has
    emitted none of them, and they go on counting when the query is started
    again. ``batch_id`` reads the state after an earlier batch that the checkpoint
    still retains; by default the last one.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    state = reader.load(checkpoint)
    window, word = state.schema["key"].dataType.fieldNames()
    return state.select(
        F.col("key")[window]["start"].alias("START_TIME"), F.col("key")[window]["end"].alias("END_TIME"),
        F.col("key")[word].alias("WORD"), F.col("value.count").alias("COUNT"))


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row a state store: its operator, partitions, and first and last batch
    that the checkpoint retains."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")
