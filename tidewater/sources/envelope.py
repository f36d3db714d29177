"""The keyed-message envelope of a stream source.

A Kafka source yields these seven columns; only ``value`` is read by the word
count. Where no broker is available the same envelope is read as a file stream,
so the downstream plan is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ENVELOPE_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
        StructField("timestampType", IntegerType(), True),
    ]
)


def read_envelope_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Streaming frame over envelope files landing in ``path``."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def decode_value(envelope: DataFrame) -> DataFrame:
    """``CAST(value AS STRING)``; invalid UTF-8 becomes U+FFFD, no error."""
    return envelope.selectExpr("CAST(value AS STRING) AS value")
