"""Driver tables and the stand-ins built from them.

The jobs were written for flight CSVs, a warehouse table, a Kafka topic and a
text file. The test tables stand in for them:

* fact: ``lineitem``; key ``l_suppkey``, null on line 7 and without a match
  where it ends in 3; delay = ``int(l_quantity) - 25``, null when
  ``l_returnflag = 'N'``
* dimension: ``supplier``, whole; keys that end in 5 are there twice
* stream envelope: one record per ``events`` row, value =
  ``"<ISO ts, 6 fraction digits> <event_type> <props>"``; of five records one
  ends with blanks and one holds a double blank, and of fifty one is blank
* corpus: ``documents.text`` lines in ``(doc_id, line_no)`` order; every
  seventh document ends with lines without words
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.messages import iso_micros, utf8_bytes
from tidewater.operators.layout import spread
from tidewater.sources.envelope import ENVELOPE_SCHEMA

# Fixed stand-in parameters.
DELAY_OFFSET = 25
KEYLESS_LINE = 7
UNMATCHED_OFFSET = 1_000_000
CANCELLED_FLAG = "N"
ENVELOPE_TOPIC = "events"
ENVELOPE_PARTITIONS = 8
REPLAY_BASE_TIME = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


def delay_expr() -> F.Column:
    return F.when(F.col("l_returnflag") == F.lit(CANCELLED_FLAG), F.lit(None)).otherwise(
        F.col("l_quantity").cast("int") - F.lit(DELAY_OFFSET)
    )


def fact_key() -> F.Column:
    key = F.col("l_suppkey")
    return (
        F.when(F.col("l_linenumber") == F.lit(KEYLESS_LINE), F.lit(None))
        .when(key % 10 == 3, key + F.lit(UNMATCHED_OFFSET))
        .otherwise(key)
    )


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(AIRLINE, ARRIVAL_DELAY)`` from lineitem, plus its unique row key."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fact_key().alias("AIRLINE"),
        delay_expr().alias("ARRIVAL_DELAY"),
    )


def dimension_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(IATA_CODE, AIRLINE)`` from supplier, some keys twice."""
    times = F.when(F.col("s_suppkey") % 10 == 5, F.lit(2)).otherwise(F.lit(1))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("IATA_CODE"), F.col("s_name").alias("AIRLINE"),
        F.explode(F.sequence(F.lit(1), times)).alias("_copy"),
    ).drop("_copy")


def events_value() -> F.Column:
    iso, kind, props, number = iso_micros("ts"), F.col("event_type"), F.col("props"), F.col("event_id")
    return (
        F.when(number % 50 == 7, F.concat(iso, F.lit("   ")))
        .when(number % 5 == 1, F.concat_ws(" ", iso, kind, props, F.lit(" ")))
        .when(number % 5 == 2, F.concat_ws(" ", iso, kind, F.lit(""), props))
        .otherwise(F.concat_ws(" ", iso, kind, props))
    )


def events_envelope(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The stream envelope of ``events`` (key = ISO time, value = record)."""
    events = events if events is not None else table(spark, sf_dir, "events", True)
    iso = iso_micros("ts")
    env = events.select(
        utf8_bytes(iso).alias("key"),
        utf8_bytes(events_value()).alias("value"),
        F.lit(ENVELOPE_TOPIC).alias("topic"),
        F.pmod(F.xxhash64("event_id"), F.lit(ENVELOPE_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return env.select(*[F.col(f.name).cast(f.dataType) for f in ENVELOPE_SCHEMA.fields])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    wordless = F.concat(F.col("text"), F.lit("\n --- \n\n"))
    text = F.when(F.col("doc_id") % 7 == 0, wordless).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents", True).select("doc_id", text.alias("text"))
