"""Readers: CSV, JDBC, Kafka, text lines and the stream envelope."""

from tidewater.sources.csv import read_csv
from tidewater.sources.envelope import ENVELOPE_SCHEMA, read_envelope_stream
from tidewater.sources.jdbc import qualified_name, read_table
from tidewater.sources.kafka import kafka_source_options, read_kafka_stream
from tidewater.sources.text import read_lines

__all__ = [
    "ENVELOPE_SCHEMA",
    "kafka_source_options",
    "qualified_name",
    "read_csv",
    "read_envelope_stream",
    "read_kafka_stream",
    "read_lines",
    "read_table",
]
