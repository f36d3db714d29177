"""Writers: JSON / CSV files, a single sorted file, JDBC, Kafka, previews."""

from tidewater.sinks.files import write_json, write_sorted_single_file
from tidewater.sinks.jdbc import write_table
from tidewater.sinks.kafka import write_kafka
from tidewater.sinks.preview import preview, preview_rows

__all__ = [
    "preview",
    "preview_rows",
    "write_json",
    "write_kafka",
    "write_sorted_single_file",
    "write_table",
]
