"""Native column expressions shared by the batch and streaming jobs."""

from tidewater.functions.messages import iso_micros, message_text, utf8_bytes
from tidewater.functions.numbers import format_2dp
from tidewater.functions.records import (
    explode_words,
    java_split,
    parse_records,
    split_malformed,
)
from tidewater.functions.text import split_lines, tokenize

__all__ = [
    "explode_words",
    "format_2dp",
    "iso_micros",
    "java_split",
    "message_text",
    "parse_records",
    "split_lines",
    "split_malformed",
    "tokenize",
    "utf8_bytes",
]
