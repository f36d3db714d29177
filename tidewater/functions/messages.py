"""Keyed text messages: ``"<ISO time> <words>"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 local time with six fraction digits, as written by the
# message producer (always six digits, so the consumer's fixed slice is stable).
ISO_MICROS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_micros(ts: Column | str) -> Column:
    """``2024-01-01T00:00:07.179575`` (26 characters, no zone offset)."""
    return F.date_format(_c(ts), ISO_MICROS_PATTERN)


def message_text(ts: Column | str, words: Column | str) -> Column:
    """Time, one space, then the words joined by single spaces."""
    return F.concat(iso_micros(ts), F.lit(" "), F.concat_ws(" ", _c(words)))


def utf8_bytes(text: Column | str) -> Column:
    """UTF-8 encoding of a string column."""
    return _c(text).cast("binary")
