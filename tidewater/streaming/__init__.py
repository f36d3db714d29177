"""Event-time word counts over a keyed message stream."""

from tidewater.streaming.word_count import (
    SINKS,
    start_counts,
    validate_sink,
    word_counts,
)

__all__ = ["SINKS", "start_counts", "validate_sink", "word_counts"]
