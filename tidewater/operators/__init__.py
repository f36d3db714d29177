"""Relational jobs built from DataFrame operators."""

from tidewater.operators.joins import fits_broadcast, join_dimension
from tidewater.operators.replay import (
    capped_messages,
    corpus_tokens,
    replay,
    replay_counts,
)
from tidewater.operators.summary import dimension_summary
from tidewater.operators.windows import windowed_counts

__all__ = [
    "capped_messages",
    "corpus_tokens",
    "dimension_summary",
    "fits_broadcast",
    "join_dimension",
    "replay",
    "replay_counts",
    "windowed_counts",
]
