"""Number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_2dp(col: Column | str) -> Column:
    """Text with two decimals and thousands separators, e.g. ``1,234.50``.

    Rounds half-even on the exact binary value (0.125 -> ``0.12``,
    2.675 -> ``2.67``); null stays null. The result is a string, so sort on the
    numeric column, not on this one.

    Above about 2**45 (3.5e13) a double keeps fewer than two exact decimals
    and Spark formats its shortest round-trip digits instead
    (281474976710656.125 -> ``...656.10``), as the reference job does.
    """
    return F.format_number(F.col(col) if isinstance(col, str) else col, 2)
