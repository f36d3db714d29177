"""Parsing ``"<timestamp> <text>"`` stream records into (timestamp, word) rows.

Everything here is a native expression, so the parse stays inside whole-stage
code generation and works unchanged on batch and streaming frames.

Record formats
--------------
``fixed`` (default)
    The consumer's fixed slice: characters ``[0, header_chars)`` are the time,
    character ``header_chars`` is skipped as the separator and the message is
    the rest. With the default 25 this expects ``2022-01-01T00:00:00+00:00 x``;
    a 26-character producer time (``...00:00:00.123456 x``) loses its last digit
    as the "separator", so the message starts with the real space and yields a
    leading empty word. That is the reference's behaviour and is kept.
``first_space``
    Time is everything before the first space, the message everything after.
    No phantom word.

In both formats only the first 19 characters of the time are parsed
(``yyyy-MM-dd'T'HH:mm:ss``); fraction and zone offset are ignored and the
session time zone applies.

Malformed records (null, too short for the slice, no separator, or a time that
does not parse) either fail the job (``mode="failfast"``) or are flagged in a
``malformed`` column (``mode="quarantine"``) for a side output. They are never
dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The consumer's time pattern (prefix-parsed, 19 characters), its
# fixed time-slice width, and the word separator of the message.
TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
TIME_PREFIX_CHARS = 19
HEADER_CHARS = 25
WORD_SEPARATOR = " "

RECORD_FORMATS = ("fixed", "first_space")
PARSE_MODES = ("failfast", "quarantine")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _quoted(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def java_split(text: Column | str, separator: str = WORD_SEPARATOR) -> Column:
    """``String.split(separator)`` with Java's rules, as an array expression.

    Leading and inner empty pieces are kept, trailing ones are removed; an empty
    string gives ``[""]`` and a string made only of separators gives ``[]``.
    (A bare ``split`` keeps trailing empties, so it is not enough.)
    """
    if not separator:
        raise ValueError("separator must be non-empty")
    text = _c(text)
    sep = _quoted(separator)
    # \z, not $: in Java regex $ also matches before a final line terminator.
    without_tail = F.regexp_replace(text, "(" + sep + ")+\\z", "")
    return (
        F.when(text == F.lit(""), F.array(F.lit("")))
        .when(without_tail == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(without_tail, sep))
    )


def _record_parts(value: Column, record_format: str, header_chars: int):
    if record_format == "fixed":
        head = F.substr(value, F.lit(1), F.lit(header_chars))
        message = F.substr(value, F.lit(header_chars + 2))
        too_short = F.length(value) < F.lit(header_chars + 1)
        return head, message, too_short
    if record_format == "first_space":
        cut = F.instr(value, WORD_SEPARATOR)
        head = F.substring_index(value, WORD_SEPARATOR, 1)
        message = F.substr(value, cut + F.lit(1))
        return head, message, cut == F.lit(0)
    raise ValueError(f"record_format must be one of {RECORD_FORMATS}")


def parse_records(
    df: DataFrame,
    value_col: str = "value",
    record_format: str = "fixed",
    header_chars: int = HEADER_CHARS,
    mode: str = "failfast",
    keep: list[str] | None = None,
) -> DataFrame:
    """``value`` string -> ``timestamp`` (TIMESTAMP) and ``message`` (string).

    ``keep`` lists extra input columns to carry along.
    """
    if mode not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    value = F.col(value_col)
    head, message, short = _record_parts(value, record_format, header_chars)
    ts = F.try_to_timestamp(F.substring(head, 1, TIME_PREFIX_CHARS), F.lit(TIME_PATTERN))
    bad = value.isNull() | short | ts.isNull()
    carried = [F.col(c) for c in (keep or [])]
    if mode == "failfast":
        # The check guards both outputs, so it survives column pruning when a
        # consumer reads only the words or only the times.
        fail = F.raise_error(
            F.concat(F.lit("malformed record: "), F.coalesce(value, F.lit("<null>")))
        )
        return df.select(
            *carried,
            _never_null(F.when(bad, fail).otherwise(ts)).alias("timestamp"),
            F.when(bad, fail).otherwise(message).alias("message"),
        )
    return df.select(
        *carried,
        F.when(~bad, ts).alias("timestamp"),
        F.when(~bad, message).alias("message"),
        bad.alias("malformed"),
        value.alias("raw_value"),
    )


def _never_null(ts: Column) -> Column:
    """``ts`` typed as non-nullable. Only for values that cannot be null here
    (bad records raised or were filtered out): it lets the optimizer drop the
    ``isnotnull`` filter that windowing adds, which would otherwise be pushed
    down with a second copy of the whole parse expression."""
    return F.coalesce(ts.cast("timestamp"), F.lit(0).cast("timestamp"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of a ``mode="quarantine"`` parse."""
    good = (
        parsed.filter(~F.col("malformed"))
        .withColumn("timestamp", _never_null(F.col("timestamp")))
        .drop("malformed", "raw_value")
    )
    bad = parsed.filter(F.col("malformed")).select("raw_value")
    return good, bad


def explode_words(
    parsed: DataFrame,
    ts_col: str = "timestamp",
    message_col: str = "message",
    with_position: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """One ``(timestamp, value)`` row per word of each message (Java split)."""
    carried = [F.col(c) for c in (keep or [])]
    words = java_split(F.col(message_col))
    if with_position:
        return parsed.select(
            *carried, F.col(ts_col).alias("timestamp"),
            F.posexplode(words).alias("pos", "value"),
        )
    return parsed.select(
        *carried, F.col(ts_col).alias("timestamp"), F.explode(words).alias("value")
    )
