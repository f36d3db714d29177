"""Turning a text corpus into timed, keyed messages.

The corpus is read line by line in (document, line) order; each line is cut
into words, lines without words are skipped, the remaining lines (all of them,
or the first ``limit`` if one is given) form one iteration, and every iteration (numbered from 1) is sent under
its own time key ``base + (iteration - 1) * cadence``. A message is
``"<ISO time> <words>"`` with the ISO time (six fraction digits) as its key,
both UTF-8 encoded.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.messages import iso_micros, message_text, utf8_bytes
from tidewater.functions.text import split_lines, tokenize
from tidewater.operators.limits import first_rows, spread_bounded

# Fixed value of the reference producer: the cadence between iterations. (It
# also sends at most 101,210 lines an iteration; here a cap is never a default.)
CADENCE_SECONDS = 60


def corpus_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line_no, tokens, n_tokens)`` for every corpus line.

    Lines are tokenised inside the generator (``posexplode`` of the tokenised
    line array), so ``tokens`` is a generator output: a later filter on
    ``n_tokens`` reads it instead of re-running the regex split.
    """
    per_line = F.transform(split_lines(text_col), lambda line: tokenize(line))
    return docs.select(
        F.col(id_col), F.posexplode(per_line).alias("line_no", "tokens")
    ).withColumn("n_tokens", F.size("tokens"))


def line_tokens(lines: DataFrame, keep: list[str], text_col: str = "value") -> DataFrame:
    """``(keep..., tokens, n_tokens)`` for one line per row.

    The tokens come out of a one-element generator, so a later filter on
    ``n_tokens`` reads them; a plain projection would be inlined into the
    pushed-down filter and tokenise every line twice.
    """
    return lines.select(
        *keep, F.explode(F.array(tokenize(text_col))).alias("tokens")
    ).withColumn("n_tokens", F.size("tokens"))


def nonempty_lines(tokens: DataFrame) -> DataFrame:
    """Lines with at least one word."""
    return tokens.filter(F.col("n_tokens") > 0)


def capped_lines(
    lines: DataFrame,
    limit: int | None = None,
    order_cols: tuple[str, ...] = ("doc_id", "line_no"),
) -> DataFrame:
    """The first ``limit`` lines in corpus order (exactly ``limit`` if present);
    all lines without a ``limit``.

    A per-task top-``limit`` for a small one, otherwise a verified key bound
    first (see ``operators.limits.first_rows``); never a full sort of the corpus
    and never ``partitions x limit`` rows in one task.
    """
    if limit is None:
        return lines
    return first_rows(lines, list(order_cols), limit)


def replay(
    lines: DataFrame,
    iterations: int,
    base_time: str | _dt.datetime,
    cadence_seconds: int = CADENCE_SECONDS,
    bounded_rows: int | None = None,
) -> DataFrame:
    """Every line once per iteration (numbered from 1), stamped
    ``base + (iteration - 1) * cadence``.

    ``bounded_rows`` declares that ``lines`` is a bounded result (a capped
    top-n); it is then spread over the task slots before the iterations are
    generated, so no single task produces ``rows x iterations`` rows.

    The iterations are generated per row (``explode(sequence)``), so the
    replication needs no join.
    """
    if iterations < 1:
        raise ValueError("iterations must be >= 1")
    if bounded_rows is not None:
        # A capped input sits in one partition; spread it first.
        lines = spread_bounded(lines, bounded_rows)
    base = F.lit(base_time).cast("timestamp")
    return lines.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("iteration")
    ).withColumn(
        "time_key",
        base + F.make_dt_interval(secs=(F.col("iteration") - 1) * F.lit(cadence_seconds)),
    )


def to_messages(
    timed: DataFrame, extra: list[str] | None = None, key_by: str = "time"
) -> DataFrame:
    """``key`` and ``value`` bytes per timed line.

    ``key_by="time"`` keys every message of an iteration by its ISO time (all
    land in one topic partition under key hashing); ``key_by="line"`` keys by
    a hash of the message, spreading an iteration over all partitions.
    """
    value = message_text("time_key", "tokens")
    if key_by == "time":
        key = iso_micros("time_key")
    elif key_by == "line":
        key = F.xxhash64(value).cast("string")
    else:
        raise ValueError("key_by must be 'time' or 'line'")
    return timed.select(
        *(extra or []), utf8_bytes(key).alias("key"), utf8_bytes(value).alias("value")
    )


def message_columns(
    time_key: F.Column | str = "time_key", tokens: str = "tokens"
) -> list[F.Column]:
    """``key`` and ``value`` as text plus ``n_bytes`` (UTF-8 length of value),
    as one projection."""
    text = message_text(time_key, tokens)
    return [
        iso_micros(time_key).alias("key"),
        text.alias("value"),
        F.octet_length(text).alias("n_bytes"),
    ]


def capped_messages(docs: DataFrame, base_time: str | _dt.datetime, limit: int) -> DataFrame:
    """One iteration: the first ``limit`` non-empty lines as message text.

    A single projection sits on the ordered limit, so the plan stays a
    per-task top-``limit`` (``TakeOrderedAndProject``).
    """
    lines = capped_lines(nonempty_lines(corpus_tokens(docs)), limit)
    return lines.select(
        "doc_id", "line_no",
        *message_columns(F.lit(base_time).cast("timestamp"), "tokens"),
    )


def replay_counts(
    lines: DataFrame,
    iterations: int,
    base_time: str | _dt.datetime,
    cadence_seconds: int = CADENCE_SECONDS,
) -> DataFrame:
    """Lines sent per iteration, with its number and time key; no row without
    lines. Every iteration sends the same lines, so they are counted once and
    the count is expanded, not the lines."""
    sent = lines.agg(F.count(F.lit(1)).alias("lines_sent")).where("lines_sent > 0")
    return replay(sent, iterations, base_time, cadence_seconds).select(
        "iteration", "time_key", "lines_sent")
