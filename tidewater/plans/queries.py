"""Registered queries: one per operator group, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise a sink or a stream write to fresh paths under the session's
checkpoint folder, run the job, and return what Spark reads back, so the
result checks the round trip. Timestamps are returned as TIMESTAMP_NTZ
(wall clock in the session zone).
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampType

from tidewater.functions.numbers import format_2dp
from tidewater.functions.records import explode_words, parse_records
from tidewater.functions.text import split_lines
from tidewater.operators.joins import join_dimension, salted_join
from tidewater.operators.layout import spread
from tidewater.operators.limits import first_rows
from tidewater.operators.numbering import number_rows
from tidewater.operators.replay import (
    capped_messages,
    corpus_tokens,
    message_columns,
    nonempty_lines,
    replay,
    replay_counts,
    to_messages,
)
from tidewater.operators.summary import (
    AVG_COL,
    AVG_TEXT_COL,
    COUNT_COL,
    NAME_COL,
    dimension_summary,
    summary_aggregate,
)
from tidewater.operators.windows import windowed_counts
from tidewater.plans import standins as S
from tidewater.session import scratch_path
from tidewater.sinks.delivery import deliver_batches, delivered_once, read_ledger
from tidewater.sinks.files import write_json, write_sorted_single_file
from tidewater.sinks.preview import preview_rows
from tidewater.sources.csv import RAW_LINE, read_csv, read_csv_sides
from tidewater.sources.envelope import decode_value, read_envelope_stream
from tidewater.sources.text import read_lines, read_lines_in_order
from tidewater.streaming.late_rows import read_split_counts, start_split_counts
from tidewater.streaming.snapshots import read_snapshot
from tidewater.streaming.state import open_windows
from tidewater.streaming.word_count import (
    CSV_NULL_VALUE,
    WATERMARK_DELAY,
    read_good_records,
    read_rejects,
    run_until_done,
    start_counts,
    start_records,
    word_counts,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

# Replay parameters of the registered queries; the cap is the feature of
# ``first_n_messages`` alone.
REPLAY_ITERATIONS = 3
FIRST_MESSAGES = 500
# The cap of ``first_n_selected``, likewise its feature.
FIRST_LINES = 20_000

SUMMARY_SCHEMA = StructType(
    [
        StructField(NAME_COL, StringType(), True),
        StructField(COUNT_COL, LongType(), True),
        StructField(AVG_TEXT_COL, StringType(), True),
    ]
)
ORDERS_CSV = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DecimalType(15, 2)),
        StructField("o_orderpriority", StringType()),
    ]
)
COUNTS_SCHEMA = StructType(
    [
        StructField("START_TIME", TimestampType(), True),
        StructField("END_TIME", TimestampType(), True),
        StructField("WORD", StringType(), True),
        StructField("COUNT", LongType(), True),
    ]
)


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _summary(spark: SparkSession, sf_dir: str, strategy: str, ordered: bool = True) -> DataFrame:
    return dimension_summary(
        S.fact_table(spark, sf_dir), S.dimension_table(spark, sf_dir),
        fact_key="AIRLINE", measure="ARRIVAL_DELAY", dim_key="IATA_CODE",
        dim_name="AIRLINE", strategy=strategy, ordered=ordered,
    )


# --- dimension summary -----------------------------------------------------

def delay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, "auto")


def delay_summary_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default's rows by way of a sort-merge join."""
    return _summary(spark, sf_dir, "preagg")


def delay_summary_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's shape: broadcast dimension, aggregate joined rows; the
    dimension is measured before it is broadcast."""
    return _summary(spark, sf_dir, "direct")


def document_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary on a natural left join: most documents carry no label."""
    docs = S.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = S.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return dimension_summary(
        docs, labels, fact_key="doc_id", measure="n_chars", dim_key="doc_id",
        dim_name="quality", output_names=("quality", "documents", "avg_chars_text"),
    )


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = S.fact_table(spark, sf_dir)
    dim = S.dimension_table(spark, sf_dir).select(
        "IATA_CODE", F.col("AIRLINE").alias(NAME_COL)
    )
    return join_dimension(fact, dim, fact["AIRLINE"] == dim["IATA_CODE"], "left").drop(
        "IATA_CODE"
    )


def select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = S.dimension_table(spark, sf_dir)
    return dim.select(dim["IATA_CODE"], dim["AIRLINE"].alias(NAME_COL))


def left_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir)


def salted_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the join for a dimension too large to broadcast; some
    keys hold enough rows to be salted."""
    fact, dim = S.fact_table(spark, sf_dir), S.dimension_table(spark, sf_dir)
    dim = dim.select("IATA_CODE", F.col("AIRLINE").alias(NAME_COL))
    return salted_join(fact, dim, "AIRLINE", "IATA_CODE", share=0.005).drop("IATA_CODE")


def count_nonnull_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).groupBy(NAME_COL).agg(F.count("AIRLINE").alias(COUNT_COL))


def avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).groupBy(NAME_COL).agg(F.avg("ARRIVAL_DELAY").alias(AVG_COL))


def derive_then_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_code = S.fact_table(spark, sf_dir).groupBy("AIRLINE").agg(
        F.count("AIRLINE").alias(COUNT_COL), F.avg("ARRIVAL_DELAY").alias(AVG_COL)
    )
    return (
        per_code.withColumn(AVG_TEXT_COL, format_2dp(AVG_COL))
        .orderBy(F.col(AVG_COL).asc_nulls_first())
        .drop(AVG_COL)
    )


def format_number_2dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = S.table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        format_2dp("l_extendedprice").alias("price_text"),
        format_2dp(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias(
            "disc_price_text"
        ),
        format_2dp(S.delay_expr()).alias("delay_text"),
    )


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_rows(_joined(spark, sf_dir), ["l_orderkey", "l_linenumber"], 20)


# --- sources and sinks -----------------------------------------------------

def csv_infer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = S.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    spread(orders).write.option("header", "true").csv(path)
    inferred = read_csv(spark, path, infer=True)
    return inferred.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in orders.schema.fields]
    )


def csv_reject_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines, some of which do not fit: rows of the good side and
    raw lines of the other."""
    path, k = scratch_path(spark, "orders-lines"), F.col("o_orderkey") % 13
    price = F.when(k == 4, "n/a").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", price]
    whole = F.concat_ws(",", *fields, "o_orderpriority")
    line = F.when(k == 7, F.concat_ws(",", *fields)).when(k == 9, F.concat(whole, F.lit(",more"))).otherwise(whole)
    spread(S.table(spark, sf_dir, "orders")).select(line.alias("line")).write.text(path)
    good, rejects = read_csv_sides(spark, path, ORDERS_CSV, header=False)
    return good.select(F.lit("good").alias("side"), *ORDERS_CSV.fieldNames(), F.lit(None).cast("string").alias("line")).union(
        rejects.select(F.lit("reject"), *[F.lit(None).cast(f.dataType) for f in ORDERS_CSV.fields], F.col(RAW_LINE)))


def messages_delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus messages sent in one batch that fails midway and runs again, with
    some of them sent twice: every message is read once."""
    sent, ledger = scratch_path(spark, "sent"), scratch_path(spark, "ledger")
    lines = replay(nonempty_lines(_tokens(spark, sf_dir)), 1, S.REPLAY_BASE_TIME)
    messages = to_messages(lines, extra=["doc_id", "line_no"])
    failing = {3}

    def send(part: DataFrame) -> None:
        number = part.select("part").first()
        again = F.pmod(F.xxhash64("message_id"), F.lit(8)) == 7
        rows = part.where(again).union(part)  # a task that was tried again
        rows.write.mode("append").parquet(sent)
        if number is not None and number.part in failing:
            failing.clear()
            raise RuntimeError("the sink failed")

    deliver = deliver_batches(send, ledger)
    with contextlib.suppress(RuntimeError):
        deliver(messages, 0)
    deliver(messages, 0)
    once = delivered_once(spark.read.parquet(sent), read_ledger(spark, ledger))
    return once.select("doc_id", "line_no", F.col("key").cast("string").alias("key"),
                       F.col("value").cast("string").alias("value"))


def text_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents-text")
    S.documents(spark, sf_dir).select("text").write.text(path)
    return read_lines(spark, path).select(F.col("value").alias("line"))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every corpus line with its number over all text files, which are read in
    splits: files in (document, line) order, numbers in file order."""
    path = scratch_path(spark, "corpus-text")
    lines = S.documents(spark, sf_dir).select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "line"))
    ordered = lines.repartitionByRange(F.col("doc_id"), F.col("line_no")).sortWithinPartitions("doc_id", "line_no")
    ordered.select("line").write.text(path)
    return number_rows(read_lines_in_order(spark, path), number="number").withColumnRenamed("value", "line")


def json_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary-json")
    write_json(_summary(spark, sf_dir, "auto", ordered=False), path)
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


def sorted_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary-single")
    agg = summary_aggregate(
        S.fact_table(spark, sf_dir), S.dimension_table(spark, sf_dir),
        "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE",
    ).withColumn(AVG_TEXT_COL, format_2dp(AVG_COL))
    write_sorted_single_file(
        agg, path, [F.col(AVG_COL).asc_nulls_first()], fmt="json", drop_cols=[AVG_COL]
    )
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


# --- record parsing ----------------------------------------------------------

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_value(S.events_envelope(spark, sf_dir))


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.events_envelope(spark, sf_dir).selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"
    )


def record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wall_clock(parse_records(_records(spark, sf_dir)), "timestamp")


def java_split_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = explode_words(parse_records(_records(spark, sf_dir)), with_position=True)
    return _wall_clock(words, "timestamp").select(
        "timestamp", "pos", F.col("value").alias("WORD")
    )


def record_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = explode_words(parse_records(_records(spark, sf_dir)))
    return words.groupBy(F.col("value").alias("WORD")).agg(F.count(F.lit(1)).alias("COUNT"))


def first_space_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts with the time cut at the first space: no phantom word."""
    parsed = parse_records(_records(spark, sf_dir), record_format="first_space")
    return explode_words(parsed).groupBy(F.col("value").alias("WORD")).agg(
        F.count(F.lit(1)).alias("COUNT")
    )


def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, _ = word_counts(_records(spark, sf_dir), watermark=None)
    return _wall_clock(counts, "START_TIME", "END_TIME")


# --- streaming ---------------------------------------------------------------

def _stage_envelope(spark: SparkSession, events: DataFrame, root: str, part: str) -> None:
    """Land ``events`` as envelope files: the stand-in for a topic's records."""
    S.events_envelope(spark, "", spread(events)).write.parquet(f"{root}/{part}")


def _stream_counts(spark: SparkSession, source: str) -> DataFrame:
    counts, _ = word_counts(decode_value(read_envelope_stream(spark, source)))
    return counts


def _state_partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _read_counts_csv(spark: SparkSession, path: str) -> DataFrame:
    counts = (
        spark.read.schema(COUNTS_SCHEMA).option("nullValue", CSV_NULL_VALUE).csv(path)
    )
    return _wall_clock(counts, "START_TIME", "END_TIME")


def _start(counts: DataFrame, sink: str, spark: SparkSession, path: str, checkpoint: str | None = None, **more):
    return start_counts(
        counts, sink, checkpoint or scratch_path(spark, "ckpt"), path=path, trigger="available_now",
        state_partitions=_state_partitions(spark), **more,
    )


def stream_counts_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = scratch_path(spark, "envelope")
    _stage_envelope(spark, S.table(spark, sf_dir, "events"), source, "all")
    out = scratch_path(spark, "counts-snapshot")
    run_until_done(_start(_stream_counts(spark, f"{source}/*"), "snapshot", spark, out))
    return _wall_clock(read_snapshot(spark, out), "START_TIME", "END_TIME")


def stream_counts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = scratch_path(spark, "envelope")
    _stage_envelope(spark, S.table(spark, sf_dir, "events"), source, "all")
    out = scratch_path(spark, "counts-csv")
    run_until_done(_start(_stream_counts(spark, f"{source}/*"), "csv", spark, out))
    return _read_counts_csv(spark, out)


def stream_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append counts that leave the stream in one output partition; the rows
    carry the number of files that hold rows."""
    source = scratch_path(spark, "envelope")
    _stage_envelope(spark, S.table(spark, sf_dir, "events"), source, "all")
    out = scratch_path(spark, "counts-one")
    lines = decode_value(read_envelope_stream(spark, f"{source}/*"))
    counts, _ = word_counts(lines, output_partitions=1)
    run_until_done(_start(counts, "parquet", spark, out))
    rows = spark.read.parquet(out)
    files = rows.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return _wall_clock(rows, "START_TIME", "END_TIME").withColumn("files", F.lit(files))


def _stage_spans(spark: SparkSession, events: DataFrame, source: str, spans: int) -> int:
    """Land ``events`` span by span in time order and return the files of a span:
    reading that many files a batch gives one span a batch."""
    ts, edges = F.col("ts"), [None, *_time_cuts(events, spans), None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = events if low is None else events.filter(ts >= low)
        parts.append(part if high is None else part.filter(ts < high))
    # Round-robin leaves no file of a span empty if each input part has some rows.
    least = min(part.count() for part in parts)
    files = max(1, min(_state_partitions(spark), least // 1000))
    for k, part in enumerate(parts):
        S.events_envelope(spark, "", part).repartition(files).write.parquet(f"{source}/run{k}")
    return files


def stream_counts_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append counts over several micro-batches: four spans in time order, one
    a batch, so state is carried over and windows close batch by batch."""
    source, out = scratch_path(spark, "envelope"), scratch_path(spark, "counts-csv")
    files = _stage_spans(spark, S.table(spark, sf_dir, "events"), source, 4)
    lines = decode_value(read_envelope_stream(spark, f"{source}/*", max_files_per_trigger=files))
    counts, _ = word_counts(lines)
    run_until_done(_start(counts, "csv", spark, out))
    return _read_counts_csv(spark, out)


def stream_counts_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete result over six micro-batches, each of which publishes only
    the rows it changed: four of the segments have been merged on the way."""
    source, out = scratch_path(spark, "envelope"), scratch_path(spark, "counts-tiers")
    files = _stage_spans(spark, S.table(spark, sf_dir, "events"), source, 6)
    lines = decode_value(read_envelope_stream(spark, f"{source}/*", max_files_per_trigger=files))
    counts, _ = word_counts(lines, watermark=None)
    run_until_done(_start(counts, "snapshot", spark, out, output_mode="update"))
    return _wall_clock(read_snapshot(spark, out), "START_TIME", "END_TIME")


#: Watermark delay of ``stream_open_state``: some days of windows stay open.
OPEN_DELAY = "3 days"


def stream_open_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stopped query holds in state: the counts of the windows that the
    first two thirds of the events leave open, read from its checkpoint."""
    first, middle, _ = _event_thirds(spark, sf_dir)
    source, out, ckpt = (scratch_path(spark, n) for n in ("envelope", "open-csv", "ckpt"))
    _stage_envelope(spark, first.unionByName(middle), source, "run1")
    lines = decode_value(read_envelope_stream(spark, f"{source}/*"))
    counts, _ = word_counts(lines, watermark=OPEN_DELAY)
    run_until_done(_start(counts, "csv", spark, out, ckpt))
    return _wall_clock(open_windows(spark, ckpt), "START_TIME", "END_TIME")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and malformed records of one stream, side by side: counts of the
    good ones, and every malformed record as it came."""
    envelope = S.events_envelope(spark, sf_dir)
    broken = F.when(F.col("offset") % 9 == 4, F.expr("substring(value, 1, 12)")).otherwise(F.col("value"))
    source, records, out = (scratch_path(spark, n) for n in ("envelope", "records", "counts"))
    envelope.withColumn("value", broken).write.parquet(f"{source}/all")
    lines = decode_value(read_envelope_stream(spark, f"{source}/*"))
    run_until_done(start_records(lines, records, scratch_path(spark, "ckpt"), trigger="available_now"))
    counts, _ = word_counts(read_good_records(spark, records))
    run_until_done(_start(counts, "snapshot", spark, out))
    good = read_snapshot(spark, out).groupBy(F.col("WORD").alias("text")).agg(F.sum("COUNT").alias("n"))
    bad = read_rejects(spark, records).groupBy(F.col("raw_value").alias("text")).agg(F.count("*").alias("n"))
    return good.select(F.lit("word").alias("side"), "text", "n").union(
        bad.select(F.lit("malformed"), "text", "n"))


def _time_cuts(events: DataFrame, parts: int) -> list:
    """Cut points splitting the events' time range into ``parts`` equal spans
    (whole microseconds), as TIMESTAMP_NTZ literals the scan can filter on."""
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        lo = hi = dt.datetime(1970, 1, 1)  # no events: any cut will do
    step = (hi - lo) // parts
    return [F.to_timestamp_ntz(F.lit((lo + step * i).isoformat())) for i in range(1, parts)]


def _event_thirds(spark: SparkSession, sf_dir: str):
    """Events split at the thirds of their time range (filters reach the scan)."""
    events = S.table(spark, sf_dir, "events")
    c1, c2 = _time_cuts(events, 3)
    ts = F.col("ts")
    return events.filter(ts < c1), events.filter((ts >= c1) & (ts < c2)), events.filter(ts >= c2)


def _run_csv_counts(spark: SparkSession, source: str, out: str, ckpt: str, single: bool = False) -> dict:
    counts = _stream_counts(spark, f"{source}/*")
    return run_until_done(_start(counts, "csv", spark, out, ckpt, single_watermark=single))


def stream_late_rows(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    """Run 1 sees the middle third; run 2 the last and the first third. The
    first third is older than the watermark run 1 left behind, so it is
    dropped; everything else is counted once its window closes."""
    first, middle, last = _event_thirds(spark, sf_dir)
    source, out, ckpt = (scratch_path(spark, n) for n in ("envelope", "late-csv", "ckpt"))
    _stage_envelope(spark, middle, source, "run1")
    _run_csv_counts(spark, source, out, ckpt, single)
    _stage_envelope(spark, last.unionByName(first), source, "run2")
    _run_csv_counts(spark, source, out, ckpt, single)
    return _read_counts_csv(spark, out)


def stream_late_rows_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one watermark for late rows and for closing windows."""
    return stream_late_rows(spark, sf_dir, single=True)


def stream_late_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order of events with a side table: counted words, and the late
    ones by window, so that both sides together are the input."""
    first, middle, last = _event_thirds(spark, sf_dir)
    source, out, ckpt = (scratch_path(spark, n) for n in ("envelope", "late-split", "ckpt"))
    lines = decode_value(read_envelope_stream(spark, f"{source}/*"))
    words = explode_words(parse_records(lines))
    for part, name in ((middle, "run1"), (last.unionByName(first), "run2")):
        _stage_envelope(spark, part, source, name)
        run_until_done(start_split_counts(words, out, ckpt, WATERMARK_DELAY, trigger="available_now"))
    counts, late = read_split_counts(spark, out)
    side = windowed_counts(late.select("timestamp", "value"))
    both = counts.select(F.lit("counted").alias("side"), "*").unionByName(side.select(F.lit("late").alias("side"), "*"))
    return _wall_clock(both, "START_TIME", "END_TIME")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: first half, second half, nothing new.
    Each closed window is emitted exactly once across the runs."""
    events = S.table(spark, sf_dir, "events")
    (mid,) = _time_cuts(events, 2)
    source, out, ckpt = (scratch_path(spark, n) for n in ("envelope", "restart-csv", "ckpt"))
    _stage_envelope(spark, events.filter(F.col("ts") < mid), source, "run1")
    _run_csv_counts(spark, source, out, ckpt)
    _stage_envelope(spark, events.filter(F.col("ts") >= mid), source, "run2")
    _run_csv_counts(spark, source, out, ckpt)
    _run_csv_counts(spark, source, out, ckpt)
    return _read_counts_csv(spark, out)


# --- corpus and messages -------------------------------------------------------

def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_tokens(S.documents(spark, sf_dir))


def _token_text(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "line_no", "n_tokens", F.concat_ws(" ", "tokens").alias("words"))


def tokenize_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_text(_tokens(spark, sf_dir))


def drop_empty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _token_text(nonempty_lines(_tokens(spark, sf_dir)))


def first_n_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped_messages(S.documents(spark, sf_dir), S.REPLAY_BASE_TIME, FIRST_MESSAGES)


def first_n_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lineitems by keys that thousands of them share, as counts a key:
    selection by histograms, the last key's ties cut exactly."""
    lines = S.table(spark, sf_dir, "lineitem")
    first = first_rows(lines, ["l_returnflag", "l_shipdate", "l_linenumber"], FIRST_LINES, merge_rows=500)
    return first.groupBy("l_returnflag", "l_shipdate", "l_linenumber").agg(F.count("*").alias("n"))


def build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = nonempty_lines(_tokens(spark, sf_dir))
    base = F.lit(S.REPLAY_BASE_TIME).cast("timestamp")
    return lines.select("doc_id", "line_no", *message_columns(base, "tokens"))


def message_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary key and value written as an envelope and decoded back."""
    path = scratch_path(spark, "frames")
    timed = replay(nonempty_lines(_tokens(spark, sf_dir)), 1, S.REPLAY_BASE_TIME)
    to_messages(timed, extra=["doc_id", "line_no"]).write.parquet(path)
    return spark.read.parquet(path).select(
        "doc_id", "line_no", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"), F.md5("value").alias("value_md5"),
    )


def timed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = nonempty_lines(_tokens(spark, sf_dir))
    return replay(lines, REPLAY_ITERATIONS, S.REPLAY_BASE_TIME).select(
        "doc_id", "line_no", "iteration", *message_columns("time_key", "tokens")
    )


def replay_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = nonempty_lines(_tokens(spark, sf_dir))
    return _wall_clock(replay_counts(lines, REPLAY_ITERATIONS, S.REPLAY_BASE_TIME), "time_key")


QUERIES: dict[str, QueryFn] = {
    "delay_summary": delay_summary,
    "delay_summary_preagg": delay_summary_preagg,
    "delay_summary_direct": delay_summary_direct,
    "document_label_summary": document_label_summary,
    "csv_infer_scan": csv_infer_scan,
    "csv_reject_side": csv_reject_side,
    "text_line_scan": text_line_scan,
    "numbered_lines": numbered_lines,
    "json_sink_roundtrip": json_sink_roundtrip,
    "select_rename": select_rename,
    "derive_then_drop": derive_then_drop,
    "left_outer_join": left_outer_join,
    "salted_outer_join": salted_outer_join,
    "count_nonnull_by_key": count_nonnull_by_key,
    "avg_by_key": avg_by_key,
    "format_number_2dp": format_number_2dp,
    "sorted_single_file": sorted_single_file,
    "preview_limit": preview_limit,
    "envelope_decode": envelope_decode,
    "record_split": record_split,
    "java_split_words": java_split_words,
    "record_word_counts": record_word_counts,
    "first_space_word_counts": first_space_word_counts,
    "tumbling_counts": tumbling_counts,
    "stream_counts_complete": stream_counts_complete,
    "stream_counts_append": stream_counts_append,
    "stream_one_partition": stream_one_partition,
    "stream_counts_batches": stream_counts_batches,
    "stream_counts_tiered": stream_counts_tiered,
    "stream_open_state": stream_open_state,
    "stream_quarantine": stream_quarantine,
    "stream_late_rows": stream_late_rows,
    "stream_late_rows_single": stream_late_rows_single,
    "stream_late_side": stream_late_side,
    "stream_restart": stream_restart,
    "tokenize_lines": tokenize_lines,
    "drop_empty_lines": drop_empty_lines,
    "first_n_messages": first_n_messages,
    "first_n_selected": first_n_selected,
    "build_messages": build_messages,
    "message_frames": message_frames,
    "messages_delivered_once": messages_delivered_once,
    "timed_replay": timed_replay,
    "replay_counts": replay_counts_query,
}
