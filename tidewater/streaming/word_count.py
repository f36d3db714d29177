"""Windowed word counts over a stream of ``"<timestamp> <text>"`` records.

Plan per micro-batch: decode ``value`` -> parse time and message (native
expressions) -> explode words -> event-time watermark -> partial count per
(window, word) -> shuffle -> state store merge -> sink. The same functions run
the batch version (``operators.windowed_counts``), so batch and stream agree.

Sinks and output modes (checked before ``start``):

``console``   complete / update / append, default trigger (as fast as possible);
              prints the first rows of each batch and collects no more
``csv``       append only, needs a watermark; default trigger 1 minute
``parquet``   append only, needs a watermark
``snapshot``  complete / update: each batch publishes the result so far
              (``streaming.snapshots``; ``read_snapshot`` reads the last one). In
              update mode a batch only writes the rows it changed, the scalable
              form of a complete table; without a watermark both hold the same
``memory``    any mode; collects to the driver, tests only

Malformed records: ``start_records`` writes good and malformed records of a
stream to one table with one query and one checkpoint, and the counts read the
good ones from it, so every record is on exactly one side whatever fails when.

Late rows: a row whose window already closed (window end at or before the
watermark) is dropped by the state operator. On Spark 4 the late-row filter
uses the previous batch's watermark while eviction uses the current one;
``start_counts(single_watermark=True)`` uses one watermark for both. The
state partition count and state store are fixed when a checkpoint is first
used; pass ``state_partitions`` / ``state_store`` on the first start.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.records import (
    HEADER_CHARS,
    explode_words,
    parse_records,
    split_malformed,
)
from tidewater.operators.windows import WINDOW_SIZE, windowed_counts
from tidewater.session import STREAMING_CONF
from tidewater.streaming.snapshots import publish_batches

# Fixed values of the reference stream: 1-minute watermark delay and a
# 1-minute processing-time trigger for the CSV sink.
WATERMARK_DELAY = "1 minute"
CSV_TRIGGER = "1 minute"

SINKS = {
    "console": ("complete", "update", "append"),
    "csv": ("append",),
    "parquet": ("append",),
    "snapshot": ("complete", "update"),
    "memory": ("complete", "update", "append"),
}
DEFAULT_MODE = {"console": "complete", "csv": "append", "parquet": "append",
                "snapshot": "complete", "memory": "complete"}

# CSV options for the counts: the empty word must stay distinct from null.
CSV_NULL_VALUE = "\\N"


def word_counts(
    lines: DataFrame,
    value_col: str = "value",
    watermark: str | None = WATERMARK_DELAY,
    window: str = WINDOW_SIZE,
    slide: str | None = None,
    record_format: str = "fixed",
    header_chars: int = HEADER_CHARS,
    mode: str = "failfast",
    output_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(counts, rejects). ``rejects`` is ``None`` unless ``mode="quarantine"``.

    ``lines`` is a batch or streaming frame with a string ``value_col``.
    ``output_partitions`` sets how many files each trigger writes (the
    reference used one). It shuffles only the emitted rows
    (``repartition``); a ``coalesce`` would instead fold the state-store stage
    into that many tasks.
    """
    parsed = parse_records(lines, value_col, record_format, header_chars, mode)
    rejects = None
    if mode == "quarantine":
        parsed, rejects = split_malformed(parsed)
    words = explode_words(parsed)
    if watermark:
        words = words.withWatermark("timestamp", watermark)
    counts = windowed_counts(words, size=window, slide=slide)
    if output_partitions:
        counts = counts.repartition(output_partitions)
    return counts, rejects


def validate_sink(sink: str, output_mode: str, has_watermark: bool) -> None:
    """Reject sink/mode pairs Spark would only reject at ``start()``."""
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}; expected one of {sorted(SINKS)}")
    if output_mode not in SINKS[sink]:
        raise ValueError(f"sink {sink!r} does not support output mode {output_mode!r}")
    if output_mode == "append" and not has_watermark:
        raise ValueError("append mode on a windowed count needs a watermark")


STATE_STORES = {
    # Off-heap, spills to local disk, incremental (changelog) checkpoints:
    # the store for large state.
    "rocksdb": {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # No read-before-write to keep an exact row total in the metrics.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    },
    # Spark's default: all state on the executor heap.
    "memory": {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
        ),
    },
}


@contextlib.contextmanager
def _query_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of one query (a started query keeps its
    own copy of the session configuration)."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Rows of a batch that the console sink prints.
CONSOLE_ROWS = 20


def _show(batch: DataFrame, batch_id: int) -> None:
    print(f"batch {batch_id}")
    batch.show(CONSOLE_ROWS, truncate=False)


def start_records(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    value_col: str = "value",
    record_format: str = "fixed",
    header_chars: int = HEADER_CHARS,
    trigger: str | None = None,
) -> StreamingQuery:
    """Write a stream's records to ``path``, parted by ``malformed``.

    One query, one checkpoint and one exactly-once file sink hold both sides:
    good records plus malformed ones are the input, also across failures.
    """
    parsed = parse_records(lines, value_col, record_format, header_chars, "quarantine")
    writer = (
        parsed.select("malformed", "raw_value").writeStream.format("parquet")
        .partitionBy("malformed").option("path", path).option("checkpointLocation", checkpoint)
    )
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


RECORDS_SCHEMA = "raw_value string, malformed boolean"


def read_good_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` of the good records that ``start_records`` wrote."""
    _make_folder(spark, path)
    reader = spark.readStream.schema(RECORDS_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path).where(~F.col("malformed")).select(F.col("raw_value").alias("value"))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``raw_value`` of the malformed records that ``start_records`` wrote."""
    return spark.read.schema(RECORDS_SCHEMA).parquet(path).where("malformed").select("raw_value")


def _make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def start_counts(
    counts: DataFrame,
    sink: str,
    checkpoint: str,
    path: str | None = None,
    output_mode: str | None = None,
    trigger: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
    state_store: str | None = "rocksdb",
    single_watermark: bool = False,
) -> StreamingQuery:
    """Start the counting query on ``sink``.

    ``trigger``: ``None`` (sink default), ``"available_now"`` (process what is
    there, then stop), or a processing-time interval such as ``"1 minute"``.
    ``state_partitions`` and ``state_store`` (``"rocksdb"``, ``"memory"`` or
    ``None`` for the session's choice) only take effect when the checkpoint
    is new; a restarted query keeps what its checkpoint recorded.
    ``single_watermark=True`` filters late rows with the same watermark that
    evicts state (Spark 3 behaviour); by default Spark 4 filters with the
    previous batch's watermark, so rows for a window closed in the batch
    before still count.
    """
    output_mode = output_mode or DEFAULT_MODE.get(sink, "append")
    plan = counts._jdf.queryExecution().analyzed().toString()
    validate_sink(sink, output_mode, "EventTimeWatermark" in plan)
    if sink in ("csv", "parquet", "snapshot") and not path:
        raise ValueError(f"sink {sink!r} needs a path")
    writer = counts.writeStream.outputMode(output_mode).option(
        "checkpointLocation", checkpoint
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger is None and sink == "csv":
        trigger = CSV_TRIGGER
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if sink == "console":
        writer = writer.foreachBatch(_show)
    elif sink == "csv":
        writer = writer.format("csv").option("path", path).option("nullValue", CSV_NULL_VALUE)
    elif sink == "parquet":
        writer = writer.format("parquet").option("path", path)
    elif sink == "snapshot":
        keys = [c for c in counts.columns if c != "COUNT"] if output_mode == "update" else None
        writer = writer.foreachBatch(publish_batches(path, keys))
    elif sink == "memory":
        writer = writer.format("memory")
    settings = dict(STREAMING_CONF)  # retention and maintenance, per query
    settings.update(STATE_STORES[state_store] if state_store else {})
    if state_partitions is None:
        # A batch job's shuffle width is too wide for state stores.
        width = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        state_partitions = min(width, max(1, counts.sparkSession.sparkContext.defaultParallelism))
    settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if single_watermark:
        settings["spark.sql.streaming.statefulOperator.allowMultiple"] = "false"
    with _query_conf(counts.sparkSession, settings):
        return writer.start()


def await_all(queries: list[StreamingQuery]) -> None:
    """Block until every query has ended; if one fails, stop the others and raise."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(timeout=1)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def run_until_done(query: StreamingQuery) -> dict:
    """Wait for an ``available_now`` query; re-raise its failure; return the
    last progress report."""
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise RuntimeError(f"streaming query failed: {error}")
    return query.lastProgress or {}
