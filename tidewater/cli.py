"""Command line entry points.

    python -m tidewater.cli delay-summary DIMENSION_CSV FACT_CSV OUTPUT
    python -m tidewater.cli copy-table --url URL --schema S --from-table A --to-table B
    python -m tidewater.cli stream-counts --checkpoint DIR --sink csv --output DIR ...
    python -m tidewater.cli publish --input TEXT --topic T --bootstrap-servers H ...

Passwords are read from environment variables (``--password-env``), never
from the command line, and are never printed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F


def _session(app: str, args: argparse.Namespace):
    from tidewater.session import build_session

    return build_session(app, master=getattr(args, "master", None),
                         shuffle_partitions=getattr(args, "shuffle_partitions", None),
                         profile=getattr(args, "profile", "default"))


def _password(env_name: str | None) -> str | None:
    import os

    if not env_name:
        return None
    value = os.environ.get(env_name)
    if value is None:
        raise SystemExit(f"environment variable {env_name} is not set")
    return value


# --- delay-summary -------------------------------------------------------------

def delay_summary(args: argparse.Namespace) -> None:
    from tidewater.operators.summary import AVG_COL, AVG_TEXT_COL, NAME_COL, summary_aggregate
    from tidewater.sinks.files import write_json, write_sorted_single_file
    from tidewater.sinks.preview import preview
    from tidewater.sources.csv import read_csv

    spark = _session("delay-summary", args)
    dim = read_csv(spark, args.dimension, infer=args.infer_schema).select(
        F.col("IATA_CODE").cast("string"), F.col("AIRLINE").cast("string")
    )
    fact = read_csv(spark, args.fact, infer=args.infer_schema).select(
        F.col("AIRLINE").cast("string"), F.col("ARRIVAL_DELAY").cast("double")
    )
    agg = summary_aggregate(
        fact, dim, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE", strategy=args.strategy
    ).withColumn(AVG_TEXT_COL, F.format_number(AVG_COL, 2))
    if args.preview:
        names = dim.select("IATA_CODE", F.col("AIRLINE").alias(NAME_COL))
        joined = fact.join(names, fact["AIRLINE"] == names["IATA_CODE"], "left")
        for step in (dim, fact, names, joined, agg.orderBy(F.col(AVG_COL).asc_nulls_first())):
            preview(step, enabled=True)
    if args.single_file:
        # The result has a row per dimension row at most, and the null name.
        write_sorted_single_file(
            agg, args.output, [F.col(AVG_COL).asc_nulls_first()], drop_cols=[AVG_COL],
            rows_bound=dim.count() + 1,
        )
    else:
        write_json(agg.orderBy(F.col(AVG_COL).asc_nulls_first()).drop(AVG_COL), args.output)


# --- copy-table ----------------------------------------------------------------

def copy_table_cmd(args: argparse.Namespace) -> None:
    from tidewater.operators.copy_table import copy_table
    from tidewater.sinks.preview import preview
    from tidewater.sources.jdbc import connection_options

    spark = _session("copy-table", args)
    conn = connection_options(args.url, args.user, _password(args.password_env),
                              driver=args.driver)
    copy_table(
        spark, conn, args.schema, args.from_table, args.to_table,
        partition_column=args.partition_column, num_partitions=args.num_partitions,
        batch_size=args.batch_size, before_write=lambda source: preview(source, enabled=args.preview),
    )


# --- stream-counts ---------------------------------------------------------------

def kafka_auth(args: argparse.Namespace):
    from tidewater.sources.kafka import PlainAuth, SaslModuleAuth

    if args.auth == "plain":
        return PlainAuth(args.username, _password(args.password_env) or "")
    if args.auth == "sasl-module":
        pairs = tuple(tuple(kv.split("=", 1)) for kv in args.login_option or [])
        return SaslModuleAuth(args.sasl_mechanism, args.login_module, pairs)
    return None


def stream_counts(args: argparse.Namespace) -> None:
    from tidewater.sources.envelope import decode_value, read_envelope_stream
    from tidewater.sources.kafka import kafka_source_options, read_kafka_stream
    from tidewater.streaming.word_count import (
        await_all,
        read_good_records,
        run_until_done,
        start_counts,
        start_records,
        word_counts,
    )

    spark = _session("stream-counts", args)
    if args.source_path and args.source_format == "text":
        # One record per line, already text: no envelope to decode.
        reader = spark.readStream.format("text")
        if args.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(args.max_files_per_trigger))
        records = reader.load(args.source_path)
    elif args.source_path:
        envelope = read_envelope_stream(spark, args.source_path,
                                        args.max_files_per_trigger, args.source_format)
    else:
        opts = kafka_source_options(
            args.bootstrap_servers, args.topics, kafka_auth(args),
            starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
        )
        envelope = read_kafka_stream(spark, opts)
    if not (args.source_path and args.source_format == "text"):
        records = decode_value(envelope)
    queries = []
    if args.mode == "quarantine":
        # Both sides go through one query and one checkpoint; the counts read
        # the good side, so no record can fall between two sources' offsets.
        sorter = start_records(records, args.rejects_output, args.checkpoint.rstrip("/") + "-records",
                               record_format=args.record_format, trigger=args.trigger)
        if args.trigger == "available_now":
            run_until_done(sorter)
        else:
            queries.append(sorter)
        records = read_good_records(spark, args.rejects_output, args.max_files_per_trigger)
    counts, _ = word_counts(
        records, watermark=args.watermark, window=args.window, slide=args.slide,
        record_format=args.record_format, output_partitions=args.output_partitions,
    )
    query = start_counts(
        counts, args.sink, args.checkpoint, path=args.output, trigger=args.trigger,
        state_partitions=args.state_partitions, state_store=args.state_store,
        single_watermark=args.single_watermark,
    )
    await_all([*queries, query])


# --- publish -----------------------------------------------------------------------

def publish(args: argparse.Namespace) -> None:
    from tidewater.operators.replay import (
        capped_lines,
        line_tokens,
        nonempty_lines,
        replay,
        to_messages,
    )
    from tidewater.sinks.kafka import kafka_sink_options, write_kafka
    from tidewater.sources.kafka import kafka_auth_options, PlainAuth
    from tidewater.sources.text import read_lines_in_order

    spark = _session("publish", args)
    order = ("file", "block", "row")
    lines = nonempty_lines(line_tokens(read_lines_in_order(spark, args.input), list(order)))
    capped = capped_lines(lines, args.limit, order)
    base = args.base_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    timed = replay(capped, args.iterations, base, args.cadence_seconds,
                   bounded_rows=args.limit)
    messages = to_messages(timed, key_by=args.key_by)
    if args.output:
        messages.write.mode("errorifexists").parquet(args.output)
        return
    auth = kafka_auth_options(PlainAuth(args.username, _password(args.password_env) or ""))
    write_kafka(messages, kafka_sink_options(args.bootstrap_servers, args.topic, auth))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater")
    p.add_argument("--master", help="used only when no master is configured")
    p.add_argument("--shuffle-partitions", type=int)
    p.add_argument("--profile", choices=["default", "cluster"], default="default",
                   help="cluster: wide shuffles coalesced by AQE, 512 MB scan splits")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("delay-summary", help="per-name count and average of a fact CSV")
    s.add_argument("dimension")
    s.add_argument("fact")
    s.add_argument("output")
    s.add_argument("--infer-schema", action="store_true")
    s.add_argument("--strategy", choices=["auto", "direct", "preagg"], default="auto")
    s.add_argument("--single-file", action=argparse.BooleanOptionalAction, default=True)
    s.add_argument("--preview", action="store_true")
    s.set_defaults(func=delay_summary)

    c = sub.add_parser("copy-table", help="copy a database table over JDBC")
    c.add_argument("--url", required=True)
    c.add_argument("--driver")
    c.add_argument("--user")
    c.add_argument("--password-env")
    c.add_argument("--schema")
    c.add_argument("--from-table", required=True)
    c.add_argument("--to-table", required=True)
    c.add_argument("--partition-column")
    c.add_argument("--num-partitions", type=int)
    c.add_argument("--batch-size", type=int, default=10_000)
    c.add_argument("--preview", action="store_true")
    c.set_defaults(func=copy_table_cmd)

    w = sub.add_parser("stream-counts", help="windowed word counts of a message stream")
    w.add_argument("--bootstrap-servers")
    w.add_argument("--topics")
    w.add_argument("--auth", choices=["plain", "sasl-module", "none"], default="plain")
    w.add_argument("--username")
    w.add_argument("--password-env")
    w.add_argument("--sasl-mechanism")
    w.add_argument("--login-module")
    w.add_argument("--login-option", action="append", help="key=value for the JAAS entry")
    w.add_argument("--starting-offsets", default="latest")
    w.add_argument("--max-offsets-per-trigger", type=int,
                   help="bound each micro-batch (records across all partitions)")
    w.add_argument("--min-partitions", type=int,
                   help="split hot topic partitions over at least this many tasks")
    w.add_argument("--source-path", help="read envelope files instead of Kafka")
    w.add_argument("--source-format", default="parquet",
                   help="envelope files (parquet, json, ...) or text: one record per line")
    w.add_argument("--max-files-per-trigger", type=int)
    w.add_argument("--checkpoint", required=True)
    w.add_argument("--sink", choices=["console", "csv", "parquet", "snapshot"], required=True)
    w.add_argument("--output")
    w.add_argument("--trigger", help='"available_now" or an interval like "1 minute"')
    w.add_argument("--watermark", default="1 minute")
    w.add_argument("--window", default="1 minute")
    w.add_argument("--slide", help="shorter than --window for sliding windows")
    w.add_argument("--record-format", choices=["fixed", "first_space"], default="fixed")
    w.add_argument("--mode", choices=["failfast", "quarantine"], default="failfast")
    w.add_argument("--rejects-output",
                   help="table of all records, parted by malformed=true/false")
    w.add_argument("--output-partitions", type=int)
    w.add_argument("--state-partitions", type=int)
    w.add_argument("--state-store", choices=["rocksdb", "memory"], default="rocksdb")
    w.add_argument("--single-watermark", action="store_true",
                   help="drop late rows by the current watermark (Spark 3 rule)")
    w.set_defaults(func=stream_counts)

    u = sub.add_parser("publish", help="send a text file as timed keyed messages")
    u.add_argument("--input", required=True)
    u.add_argument("--bootstrap-servers")
    u.add_argument("--topic")
    u.add_argument("--username")
    u.add_argument("--password-env")
    u.add_argument("--iterations", type=int, default=1)
    u.add_argument("--limit", type=int, help="lines an iteration sends at most (default: all)")
    u.add_argument("--cadence-seconds", type=int, default=60)
    u.add_argument("--base-time", type=dt.datetime.fromisoformat)
    u.add_argument("--key-by", choices=["time", "line"], default="time",
                   help="time: one key, so one topic partition, an iteration; line: spread by message hash")
    u.add_argument("--output", help="write the envelope as parquet instead of Kafka")
    u.set_defaults(func=publish)
    return p


def validate(args: argparse.Namespace) -> None:
    if args.command == "stream-counts":
        if args.sink in ("csv", "parquet", "snapshot") and not args.output:
            raise SystemExit(f"--sink {args.sink} needs --output")
        if not args.source_path and not (args.bootstrap_servers and args.topics):
            raise SystemExit("give --bootstrap-servers and --topics, or --source-path")
        if args.mode == "quarantine" and not args.rejects_output:
            raise SystemExit("--mode quarantine needs --rejects-output")
        if args.auth == "plain" and not args.source_path and not args.username:
            raise SystemExit("--auth plain needs --username and --password-env")
        if args.auth == "sasl-module" and not (args.sasl_mechanism and args.login_module):
            raise SystemExit("--auth sasl-module needs --sasl-mechanism and --login-module")
    if args.command == "publish" and not args.output:
        if not (args.bootstrap_servers and args.topic):
            raise SystemExit("give --bootstrap-servers and --topic, or --output")
        if not (args.username and args.password_env):
            raise SystemExit("publishing to Kafka needs --username and --password-env")
    if args.command == "publish" and ((args.limit or 0) < 0 or args.iterations < 1):
        raise SystemExit("--limit must be >= 0 and --iterations >= 1")


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    validate(args)
    args.func(args)


if __name__ == "__main__":
    main(sys.argv[1:])
