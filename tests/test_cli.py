import glob
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tidewater.cli import build_parser, main, validate
from tidewater.plans import standins as S
from tidewater.plans.queries import COUNTS_SCHEMA, delay_summary

from conftest import SF_SMALL


@pytest.mark.parametrize("extra", [[], ["--infer-schema"], ["--strategy", "direct"]])
def test_delay_summary_cli_matches_query(spark, scratch, extra):
    root = scratch("cli-etl")
    fact = S.fact_table(spark, SF_SMALL).withColumn("FLIGHT_NUMBER", F.col("l_orderkey"))
    fact.write.option("header", "true").csv(f"{root}/flights")
    S.dimension_table(spark, SF_SMALL).write.option("header", "true").csv(f"{root}/airlines")
    main(["delay-summary", f"{root}/airlines", f"{root}/flights", f"{root}/out", *extra])
    files = glob.glob(f"{root}/out/part-*")
    assert len(files) == 1
    got = [json.loads(line) for line in open(files[0])]
    want = [r.asDict() for r in delay_summary(spark, SF_SMALL).collect()]
    want = [{k: v for k, v in d.items() if v is not None} for d in want]
    assert got == want


def test_publish_keeps_file_order_across_splits(spark, scratch):
    root = scratch("cli-publish")
    os.makedirs(f"{root}/in")
    lines = [f"line {i}, with words: w{i}" if i % 7 else "  ...  " for i in range(400)]
    with open(f"{root}/in/corpus.txt", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "512")
    try:
        main(["publish", "--input", f"{root}/in", "--output", f"{root}/env", "--limit", "50",
              "--iterations", "2", "--base-time", "2024-01-01T00:00:00"])
    finally:
        spark.conf.set(key, old)
    rows = spark.read.parquet(f"{root}/env").select(
        F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v")
    ).collect()
    expected = [" ".join(filter(None, re.split(r"\W+", s.strip()))) for s in lines]
    expected = [e for e in expected if e][:50]
    for stamp in ("2024-01-01T00:00:00.000000", "2024-01-01T00:01:00.000000"):
        got = [r.v[len(stamp) + 1:] for r in rows if r.k == stamp]
        assert sorted(got) == sorted(expected)
        assert all(r.v.startswith(stamp + " ") for r in rows if r.k == stamp)


def test_publish_then_stream_counts(spark, scratch):
    root = scratch("cli-stream")
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/c.txt", "w") as fh:
        fh.write("a b\nb c\n")
    main(["publish", "--input", f"{root}/in", "--output", f"{root}/env/p1",
          "--base-time", "2024-01-01T00:00:00"])
    main(["publish", "--input", f"{root}/in", "--output", f"{root}/env/p2",
          "--base-time", "2024-01-01T00:05:00"])
    main(["stream-counts", "--source-path", f"{root}/env/*", "--checkpoint", f"{root}/ck",
          "--sink", "csv", "--output", f"{root}/out", "--trigger", "available_now",
          "--state-partitions", "2"])
    df = spark.read.schema(COUNTS_SCHEMA).option("nullValue", "\\N").csv(f"{root}/out")
    got = sorted((r.START_TIME.strftime("%H:%M"), r.WORD, r.COUNT) for r in df.collect())
    # Producer times have six fraction digits: one phantom empty word per message.
    assert got == [("00:00", "", 2), ("00:00", "a", 1), ("00:00", "b", 2), ("00:00", "c", 1)]


@pytest.mark.parametrize(
    "argv",
    [
        ["stream-counts", "--checkpoint", "c", "--sink", "csv", "--source-path", "p"],
        ["stream-counts", "--checkpoint", "c", "--sink", "console"],
        ["stream-counts", "--checkpoint", "c", "--sink", "console", "--source-path", "p",
         "--mode", "quarantine"],
        ["publish", "--input", "x"],
        ["publish", "--input", "x", "--bootstrap-servers", "h:1", "--topic", "t"],
        ["publish", "--input", "x", "--output", "o", "--iterations", "0"],
    ],
)
def test_cli_validation(argv):
    with pytest.raises(SystemExit):
        validate(build_parser().parse_args(argv))


def test_unknown_sink_rejected():
    with pytest.raises(SystemExit):
        build_parser().parse_args(["stream-counts", "--checkpoint", "c", "--sink", "kafka"])


def test_stream_counts_quarantine_side_output(spark, scratch):
    root = scratch("cli-quarantine")
    rows = [("2024-01-01T00:00:00.000000 a b",), ("garbage",), ("2024-01-01T00:09:00.000000 c",)]
    env = spark.createDataFrame(rows, "v string").select(
        F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    env.write.parquet(f"{root}/env/p1")
    main(["stream-counts", "--source-path", f"{root}/env/*", "--checkpoint", f"{root}/ck",
          "--sink", "parquet", "--output", f"{root}/out", "--trigger", "available_now",
          "--mode", "quarantine", "--rejects-output", f"{root}/rejects"])
    from tidewater.streaming.word_count import read_rejects

    assert [r.raw_value for r in read_rejects(spark, f"{root}/rejects").collect()] == ["garbage"]
    assert spark.read.parquet(f"{root}/rejects").count() == len(rows)
    got = sorted((r.WORD, r.COUNT) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("", 1), ("a", 1), ("b", 1)]


def test_kafka_cli_options(monkeypatch):
    from tidewater.cli import kafka_auth
    from tidewater.sources.kafka import kafka_source_options

    monkeypatch.setenv("TW_KAFKA_PW", "pw")
    args = build_parser().parse_args(
        ["stream-counts", "--bootstrap-servers", "h:9092", "--topics", "t", "--username", "u",
         "--password-env", "TW_KAFKA_PW", "--checkpoint", "c", "--sink", "console",
         "--max-offsets-per-trigger", "500000", "--min-partitions", "64"])
    validate(args)
    opts = kafka_source_options(args.bootstrap_servers, args.topics, kafka_auth(args),
                                starting_offsets=args.starting_offsets,
                                max_offsets_per_trigger=args.max_offsets_per_trigger,
                                min_partitions=args.min_partitions)
    assert opts["maxOffsetsPerTrigger"] == "500000"
    assert opts["minPartitions"] == "64"
    assert 'password="pw"' in opts["kafka.sasl.jaas.config"]


def test_stream_counts_from_text_records(spark, scratch):
    root = scratch("cli-text")
    os.makedirs(f"{root}/src")
    with open(f"{root}/src/a.txt", "w") as fh:
        fh.write("2022-01-01T00:00:10+00:00 x y\n2022-01-01T00:05:00+00:00 z\n")
    main(["stream-counts", "--source-path", f"{root}/src", "--source-format", "text",
          "--checkpoint", f"{root}/ck", "--sink", "parquet", "--output", f"{root}/out",
          "--trigger", "available_now"])
    got = sorted((r.WORD, r.COUNT) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("x", 1), ("y", 1)]
