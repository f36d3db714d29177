from pyspark.sql import functions as F

from tidewater.operators.replay import (
    capped_lines,
    corpus_tokens,
    nonempty_lines,
    replay,
    replay_counts,
    to_messages,
)
from tidewater.functions.records import explode_words, parse_records

DOCS = [(0, "Hello, world!\n\n  ...  \nsecond line"), (1, "third\r\nfourth line here"), (2, "")]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def test_corpus_lines_and_tokens(spark):
    rows = [(r.doc_id, r.line_no, r.tokens) for r in corpus_tokens(_docs(spark)).collect()]
    assert sorted(rows) == [
        (0, 0, ["Hello", "world"]), (0, 1, []), (0, 2, []), (0, 3, ["second", "line"]),
        (1, 0, ["third"]), (1, 1, ["fourth", "line", "here"]), (2, 0, []),
    ]


def test_cap_is_exact_and_ordered(spark):
    lines = nonempty_lines(corpus_tokens(_docs(spark)))
    got = [(r.doc_id, r.line_no) for r in capped_lines(lines, 3).collect()]
    assert got == [(0, 0), (0, 3), (1, 0)]


def test_no_cap_by_default(spark):
    lines = nonempty_lines(corpus_tokens(_docs(spark)))
    assert capped_lines(lines) is lines
    spread = replay(capped_lines(lines, 3), 1, "2024-01-01 00:00:00", bounded_rows=3)
    assert spread.count() == 3
    assert "RoundRobin" in spread._jdf.queryExecution().executedPlan().toString()


def test_replay_stamps_and_counts(spark):
    lines = capped_lines(nonempty_lines(corpus_tokens(_docs(spark))), 3)
    counts = sorted((r.iteration, r.time_key.isoformat(), r.lines_sent)
                    for r in replay_counts(lines, 2, "2024-01-01 00:00:00").collect())
    assert replay_counts(lines.limit(0), 2, "2024-01-01 00:00:00").collect() == []
    assert counts == [(1, "2024-01-01T00:00:00", 3), (2, "2024-01-01T00:01:00", 3)]


def test_message_format_and_consumer_roundtrip(spark):
    lines = nonempty_lines(corpus_tokens(_docs(spark)))
    msgs = to_messages(replay(lines, 1, "2024-01-01 00:00:00"))
    first = msgs.select(F.col("key").cast("string"), F.col("value").cast("string")).collect()
    assert ("2024-01-01T00:00:00.000000", "2024-01-01T00:00:00.000000 Hello world") in [
        tuple(r) for r in first
    ]
    # The consumer's fixed slice reads back each word plus one phantom empty word.
    words = explode_words(parse_records(msgs.selectExpr("CAST(value AS STRING) AS value")))
    got = sorted(r.value for r in words.collect())
    assert got.count("") == 4 and "Hello" in got and "here" in got


def test_replay_plan_has_no_join(spark):
    lines = nonempty_lines(corpus_tokens(_docs(spark)))
    plan = replay(lines, 3, "2024-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


def test_line_tokens_tokenise_once(spark):
    from tidewater.operators.replay import line_tokens

    df = spark.createDataFrame([(1, "a b"), (2, "...")], "i int, value string")
    out = nonempty_lines(line_tokens(df, ["i"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2  # one for each word class, in one place
    assert [(r.i, r.tokens) for r in out.collect()] == [(1, ["a", "b"])]
