import pytest
from pyspark.sql import functions as F

from tidewater.functions.records import explode_words, java_split, parse_records, split_malformed

# FIXTURES.md record-parsing table (default fixed-width mode).
GOOD = [
    ("2022-01-01T00:00:00+00:00 foo bar", ["foo", "bar"]),
    ("2022-01-01T00:00:00.123456 a b", ["", "a", "b"]),
    ("2022-01-01T00:00:00+09:00 a  b  ", ["a", "", "b"]),
    ("2022-01-01T00:00:00+00:00 ", [""]),
    ("2022-01-01T00:00:00+00:00    ", []),
    ("2022-01-01T00:00:00 hello world", ["world"]),
]
BAD = ["2022-01-01T00:00:00+00:00", "short", None, "2022-13-01T00:00:00+00:00 x"]


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fixed_width_words(spark):
    parsed = parse_records(_frame(spark, [v for v, _ in GOOD]), keep=["value"])
    rows = parsed.select("value", "timestamp", java_split("message").alias("w")).collect()
    got = {r.value: (r.timestamp.isoformat(), r.w) for r in rows}
    for value, words in GOOD:
        assert got[value] == ("2022-01-01T00:00:00", words), value


def test_offset_is_ignored(spark):
    ts = parse_records(_frame(spark, ["2022-01-01T05:00:00+09:00 a"])).first().timestamp
    assert ts.hour == 5


@pytest.mark.parametrize("value", BAD)
def test_failfast_raises(spark, value):
    with pytest.raises(Exception, match="malformed record"):
        parse_records(_frame(spark, [value])).collect()


def test_quarantine_keeps_bad_rows_aside(spark):
    parsed = parse_records(_frame(spark, [v for v, _ in GOOD] + BAD), mode="quarantine")
    good, bad = split_malformed(parsed)
    assert good.count() == len(GOOD)
    assert bad.count() == len(BAD)
    assert good.filter(F.col("timestamp").isNull()).count() == 0


def test_first_space_has_no_phantom_word(spark):
    df = _frame(spark, ["2022-01-01T00:00:00.123456 a b", "2022-01-01T00:00:00 hello world"])
    words = explode_words(parse_records(df, record_format="first_space"))
    assert sorted(r.value for r in words.collect()) == ["a", "b", "hello", "world"]


@pytest.mark.parametrize(
    "text,expected",
    [("", [""]), ("   ", []), ("a", ["a"]), (" a", ["", "a"]), ("a  b  ", ["a", "", "b"]),
     ("a b", ["a", "b"]), ("  a ", ["", "", "a"])],
)
def test_java_split_rules(spark, text, expected):
    assert spark.createDataFrame([(text,)], "m string").select(java_split("m")).first()[0] == expected


def test_parse_plan_is_native(spark):
    df = explode_words(parse_records(_frame(spark, ["2022-01-01T00:00:00+00:00 a"])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "MapPartitions" not in plan
    assert "ArrowEvalPython" not in plan


def test_java_split_keeps_line_break_word(spark):
    # Java: "a \n".split(" ") -> ["a", "\n"]; the trailing space is not at the end.
    got = spark.createDataFrame([("a \n",)], "m string").select(java_split("m")).first()[0]
    assert got == ["a", "\n"]


@pytest.mark.parametrize("column", ["timestamp", "message"])
def test_failfast_survives_column_pruning(spark, column):
    df = _frame(spark, ["2022-01-01T00:00:00+00:00 ok", "short"])
    with pytest.raises(Exception, match="malformed record"):
        parse_records(df).select(column).collect()


def test_failfast_in_word_counts(spark):
    df = _frame(spark, ["2022-01-01T00:00:00+00:00 ok", None])
    words = explode_words(parse_records(df))
    with pytest.raises(Exception, match="malformed record"):
        words.groupBy("value").count().collect()


def test_window_filter_not_duplicated(spark):
    from tidewater.operators.windows import windowed_counts

    df = _frame(spark, ["2022-01-01T00:00:00+00:00 a b"]).repartition(2)
    plan = windowed_counts(explode_words(parse_records(df)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Filter" not in plan
