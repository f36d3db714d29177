import pytest

from tidewater.functions.numbers import format_2dp
from tidewater.functions.text import split_lines, tokenize


@pytest.mark.parametrize(
    "line,tokens",
    [
        ("Élan vital²x a_b", ["Élan", "vital²x", "a_b"]),
        ("", []),
        ("   ", []),
        ("...!?", []),
        ("  hello, world!  ", ["hello", "world"]),
        ("日本語 テキスト", ["日本語", "テキスト"]),
    ],
)
def test_tokenize(spark, line, tokens):
    assert spark.createDataFrame([(line,)], "l string").select(tokenize("l")).first()[0] == tokens


def test_tokenize_matches_python_unicode_word_class(spark):
    import re

    sample = ["naïve café—déjà vu", "x²+y³=z", "ß ſ ǅ", "tab\tsep", "under_score 42", "१२३ ٤٥"]
    df = spark.createDataFrame([(s,) for s in sample], "l string")
    got = [r[0] for r in df.select(tokenize("l")).collect()]
    assert got == [list(filter(None, re.split(r"\W+", s.strip()))) for s in sample]


@pytest.mark.parametrize(
    "text,lines",
    [("a", ["a"]), ("a\nb", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("a\n", ["a"]),
     ("a\n\n", ["a", ""]), ("", [""])],
)
def test_split_lines(spark, text, lines):
    assert spark.createDataFrame([(text,)], "t string").select(split_lines("t")).first()[0] == lines


def test_format_number_cases(spark):
    values = [0.125, 0.135, 2.675, 1234567.005, -0.001, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(format_2dp("x")).collect()]
    assert got == ["0.12", "0.14", "2.67", "1,234,567.00", "-0.00", None, "NaN", "∞"]
