import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.limits import first_rows


def _frame(spark, rows, parts=16):
    return spark.createDataFrame(rows, "doc_id long, line_no int, v string").repartition(parts)


@pytest.mark.parametrize("n", [1, 7, 250, 999])
def test_threshold_path_is_exact(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.randrange(300), i, f"x{i}") for i in range(1000)]
    got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], n, plain_rows=0, merge_rows=50)
    want = sorted(rows)[:n]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_hot_leading_key(spark):
    # One doc holds a third of all lines and straddles the cut.
    rows = [(5, i, "h") for i in range(400)] + [(i, 0, "c") for i in range(800)]
    got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], 300, plain_rows=0, merge_rows=50)
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)[:300]


def test_fewer_rows_than_n(spark):
    rows = [(i, 0, "a") for i in range(10)]
    got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], 50, plain_rows=0, merge_rows=50)
    assert got.count() == 10


def test_small_path_is_top_k(spark):
    rows = [(i, 0, "a") for i in range(100)]
    df = first_rows(_frame(spark, rows, 4), ["doc_id", "line_no"], 5)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_bound_filter_reaches_scan(spark, scratch):
    path = scratch("limits")
    spark.range(0, 20000).select(F.col("id").alias("doc_id"), F.lit(0).alias("line_no")) \
        .repartition(20).write.parquet(path)
    df = spark.read.parquet(path)
    got = first_rows(df, ["doc_id", "line_no"], 100, plain_rows=0, merge_rows=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id" in plan
    assert sorted(r.doc_id for r in got.collect()) == list(range(100))


def test_null_keys_come_first_on_both_plans(spark):
    rows = [(None, i, "n") for i in range(5)] + [(i % 90, i, "x") for i in range(1000)] + [(3, None, "y")]
    key = lambda r: tuple((v is not None, v or 0) for v in r[:2])
    for n in (3, 20, 60, 1003):
        want = sorted(sorted(rows, key=key)[:n], key=str)
        for plain_rows in (0, 10**6):
            got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], n, plain_rows=plain_rows, merge_rows=40)
            assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_no_job_before_the_plan(spark):
    # A plan for a small n is built without running anything upstream.
    boom = spark.range(10).select(F.raise_error(F.lit("ran")).cast("long").alias("doc_id"))
    assert first_rows(boom, ["doc_id"], 5).columns == ["doc_id"]


def test_empty_input(spark):
    df = spark.createDataFrame([], "doc_id long, line_no int, v string").repartition(4)
    assert first_rows(df, ["doc_id", "line_no"], 10, plain_rows=0, merge_rows=50).count() == 0


def test_large_n_small_fraction(spark):
    # n far below the row count: the sample-based bound path with real sampling.
    df = spark.range(0, 200000, numPartitions=16).select(
        (F.col("id") * 7919 % 200000).alias("doc_id"), F.lit(0).alias("line_no")
    )
    got = first_rows(df, ["doc_id", "line_no"], 5000, plain_rows=0, merge_rows=50)
    assert sorted(r.doc_id for r in got.collect()) == list(range(5000))


def test_string_and_constant_lead(spark):
    # File order: constant file name (one file), then block, then row.
    rows = [("f.txt", b * 1000, r, "x") for b in range(8) for r in range(50)]
    df = spark.createDataFrame(rows, "file string, block long, row long, v string").repartition(8)
    got = first_rows(df, ["file", "block", "row"], 120, plain_rows=0, merge_rows=50)
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)[:120]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "named_struct" in plan or "struct" in plan.lower()


def _merged_rows(got):
    """The most rows that one task of the final merge can be given."""
    plan = got._jdf.queryExecution().executedPlan().toString()
    return plan.count("TakeOrderedAndProject")


@pytest.mark.parametrize("n", [1, 40, 299, 700, 1199, 1200])
def test_ties_are_cut_exactly_without_a_merge(spark, n):
    # 300 rows, then 800 ties of one key, then 100 more: the cut lies before, in and after them.
    rows = [(i // 3, None, "a") for i in range(300)] + [(200, 7, f"t{i % 9}") for i in range(800)] + [
        (300 + i, 0, "z") for i in range(100)]
    got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], n, plain_rows=0, merge_rows=20)
    out = [tuple(r) for r in got.collect()]
    assert sorted(r[0] for r in out) == sorted(r[0] for r in rows)[:n]
    assert not set(out) - set(rows) and len(out) == n
    if n == 700:  # in the ties: nothing is sorted in one task
        assert _merged_rows(got) == 0


def test_only_ties(spark):
    rows = [(None, None, "same")] * 500
    got = first_rows(_frame(spark, rows), ["doc_id", "line_no"], 333, plain_rows=0, merge_rows=10)
    assert [tuple(r) for r in got.collect()] == rows[:333]


def test_the_merge_stays_small(spark):
    # Before: 2n rows, or the tops of every task, were merged in one task.
    from tidewater.operators import limits

    seen, between = [], limits._between

    def counted(df, cols, low, high):
        out = between(df, cols, low, high)
        seen.append(out)
        return out

    limits._between, df = counted, spark.range(0, 300_000, numPartitions=12).select(
        (F.col("id") * 7919 % 300_007).alias("doc_id"), F.lit(0).alias("line_no"))
    try:
        got = first_rows(df, ["doc_id", "line_no"], 120_000, plain_rows=0, merge_rows=2_000)
    finally:
        limits._between = between
    assert seen[-1].count() <= 2_000 and len(seen) <= 9  # three rounds at most
    want = sorted(i * 7919 % 300_007 for i in range(300_000))[:120_000]
    assert sorted(r.doc_id for r in got.collect()) == want


def test_mixed_types_and_not_a_number(spark):
    draw = random.Random(8)
    values = [None, float("nan"), float("-inf"), float("inf"), -0.5, 0.0, 2.5]
    rows = [(draw.choice(values), draw.choice([None, "", "a", "b"]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "x double, s string, i int").repartition(7)
    got = first_rows(df, ["x", "s", "i"], 450, plain_rows=0, merge_rows=30)
    want = df.orderBy("x", "s", "i").limit(450)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
