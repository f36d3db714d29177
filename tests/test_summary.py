import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators.summary import dimension_summary
from tidewater.plans import standins as S
from tidewater.sinks.files import write_json, write_sorted_single_file

from conftest import SF_SMALL

DIM = [("UA", "United"), ("AA", "American"), ("ZZ", "NoFlights")]
FACTS = [("AA", -22), ("UA", 1235), ("UA", None), ("XX", 7), (None, 9), ("AA", None)]
EXPECTED = [("American", 2, "-22.00"), (None, 1, "8.00"), ("United", 2, "1,235.00")]


def _summary(spark, dim, facts, strategy):
    d = spark.createDataFrame(dim, "IATA_CODE string, AIRLINE string")
    f = spark.createDataFrame(facts, "AIRLINE string, ARRIVAL_DELAY int")
    return dimension_summary(f, d, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE",
                             strategy=strategy)


@pytest.mark.parametrize("strategy", ["auto", "direct", "preagg"])
def test_fixture_summary_in_order(spark, strategy):
    rows = [tuple(r) for r in _summary(spark, DIM, FACTS, strategy).collect()]
    assert rows == EXPECTED


@pytest.mark.parametrize("strategy", ["direct", "preagg"])
def test_duplicate_dimension_key_doubles(spark, strategy):
    rows = dict((r[0], r[1]) for r in _summary(spark, DIM + [("UA", "United")], FACTS, strategy).collect())
    assert rows["United"] == 4 and rows["American"] == 2


@pytest.mark.parametrize("strategy", ["direct", "preagg"])
def test_all_null_group_sorts_first(spark, strategy):
    dim = DIM + [("DL", "Delta")]
    rows = _summary(spark, dim, FACTS + [("DL", None)], strategy).collect()
    assert tuple(rows[0]) == ("Delta", 1, None)


def test_preagg_equals_direct_on_tables(spark):
    fact, dim = S.fact_table(spark, SF_SMALL), S.dimension_table(spark, SF_SMALL)
    args = ("AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    direct = dimension_summary(fact, dim, *args, strategy="direct")
    preagg = dimension_summary(fact, dim, *args, strategy="preagg")
    assert direct.collect() == preagg.collect()


def test_direct_plan_broadcasts_and_stays_in_jvm(spark):
    fact, dim = S.fact_table(spark, SF_SMALL), S.dimension_table(spark, SF_SMALL)
    df = dimension_summary(fact, dim, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE",
                           strategy="direct")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "Python" not in plan


def test_fact_scan_reads_two_columns(spark):
    fact, dim = S.fact_table(spark, SF_SMALL), S.dimension_table(spark, SF_SMALL)
    df = dimension_summary(fact, dim, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "l_extendedprice" not in plan
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_json_omits_null_name_and_refuses_existing_path(spark, scratch):
    path = scratch("json")
    df = _summary(spark, DIM, FACTS, "auto")
    write_json(df, path)
    objs = [json.loads(line) for f in glob.glob(os.path.join(path, "part-*"))
            for line in open(f)]
    assert {"FLIGHTS_COUNT": 1, "AVG_ARRIVAL_DELAY_MINUTES": "8.00"} in objs
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_json(df, path)


def test_single_sorted_file(spark, scratch):
    from pyspark.sql import functions as F

    path = scratch("single")
    d = spark.createDataFrame(DIM, "IATA_CODE string, AIRLINE string")
    f = spark.createDataFrame(FACTS, "AIRLINE string, ARRIVAL_DELAY int").repartition(4)
    from tidewater.operators.summary import AVG_COL, AVG_TEXT_COL, summary_aggregate

    agg = summary_aggregate(f, d, "AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    agg = agg.withColumn(AVG_TEXT_COL, F.format_number(AVG_COL, 2))
    write_sorted_single_file(agg, path, [F.col(AVG_COL).asc_nulls_first()], drop_cols=[AVG_COL])
    files = glob.glob(os.path.join(path, "part-*"))
    assert len(files) == 1
    names = [json.loads(line).get("AIRLINE_NAME") for line in open(files[0])]
    assert names == ["American", None, "United"]


def test_broadcast_bound_counts_bytes(spark):
    from tidewater.operators.joins import fits_broadcast

    dim = spark.createDataFrame([(1, "x" * 1000), (2, "y" * 1000)], "k long, name string")
    assert fits_broadcast(dim, max_rows=10, max_bytes=10_000)
    assert not fits_broadcast(dim, max_rows=10, max_bytes=1_000)
    assert not fits_broadcast(dim, max_rows=1)


def test_broadcast_bound_counts_nested_values(spark):
    from tidewater.operators.joins import fits_broadcast, join_dimension

    dim = spark.createDataFrame([(k, [0.125] * 500) for k in range(20)], "dk long, v array<double>")
    assert not fits_broadcast(dim, max_rows=100, max_bytes=20 * 500 * 4)
    assert fits_broadcast(dim, max_rows=100, max_bytes=200_000)
    fact = spark.range(100).select(F.col("id").alias("k"))
    joined = join_dimension(fact, dim, fact["k"] == dim["dk"], max_bytes=10_000)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_direct_falls_back_beyond_the_bound(spark):
    fact, dim = S.fact_table(spark, SF_SMALL), S.dimension_table(spark, SF_SMALL)
    args = ("AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    small = dimension_summary(fact, dim, *args, strategy="direct", max_broadcast_rows=2)
    assert "Broadcast" not in small._jdf.queryExecution().executedPlan().toString()
    assert small.collect() == dimension_summary(fact, dim, *args).collect()


def test_ordering_plan_follows_the_dimension_files(spark, monkeypatch):
    import tidewater.operators.summary as module

    fact, dim = S.fact_table(spark, SF_SMALL), S.dimension_table(spark, SF_SMALL)
    args = ("AIRLINE", "ARRIVAL_DELAY", "IATA_CODE", "AIRLINE")
    small = dimension_summary(fact, dim, *args)
    monkeypatch.setattr(module, "ONE_PARTITION_BYTES", 0)
    large = dimension_summary(fact, dim, *args)
    assert "rangepartitioning" in large._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in small._jdf.queryExecution().executedPlan().toString()
    assert small.collect() == large.collect()


def test_large_result_is_written_in_ordered_parts(spark, scratch):
    path = scratch("parts")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted_single_file(df, path, ["k"], max_rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(os.path.join(path, "part-*")))
    assert len(files) > 1
    assert [json.loads(line)["k"] for f in files for line in open(f)] == list(range(5000))


def test_over_bound_dimension_is_merge_joined(spark):
    from pyspark.sql import functions as F

    from tidewater.operators.joins import join_dimension

    fact = spark.range(100).select(F.col("id").alias("k"))
    dim = spark.range(50).select(F.col("id").alias("dk"))
    small = join_dimension(fact, dim, fact["k"] == dim["dk"])
    large = join_dimension(fact, dim, fact["k"] == dim["dk"], max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert large.count() == 100
