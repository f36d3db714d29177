"""A key holding a third of the fact rows, with a dimension too large to
broadcast: AQE splits the hot partition of the shuffle join."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.operators.joins import heavy_keys, join_dimension, salted_join
from tidewater.operators.summary import summary_aggregate


def test_hot_key_join_is_split(spark):
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("code"),
            (F.col("id") % 50).cast("int").alias("delay"),
        )
        dim = spark.range(1000).select(F.col("id").alias("dim_code"),
                                       F.concat(F.lit("n"), F.col("id")).alias("name"))
        # A dimension over the broadcast bound: sort-merge join, hot key split.
        joined = join_dimension(fact, dim, fact["code"] == dim["dim_code"], "left", max_rows=10)
        assert len(joined.collect()) == n
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "isSkewJoin=true" in final or "skew=true" in final
        # The summary's default plan aggregates the hot key before any join.
        agg = summary_aggregate(fact, dim, "code", "delay", "dim_code", "name")
        assert agg.filter(F.col("AIRLINE_NAME") == "n7").first()["FLIGHTS_COUNT"] > n // 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def plain_shuffles(spark):
    """No help from Spark's adaptive plans, and sixteen partitions."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed(spark, n=24_000):
    """A third of the rows on one key, a sixth on another, a sixth without one."""
    i = F.col("id")
    code = F.when(i % 3 == 0, 7).when(i % 6 == 1, 11).when(i % 6 == 2, None).otherwise(i % 997)
    fact = spark.range(n, numPartitions=6).select(code.cast("long").alias("code"), i.alias("fact_id"))
    dim = spark.range(900).select(F.when(F.col("id") == 5, None).otherwise(F.col("id")).alias("dim_code"),
                                  F.concat(F.lit("n"), F.col("id")).alias("name"))
    return fact, dim.union(dim.filter("dim_code in (7, 13)").withColumn("name", F.lit("twice")))


def _task_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_has_the_same_rows_and_no_hot_task(spark, plain_shuffles, how):
    fact, dim = _skewed(spark)
    plain = fact.join(dim.hint("shuffle_merge"), fact["code"] == dim["dim_code"], how)
    salted = salted_join(fact, dim, "code", "dim_code", how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    # A plain shuffle brings the hot key to one task; salted, none holds far more than its part.
    matched = salted.filter("code is not null")
    assert max(_task_sizes(plain)) >= 8_000
    assert max(_task_sizes(matched)) <= 3 * matched.count() / 16
    text = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text


def test_heavy_keys_are_counted_exactly(spark, plain_shuffles):
    fact, _ = _skewed(spark)
    got = {r.key: (r.rows, r.salts) for r in heavy_keys(fact.filter("code is not null"), "code", 1 / 32).collect()}
    n = Counter(r.code for r in fact.collect() if r.code is not None)
    least = sum(n.values()) / 32
    assert got == {k: (c, math.ceil(c / least)) for k, c in n.items() if c > least} and set(got) == {7, 11}
    flat = spark.range(5_000).select((F.col("id") % 500).alias("code"))
    assert heavy_keys(flat, "code", 1 / 32).collect() == []


def test_salted_join_of_empty_sides(spark, plain_shuffles):
    fact, dim = _skewed(spark, 300)
    assert salted_join(fact.limit(0), dim, "code", "dim_code").collect() == []
    assert salted_join(fact, dim.limit(0), "code", "dim_code").count() == 300
    nulls = fact.withColumn("code", F.lit(None).cast("long"))
    assert salted_join(nulls, dim, "code", "dim_code").filter("name is null").count() == 300
    assert salted_join(nulls, dim, "code", "dim_code", "inner").count() == 0
