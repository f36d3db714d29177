from tidewater.operators.layout import spread

from conftest import SF_SMALL


def test_spread_small_input(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    spread_df = spread(df, 8)
    assert spread_df.rdd.getNumPartitions() == 8
    assert spread_df.count() == df.count()


def test_spread_leaves_many_files_alone(spark, scratch):
    path = scratch("many")
    spark.range(1000).repartition(10).write.parquet(path)
    df = spark.read.parquet(path)
    assert spread(df, 4) is df
