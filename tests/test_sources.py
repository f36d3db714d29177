import os

import pytest
from pyspark.sql.types import StructType

from tidewater.sinks.kafka import kafka_sink_options
from tidewater.sources.csv import read_csv
from tidewater.sources.jdbc import connection_options, qualified_name
from tidewater.sources.kafka import (
    PlainAuth,
    SaslModuleAuth,
    kafka_source_options,
)
from tidewater.sources.text import read_lines

from conftest import SF_SMALL


def test_csv_inference_narrows_and_explicit_schema_keeps(spark, scratch):
    path = scratch("csv")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.write.option("header", "true").csv(path)
    inferred = read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["o_orderkey"] == "int"
    explicit = read_csv(spark, path, schema=orders.schema)
    assert explicit.schema == orders.schema
    assert explicit.exceptAll(orders).count() == 0


def test_csv_code_leading_zero(spark, scratch):
    path = scratch("codes")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as fh:
        fh.write("IATA_CODE,DEPARTURE\nAA,0005\n")
    assert read_csv(spark, path, infer=True).first().DEPARTURE == 5
    assert read_csv(spark, path).first().DEPARTURE == "0005"


def test_text_lines(spark, scratch):
    path = scratch("text")
    os.makedirs(path)
    with open(f"{path}/a.txt", "w", newline="") as fh:
        fh.write("a\nb\r\nc\rd\n")
    assert [r.value for r in read_lines(spark, path).collect()] == ["a", "b", "c", "d"]


def test_kafka_plain_options_and_secret_hygiene():
    opts = kafka_source_options("host:9092", "t1", PlainAuth("user", "p\"w"))
    assert opts["startingOffsets"] == "latest"
    assert opts["kafka.max.partition.fetch.bytes"] == "1048576"
    assert opts["kafka.security.protocol"] == "SASL_SSL"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    assert opts["kafka.sasl.jaas.config"] == (
        'org.apache.kafka.common.security.plain.PlainLoginModule required '
        'username="user" password="p\\"w";'
    )
    assert "p\"w" not in repr(PlainAuth("user", "p\"w"))


def test_kafka_module_auth_is_closed():
    auth = SaslModuleAuth("RSA-SHA256", "example.LoginModule", (("intent", "pool:abc"),))
    jaas = kafka_source_options("h:1", "t", auth)["kafka.sasl.jaas.config"]
    assert jaas == 'example.LoginModule required intent="pool:abc";'


def test_kafka_sink_options():
    assert kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_qualified_name():
    assert qualified_name("SALES", "ORDERS") == "SALES.ORDERS"
    assert qualified_name(None, "ORDERS") == "ORDERS"
    with pytest.raises(ValueError):
        qualified_name("S", "T; DROP TABLE X")


def test_connection_password_from_env(monkeypatch):
    monkeypatch.setenv("TW_TEST_PW", "s3cret")
    opts = connection_options("jdbc:x://h/db", user="u", password_env="TW_TEST_PW")
    assert opts == {"url": "jdbc:x://h/db", "user": "u", "password": "s3cret"}
    with pytest.raises(KeyError):
        connection_options("jdbc:x://h/db", password_env="TW_MISSING_PW_VAR")


def test_range_read_options():
    from tidewater.sources.jdbc import range_read_options

    assert range_read_options("S.T") == {"dbtable": "S.T", "fetchsize": "10000"}
    opts = range_read_options("S.T", "ID", 4, 1, 1000)
    assert opts["partitionColumn"] == "ID" and opts["numPartitions"] == "4"
    assert (opts["lowerBound"], opts["upperBound"]) == ("1", "1000")
    assert range_read_options("S.T", "ID", 4, 7, 7)["numPartitions"] == "1"
    # Empty table: no bounds, plain read.
    assert "partitionColumn" not in range_read_options("S.T", "ID", 4, None, None)


def test_kafka_missing_package_is_explained(spark):
    from tidewater.sources.kafka import read_kafka_stream

    opts = kafka_source_options("127.0.0.1:1", "t")
    try:
        read_kafka_stream(spark, opts)
    except RuntimeError as exc:
        assert "spark-sql-kafka" in str(exc)
    # With the package present the stream would be created lazily (no broker contact).


def test_csv_inference_on_a_sample(spark, scratch):
    path = scratch("csv-sample")
    spark.range(5000).selectExpr("id AS k", "id * 2 AS v").write.option("header", "true").csv(path)
    df = read_csv(spark, path, infer=True, infer_sampling_ratio=0.1)
    assert dict(df.dtypes)["v"] == "int" and df.count() == 5000


def test_csv_sides_hold_every_line_once(spark, scratch):
    from tidewater.sources.csv import read_csv_sides

    path = scratch("csv-sides")
    os.makedirs(path)
    lines = ["1,2.5,x", "2,bad,y", "z,1,y", "3,,", "4,1.5", "5,1,a,b", ",,", '6,1,"q,r"', '7,1,"open']
    with open(f"{path}/a.csv", "w") as fh:
        fh.write("id,v,name\n" + "\n".join(lines) + "\n\n")
    schema = StructType.fromDDL("id bigint, v double, name string")
    good, rejects = read_csv_sides(spark, path, schema)
    found = sorted((r.id is None, r.id or 0, r.v, r.name) for r in good.collect())
    assert [r[1] for r in found] == [1, 3, 6, 7, 0] and found[2][3] == "q,r"
    assert sorted(r[0] for r in rejects.select("_raw_line").collect()) == ["2,bad,y", "4,1.5", "5,1,a,b", "z,1,y"]
    # A line's side does not depend on the columns that a query reads.
    assert good.select("id").count() == 5 and good.count() + rejects.count() == len(lines)
    assert all(r.file.endswith("a.csv") for r in rejects.collect())
    with pytest.raises(ValueError, match="_raw_line"):
        read_csv_sides(spark, path, StructType.fromDDL("_raw_line string"))


def test_equal_ranges_of_a_skewed_column(spark):
    from tidewater.sources.jdbc import equi_depth_cuts, range_predicates

    n, parts = 40_000, 16
    rows = spark.range(n).selectExpr("case when id % 50 = 0 then null else cast(pow(id / 400.0, 5) as bigint) end as k")
    cuts = equi_depth_cuts(rows, "k", parts)
    sizes = [rows.where(p).count() for p in range_predicates("k", cuts)]
    assert sum(sizes) == n and len(sizes) == parts
    assert max(sizes) <= 1.5 * n / parts
    # Even strides of the value range put most rows in one partition.
    top = rows.selectExpr("max(k)").first()[0]
    assert rows.where(f"k < {top // parts}").count() > 0.5 * n


def test_ranges_of_hot_and_few_values(spark):
    from tidewater.sources.jdbc import equi_depth_cuts, range_predicates

    hot = spark.range(9_000).selectExpr("case when id % 3 = 0 then 7 else id % 100 end as k")
    cuts = equi_depth_cuts(hot, "k", 12)
    assert cuts == sorted(set(cuts))
    sizes = [hot.where(p).count() for p in range_predicates("k", cuts)]
    # A value's rows stay together; no range holds much more than the hot value and its share.
    assert sum(sizes) == 9_000 and max(sizes) <= 3_060 + 2 * 9_000 / 12
    one = spark.range(10).selectExpr("1 as k")
    assert [one.where(p).count() for p in range_predicates("k", equi_depth_cuts(one, "k", 4))] == [0, 10]
    assert range_predicates("k", equi_depth_cuts(one.limit(0), "k", 4)) == ["1 = 1"]
    assert equi_depth_cuts(one, "k", 1) == []


def test_ranges_of_dates_and_text(spark):
    import datetime as dt

    from tidewater.sources.jdbc import equi_depth_cuts, range_predicates

    rows = spark.range(1_000).selectExpr("date_add(date'2024-01-01', cast(id as int)) as d",
                                         "timestamp'2024-01-01 00:00:00.5' + make_interval(0,0,0,0,0,0,id) as t")
    for column in ("d", "t"):
        sizes = [rows.where(p).count() for p in range_predicates(column, equi_depth_cuts(rows, column, 5))]
        assert sum(sizes) == 1_000 and max(sizes) <= 300
    assert range_predicates("d", [dt.date(2024, 1, 2)]) == ["d < DATE '2024-01-02' OR d IS NULL", "d >= DATE '2024-01-02'"]
    assert range_predicates("s", ["O'Neil"])[0] == "s < 'O''Neil' OR s IS NULL"
    with pytest.raises(ValueError):
        range_predicates("k; DROP TABLE x", [1])
    with pytest.raises(TypeError):
        range_predicates("k", [None])
