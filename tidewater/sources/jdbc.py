"""Database tables over JDBC.

The reference copies one warehouse table to another through a vendor
connector with no partitioning, so the whole table streams through one task.
Here the read is split on a numeric or date column into ``num_partitions``
ranges; the bounds are asked from the database itself (one ``min``/``max``
query), so no table data passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_$#]*$|^\"[^\"]+\"$")


def qualified_name(schema: str | None, table: str) -> str:
    """``schema.table`` after checking both parts are plain identifiers."""
    for part in (schema, table):
        if part is not None and not _IDENTIFIER.match(part):
            raise ValueError(f"not a plain SQL identifier: {part!r}")
    return f"{schema}.{table}" if schema else table


def connection_options(
    url: str,
    user: str | None = None,
    password: str | None = None,
    password_env: str | None = None,
    driver: str | None = None,
) -> dict[str, str]:
    """Connection options. Prefer ``password_env`` to keep secrets off argv."""
    opts = {"url": url}
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password_env:
        password = os.environ.get(password_env)
        if password is None:
            raise KeyError(f"environment variable {password_env} is not set")
    if password is not None:
        opts["password"] = password
    return opts


def column_bounds(
    spark: SparkSession, conn: dict[str, str], table: str, column: str
) -> tuple[object, object]:
    """(min, max) of ``column``, computed by the database."""
    name = qualified_name(None, column)
    row = (
        spark.read.format("jdbc")
        .options(**conn)
        .option("query", f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}")
        .load()
        .first()
    )
    return row[0], row[1]


def range_read_options(
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: object | None = None,
    upper_bound: object | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for one table; a range-partitioned read when
    ``partition_column`` and both bounds are given."""
    opts = {"dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column and lower_bound is not None and upper_bound is not None:
        n = num_partitions or 1
        if lower_bound == upper_bound:
            n = 1
            upper_bound = _next(upper_bound)
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(n),
        )
    return opts


def read_table(
    spark: SparkSession,
    conn: dict[str, str],
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: object | None = None,
    upper_bound: object | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Whole-table read; parallel when ``partition_column`` is given.

    Bounds only shape the ranges (rows outside them are still read by the
    first and last partition); missing bounds are fetched from the database.
    """
    if partition_column:
        if num_partitions is None:
            num_partitions = spark.sparkContext.defaultParallelism
        if lower_bound is None or upper_bound is None:
            lo, hi = column_bounds(spark, conn, table, partition_column)
            lower_bound = lo if lower_bound is None else lower_bound
            upper_bound = hi if upper_bound is None else upper_bound
    opts = range_read_options(
        table, partition_column, num_partitions, lower_bound, upper_bound, fetch_size
    )
    return spark.read.format("jdbc").options(**conn).options(**opts).load()


def equi_depth_cuts(values: DataFrame, column: str, num_partitions: int) -> list[object]:
    """Values of ``column`` that cut its rows into about equal parts, ascending.

    The quantiles come from one aggregation over the one column; each cut is an
    existing value, and a value that fills several parts is there once.
    """
    if num_partitions < 2:
        return []
    at = [i / num_partitions for i in range(1, num_partitions)]
    accuracy = max(10_000, 20 * num_partitions)
    kind = values.schema[column].dataType
    # Dates and times have quantiles as whole numbers of their own order.
    order = {"date": f"unix_date({column})", "timestamp": f"unix_micros({column})"}.get(kind.simpleString(), column)
    back = {"date": F.date_from_unix_date, "timestamp": F.timestamp_micros}.get(kind.simpleString(), lambda c: c)
    found = values.agg(F.percentile_approx(F.expr(order), at, accuracy).alias("cuts")).select(
        F.transform("cuts", lambda c: back(c)).alias("cuts")).first().cuts
    return sorted(set(found or []))


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no range literal for {value!r}")
    if isinstance(value, int | float | decimal.Decimal):
        return str(value)
    kind = {dt.datetime: "TIMESTAMP", dt.date: "DATE"}.get(type(value))
    if kind is None and not isinstance(value, str):
        raise TypeError(f"no range literal for {value!r}")
    text = str(value).replace("'", "''")
    return f"{kind} '{text}'" if kind else f"'{text}'"


def range_predicates(column: str, cuts: list[object]) -> list[str]:
    """Conditions, one a partition, that put every row on exactly one side of each
    cut; rows without a value are in the first."""
    name, marks = qualified_name(None, column), [_literal(c) for c in cuts]
    if not marks:
        return ["1 = 1"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{name} < {marks[0]} OR {name} IS NULL", *inner, f"{name} >= {marks[-1]}"]


def read_table_balanced(
    spark: SparkSession,
    conn: dict[str, str],
    table: str,
    partition_column: str,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Whole-table read in ranges that hold about the same number of rows.

    ``read_table`` cuts the value range evenly, so a skewed column fills one
    partition. Here the column alone is read first, in even ranges, and its
    quantiles cut the second read. Rows of one value stay together.
    """
    n = num_partitions or spark.sparkContext.defaultParallelism
    column = read_table(spark, conn, table, partition_column, n, fetch_size=fetch_size).select(partition_column)
    predicates = range_predicates(partition_column, equi_depth_cuts(column, partition_column, n))
    properties = {k: v for k, v in conn.items() if k != "url"} | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(conn["url"], table, predicates=predicates, properties=properties)


def _next(value: object) -> object:
    if isinstance(value, int):
        return value + 1
    return value
