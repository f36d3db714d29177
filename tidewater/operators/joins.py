"""Fact-to-dimension joins: a proven broadcast bound, and salted keys beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# What may be copied to every executor: at most this many rows and this many
# bytes of payload (measured, not estimated from compressed file sizes).
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
_FIXED_WIDTH = 8


def _row_bytes(df: DataFrame) -> Column:
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType | BinaryType):
            parts.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + _FIXED_WIDTH)
        elif isinstance(field.dataType, ArrayType | MapType | StructType):
            # Nested values count with their JSON text, which holds every element.
            text = F.to_json(F.struct(F.col(field.name)))
            parts.append(F.octet_length(text) + _FIXED_WIDTH)
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast("long")


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One distributed aggregation: each task counts its rows and sums their
    payload sizes, and only those partial sums are merged. (A
    ``limit(max_rows + 1)`` would move up to ``max_rows + 1`` rows from every
    task into one.)
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def bounded_side(
    dim: DataFrame,
    check: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``dim`` marked for broadcast when it passes the bound, else for a
    sort-merge join (no broadcast on an unproven estimate)."""
    if not check:
        return dim
    if fits_broadcast(dim, max_rows, max_bytes):
        return F.broadcast(dim)
    return dim.hint("shuffle_merge")


def heavy_keys(fact: DataFrame, key: str, share: float) -> DataFrame:
    """``(key, rows, salts)`` of the keys with more than ``share`` of all rows.

    One pass without a shuffle finds a superset of at most ``1 / share`` keys
    (Misra-Gries counters), a second counts just these. A key gets as many salts as
    it holds shares.
    """
    found = fact.freqItems([key], max(share, 1e-4)).first()[0]
    candidates = [v for v in found if v is not None]
    total = fact.agg(F.count(F.lit(1))).first()[0]
    rows = fact.filter(F.col(key).isin(candidates)) if candidates else fact.limit(0)
    least = max(1.0, share * total)
    return (
        rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > least)
        .withColumn("salts", F.ceil(F.col("rows") / least).cast("int"))
    )


def salted_join(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "left",
                share: float | None = None) -> DataFrame:
    """Equi-join with a dimension too large to broadcast, without a hot task.

    A fact key with more than ``share`` of the rows (by default half a shuffle
    partition's) is salted: its rows are dealt to several values of a second join
    column, and its dimension rows are repeated for each. All keys then meet in one
    shuffle join whose tasks hold about a share of any key. Fact rows with a null
    key match nothing and take no part in the shuffle. Salts follow a row's place
    in its task, so they come out the same when a task runs again.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    spark = fact.sparkSession
    if share is None:
        share = 0.5 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = fact.filter(F.col(key).isNotNull())
    # At most 1 / share rows, which is bounded by the shuffle's width; kept on the
    # driver, so that the plan does not count them again.
    found = heavy_keys(known, key, share).select("key", "salts")
    heavy = F.broadcast(spark.createDataFrame(found.collect(), found.schema))
    salts, salt = F.coalesce(F.col("salts"), F.lit(1)), "__salt"
    place = F.monotonically_increasing_id()
    left = known.withColumn("__place", place).join(heavy, F.col(key) == F.col("key"), "left")
    left = left.withColumn(salt, (F.col("__place") % salts).cast("int")).drop("__place", "key", "salts")
    right = dim.join(heavy, F.col(dim_key) == F.col("key"), "left")
    right = right.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), salts - 1))).drop("key", "salts")
    on = (left[key] == right[dim_key]) & (left[salt] == right["__salt_of"])
    joined = left.join(right.hint("shuffle_merge"), on, how).drop(salt, "__salt_of")
    if how == "inner":
        return joined
    unmatched = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    return joined.union(fact.filter(F.col(key).isNull()).select("*", *unmatched))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: Column,
    how: str = "left",
    check: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` to a dimension.

    With ``check`` (default) the dimension is measured first and broadcast
    only within ``MAX_BROADCAST_ROWS`` / ``MAX_BROADCAST_BYTES``; beyond that
    the join is a sort-merge join, where AQE splits hot-key partitions.
    ``check=False`` leaves the choice to Spark's planner (size estimates).
    """
    return fact.join(bounded_side(dim, check, max_rows, max_bytes), on, how)
