"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewater.session import scratch_path


#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let Python workers import the package wherever the driver was started.

    On a cluster without this path, ship the package (``--py-files``).
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, ROOT])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not use yet."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df``, also if the name holds a dot."""
    return df[f"`{name}`"]


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` of ``docs``, a null text as the empty one."""
    find_package(docs.sparkSession)
    return docs.select(
        column(docs, id_col).alias("id"),
        F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"),
    )


def schema_of(**fields) -> T.StructType:
    """A schema from names and types (a type object or its DDL name)."""
    return T.StructType([
        T.StructField(k, T._parse_datatype_string(v) if isinstance(v, str) else v)
        for k, v in fields.items()
    ])


def raw_texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null gives the empty text."""
    return [b if b is not None else b"" for b in col.cast(pa.large_binary()).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` at most, so what a task makes of one stays small."""
    for b in batches:
        yield from (b.slice(k, rows) for k in range(0, b.num_rows, rows))


def to_batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()],
        names=list(columns))


def cut(items: list, sizes: Iterable[int], limit: int) -> Iterator[slice]:
    """Slices of ``items`` whose sizes add up to about ``limit`` each."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(items):
        yield slice(start, len(items))


def stable_sample(df: DataFrame, key: Column, rows: int, total: int | None = None) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of ``key``.

    A bound on the hash, from the count of all rows, leaves about twice as many
    rows to sort, so what is gathered does not grow with the input.
    """
    total = df.count() if total is None else total
    draw, grain = F.xxhash64(F.lit("sample"), key), 1 << 40
    if total > 4 * rows:
        df = df.where(F.pmod(draw, F.lit(grain)) < max(1, 2 * rows * grain // total))
    return df.orderBy(F.pmod(draw, F.lit(grain)), key).limit(rows)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A mixed copy of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def star_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(node, smallest node of its component)`` for the links u-v.

    Connects the same nodes as the links do, with fewer edges than nodes.
    """
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]
