"""Published snapshots of a stream's whole result, kept in tiers of changed rows.

Every micro-batch adds one segment. In update mode it holds the rows that the batch
changed, so what a batch writes follows its changes and not the size of the result.
Once ``FAN_IN`` segments of one tier lie next to each other they are merged into
one of the next tier, the newest row of a key winning (or rows of a key adding up, if
a batch holds only what it adds): a row is written again once
a tier, and the number of segments grows with the logarithm of the batches. In
complete mode a segment replaces all before it.

A snapshot is a manifest, the list of its segments from old to new. It is written
after them and visible at once when it is whole, so readers see the old snapshot
until then, also if a batch fails midway. A batch that runs again finds its own
manifest and adds nothing. Only the last manifests and their segments are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Segments of one tier that are merged into one of the next.
FAN_IN = 4
#: Published snapshots that stay readable besides the last.
OLD_SNAPSHOTS = 1

_MANIFEST = "place int, folder string, tier int, keys array<string>, sums array<string>"


@dataclass(frozen=True)
class Segment:
    folder: str
    tier: int


class _Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path
        self._at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def __truediv__(self, name: str) -> _Folder:
        return _Folder(self._spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at)] if self.exists() else []

    def delete(self) -> None:
        self._fs.delete(self._at, True)


def _published(spark: SparkSession, path: str) -> list[int]:
    """Batches with a whole manifest, oldest first."""
    manifests = _Folder(spark, f"{path}/manifests")
    return sorted(int(n) for n in manifests.names() if (manifests / f"{n}/_SUCCESS").exists())


def _segments(spark: SparkSession, path: str, batch_id: int) -> tuple[list[Segment], list[str], list[str]]:
    """A manifest's segments, key columns and summed columns; its length is
    logarithmic in the batches."""
    rows = spark.read.schema(_MANIFEST).json(f"{path}/manifests/{batch_id}").orderBy("place").collect()
    if not rows:
        return [], [], []
    return [Segment(r.folder, r.tier) for r in rows], list(rows[0]["keys"]), list(rows[0]["sums"])


def _merged(spark: SparkSession, path: str, segments: list[Segment], keys: list[str], sums: list[str]) -> DataFrame:
    """The newest row of each key over segments from old to new, or their sums."""
    parts = [spark.read.parquet(f"{path}/segments/{s.folder}") for s in segments]
    if len(parts) == 1:
        return parts[0]
    columns = parts[0].columns
    if sums:
        rows = reduce(DataFrame.unionByName, parts)
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).select(*columns)
    aged = reduce(DataFrame.unionByName, [p.select(F.struct(*columns).alias("row"), F.lit(i).alias("age"))
                                          for i, p in enumerate(parts)])
    by_key = aged.groupBy(*[F.col(f"row.`{k}`").alias(f"key{i}") for i, k in enumerate(keys)])
    return by_key.agg(F.max_by("row", "age").alias("row")).select("row.*")


def publish_batches(path: str, keys: list[str] | None = None,
                    sums: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that publishes snapshots under ``path``.

    With ``keys`` a batch holds changed rows, and rows of equal keys replace each
    other, or, with ``sums``, add up in these columns; without, every batch is the
    whole result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _published(spark, path)
        if done and done[-1] >= batch_id:
            return  # the batch runs again after its snapshot was published
        segments = _segments(spark, path, done[-1])[0] if keys and done else []

        def put(rows: DataFrame, tier: int) -> Segment:
            segment = Segment(f"{batch_id}-{tier}-{uuid.uuid4().hex}", tier)
            rows.write.parquet(f"{path}/segments/{segment.folder}")
            return segment

        segments.append(put(batch, 0))
        while len(segments) >= FAN_IN and len({s.tier for s in segments[-FAN_IN:]}) == 1:
            merged = put(_merged(spark, path, segments[-FAN_IN:], keys, list(sums or [])), segments[-1].tier + 1)
            segments[-FAN_IN:] = [merged]
        rows = [(i, s.folder, s.tier, list(keys or []), list(sums or [])) for i, s in enumerate(segments)]
        manifest = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        # Overwriting drops what a failed attempt of this batch has left.
        manifest.write.mode("overwrite").json(f"{path}/manifests/{batch_id}")
        _drop_old(spark, path)

    return write


def _drop_old(spark: SparkSession, path: str) -> None:
    """Keep the last manifests, and the segments that one of them names."""
    root, done = _Folder(spark, path), _published(spark, path)
    kept = done[-1 - OLD_SNAPSHOTS:]
    for batch_id in done[: -1 - OLD_SNAPSHOTS]:
        (root / f"manifests/{batch_id}").delete()
    named = {s.folder for b in kept for s in _segments(spark, path, b)[0]}
    for folder in (root / "segments").names():
        if folder not in named:
            (root / f"segments/{folder}").delete()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The whole result of the last published snapshot."""
    done = _published(spark, path)
    if not done:
        raise ValueError(f"no snapshot is published under {path}")
    return _merged(spark, path, *_segments(spark, path, done[-1]))


def snapshot_layout(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, folder, tier, rows)``: the segments of each kept snapshot."""
    found = [(b, s.folder, s.tier, spark.read.parquet(f"{path}/segments/{s.folder}").count())
             for b in _published(spark, path) for s in _segments(spark, path, b)[0]]
    return spark.createDataFrame(found, "batch_id bigint, folder string, tier int, rows bigint")
