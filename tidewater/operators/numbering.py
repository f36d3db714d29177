"""Dense row numbers without moving the rows: prefix sums over counts of pieces.

A piece is a run of rows that lie together in one task, such as one split of a
file. Only one row a piece is moved: its count, summed up per file and then over
the files before. A row's number is its place in its piece, which its increasing
id gives, plus the rows of all pieces before. So a file may be split any way, and
no task sorts or collects rows. The table of pieces is measured: within the bound of
``operators.joins`` it is sent to every task and the rows stay where they are, beyond
it (a million splits) rows meet it piece by piece in a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.joins import bounded_side
from tidewater.session import scratch_path


def piece_offsets(rows: DataFrame, group: str, piece: str, row: str) -> DataFrame:
    """``(group, piece, first, offset)``: the least row id of each piece, and the
    rows in all pieces before it, by group and then piece.

    The sums over groups run over one row a group, those over pieces within
    their group; both are as many as the input has files and splits.
    """
    pieces = _kept(rows.groupBy(group, piece).agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("rows")))
    groups = pieces.groupBy(group).agg(F.sum("rows").alias("rows"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(F.col(group).alias("start_of"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    return (
        pieces.withColumn("within", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .join(starts, F.col(group).eqNullSafe(F.col("start_of")))
        .select(group, piece, "first", (F.col("start") + F.col("within")).alias("offset"))
    )


def _kept(df: DataFrame) -> DataFrame:
    """``df``, one row a piece, as a table, so that the rows are read once for it."""
    path = scratch_path(df.sparkSession, "pieces")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(rows: DataFrame, group: str = "file", piece: str = "block", row: str = "row",
                number: str = "line_no", keep: Sequence[str] = ("value",)) -> DataFrame:
    """``keep`` columns of ``rows`` with dense numbers from 0, by group, piece and row.

    ``row`` must increase by one from row to row of a piece, as
    ``monotonically_increasing_id`` does right above a scan; ``rows`` is read
    twice, the first time without the kept columns.
    """
    offsets = _kept(piece_offsets(rows, group, piece, row).select(
        F.col(group).alias("of_group"), F.col(piece).alias("of_piece"), "first", "offset"))
    met = rows.join(bounded_side(offsets), F.col(group).eqNullSafe(F.col("of_group")) & F.col(piece).eqNullSafe(F.col("of_piece")))
    return met.select((F.col(row) - F.col("first") + F.col("offset")).alias(number), *keep)
