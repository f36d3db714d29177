"""Previews of intermediate results (opt-in: each one is a separate job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, n: int = 20, enabled: bool = False) -> None:
    """``df.show(n)`` when enabled. Off by default: every preview re-runs the
    lineage up to this point, since nothing is cached."""
    if enabled:
        df.show(n)


def preview_rows(df: DataFrame, order_cols: list[Column | str], n: int = 20) -> DataFrame:
    """A deterministic preview: the first ``n`` rows in key order.

    Planned as a per-partition top-n followed by a merge of at most
    ``n x partitions`` rows, so no full sort runs.
    """
    return df.orderBy(*order_cols).limit(n)


def schema_text(df: DataFrame) -> str:
    """What ``printSchema`` prints, as a string."""
    return df.schema.treeString()
