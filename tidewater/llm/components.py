"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: each linked node with the smallest node it reaches.

    ``edges`` holds one link per row in two long columns; direction, repeats and
    self-links do not matter, and rows with a null end are ignored. Nodes without
    a link to another node are not in the result.

    Each round hangs the neighbours of a node on its smallest neighbour, first
    the larger ones, then the others (large-star, small-star). The links shrink
    towards one star per component in a logarithmic number of rounds. A round
    is two aggregations and two equi-joins on the node. A node with very many
    links is pre-aggregated before the shuffle, and as the smallest neighbours are
    written first, the joins are of plain shuffles, of which Spark splits a hot
    one. Every round is written to the shared checkpoint folder, which
    cuts the lineage. Only two numbers a round come to the driver.
    """
    links = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct()
    )
    links = materialise(links, "links")
    state = _fingerprint(links)
    while True:
        links = materialise(_small_star(materialise(_large_star(links), "links")), "links")
        new = _fingerprint(links)
        if new == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = new


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v"), F.col("u")))
    low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "smallest")
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))


def _small_star(links: DataFrame) -> DataFrame:
    low = materialise(links.groupBy("u").agg(F.min("v").alias("m")), "smallest")
    hung = links.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).distinct()
