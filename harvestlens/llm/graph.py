"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.session import write_and_read


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node it reaches) for every node of links (a, b) that has a smaller one.

    Alternates two steps until nothing changes: hand every larger neighbour the smallest
    neighbour, then hang smaller neighbours on the smallest. Both are a minimum per node (combined
    before the shuffle) and a join, so a node with many links is never gathered. Each round is
    written to the shared folder. Nulls and self links are left out; no links give no rows.
    """
    edges = write_and_read(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = write_and_read(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now
