"""Connected components by alternating large and small stars.

Links stay in tables throughout. Each step keeps one row per link, links every
node to a smaller one of its component and is written to the shared folder, so
a lost executor costs one step. A node with very many links is an ordinary
join key of a large side, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import staged


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of (u, v) links; the component is its smallest node."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges = staged(edges, "cc-links")
    before = _state(edges)
    while True:
        # Large star: larger neighbours of u go to the smallest of u's neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(edges, "cc-step")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
