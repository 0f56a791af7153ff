"""Connected components of a graph of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, root)`` for every end of a link: the smallest id that it is joined to.

    Each round first ties larger neighbours to the smallest neighbour of their
    common node, and then each node to its smallest neighbour. Rounds end when
    every node hangs on its root, after about the logarithm of the longest
    chain. Only rows of two numbers move; a node with very many links is one
    side of a plain join, which adaptive execution can split. Links with a null
    end are left out. An empty frame gives none.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = saved(edges.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND u <> v").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
