"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the links, which shrink to one star for each component in a
logarithmic number of rounds; hot nodes are pre-aggregated (minimum of neighbours) and split by skew joins. Links never
reach the driver: it only compares a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b); nodes without a link are absent.

    Defined results: loops and repeated links count for nothing; an empty link table gives an empty result.
    """
    scratch = Scratch(links.sparkSession)
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, mark = _written(scratch, pairs)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        turned = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = turned.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        was = mark
        edges, mark = _written(scratch, small)
        if mark == was:
            scratch.keep_last()
            scratch.clear()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _written(scratch: Scratch, pairs: DataFrame):
    table = scratch.table(pairs)
    mark = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 998_244_353)).first()
    return table, tuple(mark)
