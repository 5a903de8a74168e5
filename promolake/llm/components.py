"""Connected components of a table of links, by large and small stars.

Every round is two aggregations and joins whose rows are at most the links; a table in the shared folder ends it.
No link, component or label is ever collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shelf


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Links each neighbour (the larger ones, or all of the smaller ones) to the least of a node and its neighbours."""
    if not larger:
        pairs = pairs.filter("b < a")
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    linked = pairs.join(least, "a")
    if larger:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = linked.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def _mark(links: DataFrame) -> tuple[int, int]:
    r = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return r[0], int(r[1])


def components(shelf: Shelf, links: DataFrame) -> DataFrame:
    """node, root (the least node that it reaches) for each node of links (a, b), both long and not null."""
    now = shelf.put(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        large = _star(_both(now), True)
        after = shelf.put(_star(large, False), "links")
        new = _mark(after)
        shelf.drop(now)
        now = after
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
