"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored


def _towards(links: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's neighbours point to the smallest of them. ``large`` moves the larger
    neighbours of a node, else the node and its smaller ones."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.where("b > a") if large else both
    stars = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        stars = stars.unionAll(least.select("a", F.col("m").alias("b")))
    return stars.where("a <> b").distinct()


def _unfinished(links: DataFrame) -> tuple[int, int]:
    """How many links there are, and how many nodes keep them from being stars around their smallest nodes: those with
    more than one smaller neighbour, or with smaller and larger ones."""
    end = lambda node, below: F.struct(node.alias("node"), F.lit(below).alias("below"))
    ends = links.select(F.inline(F.array(end(F.greatest("a", "b"), 1), end(F.least("a", "b"), 0))))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.count("*").alias("n"))
    wrong = (F.col("below") > 1) | ((F.col("below") == 1) & (F.col("n") > 1))
    return tuple(nodes.agg(F.coalesce(F.sum("below"), F.lit(0)), F.count_if(wrong)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node that can be reached.

    Large and small star steps in turn; after log-many rounds the links are stars around the roots. Each
    round is a table of its own in the shared folder, so that a lost executor never repeats the loop; a round makes
    no more than twice its links, which says how many files it is written to.
    """
    kind = links.schema["a"].dataType
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while (state := _unfinished(links))[1]:
        links = stored(_towards(_towards(links, large=True), large=False), "links", 2 * state[0])
    roots = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return roots.unionAll(roots.select("root", "root").distinct()).select(
        F.col("node").cast(kind), F.col("root").cast(kind)
    )
