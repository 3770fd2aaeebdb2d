"""Connected components of a graph of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def ends(links: DataFrame) -> DataFrame:
    """(a, b) with a < b, once each; loops are dropped."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, label): the least id of its component, for every end of ``links`` (a, b: long).  ``known``: labels
    of a graph that the links are added to; only the links between its components are worked on.

    Each round every vertex takes its least neighbour (if less than itself) as parent, parents are
    followed two steps more, and the links are contracted to parents.  A round removes every vertex
    with a smaller neighbour, so the number of rounds grows with the logarithm of the longest
    chain.  Least neighbours are partial aggregates: a vertex with very many links is reduced
    before the shuffle.  Every round is written, nothing is collected.
    """
    live = links.select("a", "b")
    if known is not None:
        for end in ("a", "b"):
            label = known.select(F.col("id").alias(end), F.col("label").alias("_l"))
            live = live.join(label, end, "left").withColumn(end, F.coalesce("_l", end)).drop("_l")
    live = written(ends(live), "links")
    new = live.select(F.col("a").alias("id")).union(live.select(F.col("b").alias("id"))).distinct()
    labels = new.withColumn("label", F.col("id"))
    if known is not None:
        labels = known.unionByName(labels.join(known.select("id"), "id", "left_anti"))
    while not live.isEmpty():
        parent = (live.select(F.col("b").alias("v"), F.col("a").alias("p"))
                  .union(live.select(F.col("a").alias("v"), F.col("a").alias("p"))).groupBy("v").agg(F.min("p").alias("p")))
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        for _ in range(2):
            parent = parent.join(up, "p").select("v", F.col("pp").alias("p"))
        parent = written(parent, "parents")
        labels = (labels.join(parent.withColumnRenamed("v", "label"), "label", "left")
                  .select("id", F.coalesce("p", "label").alias("label")))
        pa, pb = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        live = written(ends(live.join(pa, "a").join(pb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "links")
    return written(labels, "labels")
