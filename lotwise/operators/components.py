"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.session import cut, empty, kept, release


def components(links: DataFrame, tables: bool = False) -> DataFrame:
    """node, label (smallest node of its component) of every node in links (a, b), one row each.

    Every step groups by node and keeps edges to the smallest neighbour only, so the edges stay
    linear in the links; the number of rounds is logarithmic in practice. Stops when all edges are stars:
    every node has one smaller neighbour, which has none itself. Steps are checkpoints, or `tables`: compressed, in less disk.
    """
    step = (lambda df: kept(df, "edges")) if tables else cut
    edges = step(links.select("a", "b").filter("a <> b").distinct())
    if empty(edges):
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # large star: larger neighbours of u are linked with the smallest of u and its neighbours
        large = both.filter("v > u").join(least, "u").select(F.greatest("v", F.least("u", "m")).alias("a"), F.least("v", F.least("u", "m")).alias("b")).filter("a <> b").distinct()
        if tables:
            large = step(large)
            release(edges)
        # small star: u and its smaller neighbours are linked with the smallest of these
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        edges = step(small)
        if tables:
            release(large)
        ends = edges.groupBy("a").agg(F.count("*").alias("n")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).cast("long").alias("n")).distinct())
        if empty(ends.groupBy("a").agg((F.count("*") + F.sum("n")).alias("n")).filter("n > 2")):
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def extended(labels: DataFrame, links: DataFrame, tables: bool = False) -> DataFrame:
    """node, label after further links: components of labels (as components() gives them) are single nodes, and only links between them are followed.

    Labels stay the smallest node. Links that go away need components() anew.
    """
    old = labels.select("node", "label")
    for end in ("a", "b"):
        links = links.join(old.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left").withColumn(end, F.coalesce(f"l{end}", end)).drop(f"l{end}")
    met = components(links.filter("a <> b").select("a", "b"), tables)
    moved = met.select(F.col("node").alias("label"), F.col("label").alias("to"))
    kept = old.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return kept.unionByName(met.join(old, "node", "left_anti"))
