"""Paths in a tree of headings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.staging import settled


def heading_paths(nodes: DataFrame, most_level: int | None = None, sep: str = " > ") -> DataFrame:
    """(id, level, path): the titles from the root to each node.

    nodes: (id, parent, title). A node without a parent in the table is a root, of level 0. In each round a node takes
    over the path of the ancestor that it has reached, so a depth of d takes log2(d) joins, each of which is settled
    before the next. Nodes on or below a cycle never reach a root and are left out: the rounds end when no more nodes
    reach one. The level filter comes after the paths are whole.
    """
    known = nodes.select(F.col("id").alias("known"))
    title = F.coalesce("title", F.lit(""))
    df = nodes.join(known, F.col("parent") == F.col("known"), "left").select(
        "id", F.when(F.col("known") != F.col("id"), F.col("known")).alias("up"), F.lit(0).alias("level"), title.alias("path")
    )
    df = settled(df)
    left, before = df.filter("up is not null").count(), None
    while left and left != before:
        above = df.select(F.col("id").alias("a"), F.col("up").alias("a_up"), F.col("level").alias("a_level"), F.col("path").alias("a_path"))
        there = F.col("a").isNotNull()
        df = settled(
            df.join(above, F.col("up") == F.col("a"), "left").select(
                "id",
                F.when(there, F.col("a_up")).alias("up"),
                F.when(there, F.col("level") + F.col("a_level") + 1).otherwise(F.col("level")).alias("level"),
                F.when(there, F.concat("a_path", F.lit(sep), "path")).otherwise(F.col("path")).alias("path"),
            )
        )
        left, before = df.filter("up is not null").count(), left
    df = df.filter("up is null").drop("up")
    return df if most_level is None else df.filter(F.col("level") < most_level)
