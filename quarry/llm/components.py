"""Connected components of an edge list, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import discard, stage


def _stars(edges: DataFrame) -> DataFrame:
    """One round of large stars and small stars; edges: (u, v) with u > v, distinct."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> tuple[DataFrame, str]:
    """(node, root) for each node of the edge list (a, b), staged, and its path: root is the least node that it reaches.

    Alternates large and small stars until the edges stay the same, which takes a number of rounds
    logarithmic in the nodes; more than most_rounds raise an error. The edges never grow; only their
    number and a checksum reach the driver, and each round's table is deleted after the next. Edges
    with a null end, repeated edges and loops are ignored; no edges give no rows; other columns are
    ignored.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a is not null and b is not null and u <> v")
    e, path = stage(e.distinct(), "edges")
    sums = F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 30))
    state = e.agg(*sums).first()
    for _ in range(most_rounds if state[0] else 0):
        old = state, path
        e, path = stage(_stars(e), "edges")
        state = e.agg(*sums).first()
        discard(spark, old[1])
        if state == old[0]:
            break
    else:
        if state[0]:
            raise RuntimeError(f"no components after {most_rounds} rounds")
    hubs = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    found, where = stage(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(hubs), "components")
    discard(spark, path)
    return found, where
