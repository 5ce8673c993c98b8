"""Uniform sharding by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import settled


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows drawn without replacement are good.

    By inversion over the terms within 12 standard deviations of the mode, so it takes numbers of any
    size; what lies outside has a probability below 1e-30.
    """
    every = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (every + 2)))
    spread = math.sqrt(draws * (good / every) * (bad / every) * max(0.0, (every - draws) / max(1, every - 1)))
    reach = 40 + int(12 * spread)
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # the ratio of the terms for k + 1 and k
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(step)])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return int(low + np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, high - low))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """How many rows each partition sends to each shard when all rows are shuffled uniformly.

    Row sums are the partitions' rows; column sums, the shards' sizes, differ by one at most.
    """
    rng = np.random.default_rng(seed)
    total = sum(rows)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for n in rows:
        need, others, line = n, sum(left), []
        for s in range(shards):
            others -= left[s]
            k = hypergeometric(rng, left[s], others, need) if need else 0
            line.append(k)
            need -= k
        left = [a - b for a, b in zip(left, line, strict=True)]
        matrix.append(line)
    return matrix


def shard_rows(
    rows: DataFrame, shards: int = 24, seed: int = 7, partition_rows: int = 20_000, most_partitions: int = 4096
) -> DataFrame:
    """rows with shard and slot: a uniform shuffle into shards whose sizes differ by one at most.

    The rows are parted by a hash into partitions of about partition_rows, or into most_partitions
    where that would be more; the matrix on the driver has partitions x shards counts at most. Each
    partition puts its rows in a random order and deals them to the shards by its line of the matrix;
    each shard then puts what it got in a random order. This second order is by a random key, whose
    leading bits make ranges of about partition_rows, so no task holds a whole shard: a row's slot is
    the number of rows in lower ranges plus its place in its own.

    The hash takes in a row's number in the input as Spark splits it, so another split deals another
    shuffle, as uniform as the first; rows read once more in the same split fall as before.

    All columns stay, and rows with nulls, empty tables and repeated rows are dealt like any others.
    Columns named shard or slot are replaced; names that begin with _quarry are reserved.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    cols = [F.col(f"`{c}`") for c in rows.columns]
    # the written copy fixes _quarry_n, which tells equal rows apart
    fixed = settled(rows.withColumn("_quarry_n", F.monotonically_increasing_id()))
    total = fixed.count()
    parts = max(1, min(most_partitions, -(-total // partition_rows)))
    keyed = fixed.withColumns(
        {
            "_quarry_part": F.pmod(F.xxhash64(F.lit(seed), *cols, "_quarry_n"), F.lit(parts)).cast("int"),
            "_quarry_a": F.xxhash64(F.lit(seed + 1), *cols, "_quarry_n"),
            "_quarry_b": F.xxhash64(F.lit(seed + 2), *cols, "_quarry_n"),
        }
    )
    counts = dict(keyed.groupBy("_quarry_part").count().collect())
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shards, seed)
    ends = [np.cumsum(line).tolist() for line in matrix]
    lines = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>")).alias("_quarry_p2", "_quarry_ends"))

    local = Window.partitionBy("_quarry_part").orderBy("_quarry_a", "_quarry_n")
    dealt = (
        keyed.withColumn("_quarry_rank", F.row_number().over(local))
        .join(F.broadcast(lines), F.col("_quarry_part") == F.col("_quarry_p2"))
        .withColumn("shard", F.size(F.filter("_quarry_ends", lambda e: e < F.col("_quarry_rank"))).cast("int"))
        .drop("_quarry_a", "_quarry_p2", "_quarry_ends", "_quarry_rank", "_quarry_part")
    )
    ranges = max(1, -(-total // (shards * partition_rows)))
    # the key as a number from 0 to 1 picks the range, so ranges follow the order of the key
    unit = F.col("_quarry_b") / F.lit(2.0**64) + 0.5
    dealt = dealt.withColumn("_quarry_range", F.least(F.floor(unit * ranges), F.lit(ranges - 1)).cast("int"))
    dealt = settled(dealt)
    lower = Window.partitionBy("shard").orderBy("_quarry_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("shard", "_quarry_range")
        .count()
        .select("shard", "_quarry_range", F.coalesce(F.sum("count").over(lower), F.lit(0)).alias("_quarry_before"))
    )
    place = Window.partitionBy("shard", "_quarry_range").orderBy("_quarry_b", "_quarry_n")
    return (
        dealt.withColumn("_quarry_place", F.row_number().over(place))
        .join(before, ["shard", "_quarry_range"])
        .withColumn("slot", (F.col("_quarry_before") + F.col("_quarry_place") - 1).cast("long"))
        .select(*rows.columns, "shard", "slot")
    )


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8; null: 8), text_crc32 (null: that of no bytes), law, shard, slot, grown_shard.

    The law is `rows`: the shards' counts of rows differ by one at most.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    return shard_rows(narrow, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
