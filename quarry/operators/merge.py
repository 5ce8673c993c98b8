"""Merges into tables that have no update: the result is the new table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import blank, strip_ws

#: For mapping_candidates(): rows of a book on either side of a tile and pairs that a task makes, both about; tasks at most.
TILE, TASK_PAIRS, MOST_TASKS = 1024, 1 << 22, 1 << 15


def insert_if_absent(table: DataFrame, rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The rows to insert: complete, the first of each key, and not yet in the table."""
    whole = rows
    for c in key:
        whole = whole.withColumn(c, strip_ws(F.col(c))).filter(~blank(F.col(c)))
    first = whole.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    return first.join(table.select(*key), key, "left_anti")


def apply_updates(table: DataFrame, updates: DataFrame, key: list[str], column: str, order: str) -> DataFrame:
    """table with the last non-blank update of each key, and whether it changed."""
    last = updates.filter(~blank(F.col(column))).groupBy(*key).agg(F.max_by(column, order).alias("new_value"))
    df = table.join(last, key, "left")
    return df.withColumns({column: F.coalesce("new_value", column), "updated": F.col("new_value").isNotNull()}).drop("new_value")


def last_write(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The last value of each key by order; a null value counts as written."""
    last = rows.groupBy(*key).agg(F.max(F.struct(order, value)).alias("r"))
    return last.select(*key, F.col(f"r.{value}").alias(value))


def remaining(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(done.select(*key).distinct(), key, "left_anti")


def validate_mapping(rows: DataFrame, valid: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose key is a whole number, with the values that are not valid as null; valid has the column `value`."""
    good = rows.filter(F.trim(F.col(key)).rlike(r"^-*\d+$"))
    known = valid.select(F.col(value).alias("known")).distinct()
    return good.join(known, F.col(value) == F.col("known"), "left").withColumn(value, F.col("known")).drop("known")


def mapping_candidates(headings: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Headings and references of one book; a book without either has none.

    A hash of its columns (maps cannot be hashed) deals each row to one of its book's blocks, of about TILE rows, and each
    block of headings meets each block of references in a tile of its own; equal rows share a block. The tiles go to as
    many tasks as their pairs need, so what a task makes depends neither on how few or long the books are nor on the
    files. The count of pairs is taken at the call.
    """
    counts = headings.groupBy(key).agg(F.count("*").alias("_h")).join(references.groupBy(key).agg(F.count("*").alias("_r")), key)
    pairs = counts.agg(F.sum(F.col("_h").cast("double") * F.col("_r"))).first()[0] or 0
    tasks = min(max(1, math.ceil(pairs / TASK_PAIRS)), MOST_TASKS)
    blocks = counts.select(key, *(F.expr(f"({c} + {TILE - 1}) div {TILE}").alias(c) for c in ("_h", "_r")))

    def tiles(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64(*df.columns), F.col(own)).alias(own)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other)
        return df.join(blocks, key).select(*df.columns, block, copies).repartition(tasks, key, "_h", "_r")

    return tiles(headings, "_h", "_r").join(tiles(references, "_r", "_h"), [key, "_h", "_r"]).drop("_h", "_r")


def cascade_delete(tasks: DataFrame, logs: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """tasks and logs without the given tasks that have ended."""
    ended = gone.join(tasks.filter(F.col("status").isin("done", "failed", "cancelled")).select("id"), "id", "left_semi")
    return tasks.join(ended, "id", "left_anti"), logs.join(ended.withColumnRenamed("id", "task_id"), "task_id", "left_anti")


def with_defaults(table: DataFrame, defaults: DataFrame, key: list[str]) -> DataFrame:
    """table with the default rows whose key it lacks; both have the same columns."""
    return table.unionByName(defaults.select(*table.columns).join(table.select(*key), key, "left_anti"))


def with_omitted(mapping: DataFrame, asked: DataFrame, key: list[str], value: str, extra: list[str] | None = None) -> DataFrame:
    """A row for each key asked for, with null as the value of those that the mapping omits, and those of the mapping that nobody asked for.

    `extra` names columns of asked that pass over.
    """
    left = asked.select(*key, *(extra or [])).distinct()
    return left.join(mapping.select(*key, value), key, "full_outer").select(*key, *(extra or []), value)


def mapped_counts(rows: DataFrame, chunk: list[str], value: str) -> DataFrame:
    """For each chunk its rows and how many of them have a value."""
    return rows.groupBy(*chunk).agg(F.count("*").alias("asked"), F.count(value).alias("mapped"))
