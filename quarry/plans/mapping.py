"""Mapping of headings to references by a model, resumable: the answers are kept as JSON lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import parsing
from quarry.functions.text import filled
from quarry.operators import merge as M
from quarry.operators.paragraphs import joined
from quarry.sources.catalog import append_jsonl, read_jsonl
from quarry.sources.model import answered

CACHE = "seq long, book_id long, para_id string, sc_id string"
#: The wording is this library's own.
PROMPT = """For book {book_id} give a JSON object with the number of each heading and the id of its reference, or null.

Headings:
{headings}

References:
{references}
"""


def map_headings(
    headings: DataFrame,
    references: DataFrame,
    model: Callable[[], Callable[[str], str]],
    cache: str,
    books: DataFrame,
    book_id=None,
    most_level: int = 10,
    size: int = 150,
    reset: bool = False,
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """headings with the sc_ids that the model found, and for each book the number of headings, answers and assigned ones.

    headings: (book_id, para_id, level, title, sc_id); references: (book_id, sc_id, sutta_name). Every book of `books`, or the one
    named, is asked about in chunks of `size` headings of a level below most_level; books without either side are left out.
    What the cache holds is not asked again; `reset` starts anew and `dry_run` leaves the headings as they are. Answers
    that do not parse, ids that no reference of the book has and headings that an answer omits count as null.
    """
    spark = headings.sparkSession
    wanted = books.select("book_id") if book_id is None else books.filter(F.col("book_id") == book_id).select("book_id")
    if book_id is not None and not wanted.take(1):
        raise ValueError(f"unknown book: {book_id}")
    heads = headings.filter(F.col("level") < most_level).join(wanted, "book_id", "left_semi").withColumn("key", F.col("para_id").cast("string"))
    names = F.concat_ws(": ", "sc_id", "sutta_name")
    offered = references.groupBy("book_id").agg(joined(names, F.col("sc_id")).alias("references"))
    heads = heads.join(offered.select("book_id"), "book_id", "left_semi")

    before = _cached(spark, cache, reset)
    todo = heads.join(before.select("book_id", F.col("para_id").alias("key")), ["book_id", "key"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("book_id").orderBy("para_id")) - 1
    todo = todo.withColumn("nth", nth).withColumn("chunk", F.expr(f"nth div {size}"))
    item = F.concat_ws(" ", "key", "title")
    asked = todo.groupBy("book_id", "chunk").agg(joined(item, F.col("para_id")).alias("headings")).join(offered, "book_id")
    asked = asked.select("book_id", "chunk", filled(PROMPT, {c: F.col(c) for c in ("book_id", "headings", "references")}).alias("prompt"))
    found = answered(asked, "prompt", model, retries=2, wait_s=5).select("book_id", F.explode(parsing.mapping_parse("raw")).alias("para_id", "sc_id"))
    # the ids of other books' references are not valid either
    pair = F.to_json(F.struct("book_id", "sc_id"))
    good = M.validate_mapping(found.withColumn("pair", F.when(F.col("sc_id").isNotNull(), pair)), references.select(pair.alias("pair")), "para_id", "pair")
    good = good.select("book_id", "para_id", F.get_json_object("pair", "$.sc_id").alias("sc_id")).dropDuplicates(["book_id", "para_id"])
    new = M.with_omitted(good, todo.select("book_id", F.col("key").alias("para_id")), ["book_id", "para_id"], "sc_id")
    append_jsonl(new.select(F.lit(1 + (before.agg(F.max("seq")).first()[0] or 0)).alias("seq"), "book_id", "para_id", "sc_id"), cache)

    whole = _cached(spark, cache)
    sums = heads.select("book_id", "key").join(whole.withColumnRenamed("para_id", "key"), ["book_id", "key"], "left")
    sums = sums.groupBy("book_id").agg(F.count("*").alias("headings"), F.count("seq").alias("answers"), F.count("sc_id").alias("assigned"))
    if dry_run:
        return headings, sums
    updates = whole.withColumn("para_id", F.col("para_id").try_cast("long"))
    return M.apply_updates(headings, updates, ["book_id", "para_id"], "sc_id", "seq").drop("updated"), sums


def _cached(spark: SparkSession, cache: str, reset: bool = False) -> DataFrame:
    """The last answer for each heading."""
    if reset:
        path = spark._jvm.org.apache.hadoop.fs.Path(cache)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    rows = read_jsonl(spark, cache, CACHE)
    last = rows.groupBy("book_id", "para_id").agg(F.max(F.struct("seq", "sc_id")).alias("r"))
    return last.select("book_id", "para_id", "r.seq", "r.sc_id")
