"""Paragraphs: assembly from lines, ranges, neighbours, statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.staging import settled
from quarry.functions.text import strip_ws, word_count

KEY = ["book_id", "para_id"]
LANGUAGES = ("pali", "english", "vietnamese")
PAGES = ("thaipage", "vripage", "ptspage")


def joined(text: Column, order: Column, sep: str = "\n") -> Column:
    """An aggregate: the texts in order, parted by sep; nulls are left out."""
    pairs = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t")))))
    return F.array_join(F.transform(pairs, lambda p: p["t"]), sep)


def shown(language: str | None) -> list[str]:
    """The text columns of a language: all three of `all`, and english of one that is not known."""
    name = (language or "english").lower()
    return list(LANGUAGES) if name == "all" else [name if name in LANGUAGES else "english"]


def with_optional(sentences: DataFrame) -> DataFrame:
    """sentences with null for the text and page columns that it lacks."""
    return sentences.withColumns({c: F.lit(None).cast("string") for c in (*LANGUAGES, *PAGES) if c not in sentences.columns})


def get_paragraph(sentences: DataFrame, language: str | None = "english") -> DataFrame:
    """One row per paragraph: the texts asked for, of their non-empty lines, the number of lines, the words of the
    language (of english for all) and the pages of the first line."""
    texts = shown(language)
    counted = texts[0] if len(texts) == 1 else "english"
    agg = [joined(F.when(F.col(c) != "", F.col(c)), F.col("line_id")).alias(c) for c in texts]
    first = F.min(F.struct("line_id", *PAGES)).alias("first")
    df = with_optional(sentences).groupBy(*KEY).agg(*agg, F.count("*").alias("line_count"), first)
    pages = [F.coalesce(f"first.{p}", F.lit("")).alias(p) for p in PAGES]
    return df.select(*KEY, *texts, "line_count", word_count(F.col(counted)).alias("word_count"), *pages)


def paragraph_range(sentences: DataFrame, first: int, last: int, language: str | None = "english", most: int = 20) -> DataFrame:
    """The paragraphs from first to last of each book, `most` at most; lines are stripped, and only empty ones left out."""
    df = with_optional(sentences).filter(F.col("para_id").between(first, min(last, first + most - 1)))
    agg = [joined(F.when(F.col(c) != "", strip_ws(F.col(c))), F.col("line_id")).alias(c) for c in shown(language)]
    return df.groupBy(*KEY).agg(*agg, F.count("*").alias("line_count"))


def nearby_context(paragraphs: DataFrame, centres: DataFrame, before: int | None = None, after: int | None = None) -> DataFrame:
    """For each centre the paragraphs of its book from `before` in front to `after` behind, 0 to 5 each."""
    b, a = (min(max(0, 2 if x is None else x), 5) for x in (before, after))
    near = centres.select("book_id", F.col("para_id").alias("centre_id"), F.explode(F.sequence(F.lit(-b), F.lit(a))).alias("d"))
    near = near.select("book_id", "centre_id", (F.col("centre_id") + F.col("d")).alias("para_id"), (F.col("d") == 0).alias("is_center"))
    return near.join(paragraphs, KEY)


def book_stats(sentences: DataFrame, books: DataFrame) -> DataFrame:
    """For each book its name and classes, the number of paragraphs and lines, and its first and last paragraph; 0 and null without lines.

    books: book_id and, where they are known, book_name, nikaya and sub_nikaya; without them they are empty.
    """
    # paragraphs first, so that the distinct count needs no second copy of the lines
    paras = sentences.groupBy(*KEY).agg(F.count("*").alias("n"))
    stats = paras.groupBy("book_id").agg(
        F.count("*").alias("paragraphs"), F.sum("n").alias("lines"), F.min("para_id").alias("first_para"), F.max("para_id").alias("last_para")
    )
    known = {c: F.coalesce(F.col(c) if c in books.columns else F.lit(None), F.lit("")) for c in ("book_name", "nikaya", "sub_nikaya")}
    return books.select("book_id", *(v.alias(k) for k, v in known.items())).join(stats, "book_id", "left").withColumns(
        {"paragraphs": F.coalesce("paragraphs", F.lit(0)).cast("long"), "lines": F.coalesce("lines", F.lit(0)).cast("long")}
    )


def previous_paragraph(paragraphs: DataFrame, column: str = "english") -> DataFrame:
    """For each paragraph the text of the one before it by number, empty where that is missing."""
    before = paragraphs.select("book_id", (F.col("para_id") + 1).alias("para_id"), F.col(column).alias("previous"))
    return paragraphs.select(*KEY).join(before, KEY, "left").withColumn("previous", F.coalesce("previous", F.lit("")))


def prefix_trim(sentences: DataFrame, most: int) -> DataFrame:
    """The first `most` lines of each book."""
    nth = F.row_number().over(Window.partitionBy("book_id").orderBy("para_id", "line_id"))
    return sentences.withColumn("nth", nth.cast("long")).filter(F.col("nth") <= most)


def fixed_batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """rows with a batch number: `size` to a batch, in the order of a key of any type.

    The sorted rows are settled, so each keeps its partition and its place there; the rank is that place after the
    sizes of the partitions before. A sort takes ranges of the key by its quantiles, so clustered keys do not meet in one task.
    """
    at = F.monotonically_increasing_id()
    ranked = settled(rows.orderBy(key).withColumns({"_part": F.shiftright(at, 33), "_place": at.bitwiseAND(F.lit(2**33 - 1))}))
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a partition
    ranked = ranked.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return ranked.withColumn("batch", F.expr(f"(_before + _place) div {size}")).drop("_part", "_place", "_before")


def chunk_paragraphs(paragraphs: DataFrame, most: int, tokens: str = "tokens", group: tuple[str, ...] = ("book_id",), order: str = "para_id") -> DataFrame:
    """Greedy chunks: a paragraph opens a new one where the present one, not empty, would exceed `most` tokens.

    A group is read in order by one task, which keeps only the present chunk's number and tokens; null tokens count 0.
    """
    cols = [*group, order, tokens]
    rows = paragraphs.select(*group, F.col(order).cast("long").alias(order), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias(tokens))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, chunk = None, 0, 0
        for batch in batches:
            out = []
            for *own, n in zip(*(batch.column(c).to_pylist() for c in (*group, tokens)), strict=True):
                if own != key:
                    key, held, chunk = own, n, 0
                elif held + n > most:
                    held, chunk = n, chunk + 1
                else:
                    held += n
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*cols, "chunk"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.repartition(*group).sortWithinPartitions(*group, order).mapInArrow(chunks, f"{kinds}, chunk long")
