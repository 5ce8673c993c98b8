"""Search and listing over books, headings and sentences."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import icontains


def clamp(limit: int | None, default: int, most: int) -> int:
    """None is the only unset value; the rest is kept within 1 and `most`."""
    return min(max(1, default if limit is None else limit), most)


def list_books(books: DataFrame, nikaya: str | None = None, sub_nikaya: str | None = None, category: str | None = None, limit: int | None = None) -> DataFrame:
    """Books whose given attributes contain the given texts, in order; null attributes show as empty."""
    given = {"nikaya": nikaya, "sub_nikaya": sub_nikaya, "category": category}
    df = books.filter(reduce(and_, (icontains(F.col(k), v) for k, v in given.items() if v), F.lit(True)))
    shown = df.select("book_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("book_name", *given)))
    return shown.orderBy("nikaya", "sub_nikaya", "book_name", "book_id").limit(clamp(limit, 50, 200))


def search_books(books: DataFrame, query: str, limit: int | None = None) -> DataFrame:
    """Books with the query in any of their attributes, by name."""
    cols = ("book_name", "nikaya", "sub_nikaya", "category")
    df = books.filter(reduce(or_, (icontains(F.col(c), query) for c in cols)))
    return df.select("book_id", *(F.coalesce(c, F.lit("")).alias(c) for c in cols)).orderBy("book_name", "book_id").limit(clamp(limit, 20, 100))


def keyword_search(sentences: DataFrame, keyword: str, column: str = "english", book_id=None, limit: int | None = None, **how) -> DataFrame:
    """The lines that contain the keyword, in order, with their first 300 characters."""
    df = sentences.filter(icontains(F.col(column), keyword, **how))
    if book_id is not None:
        df = df.filter(F.col("book_id") == book_id)
    df = df.select("book_id", "para_id", "line_id", F.substring(column, 1, 300).alias("snippet"))
    return df.orderBy("book_id", "para_id", "line_id").limit(clamp(limit, 20, 100))


def table_of_contents(headings: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Headings with a level of at most max_depth (1 to 20)."""
    return headings.filter(F.col("level").isNotNull() & (F.col("level") <= clamp(max_depth, 9, 20))).orderBy("para_id")


def books_by_category(books: DataFrame, category: str) -> DataFrame:
    return books.filter(F.col("category") == category).select("book_id", "book_name", "category")


def page(rows: DataFrame, order: list, number: int, size: int = 50) -> DataFrame:
    """One page, from 1, of rows in a total order, with the number of rows and pages."""
    total = rows.count()
    shown = rows.orderBy(*order).offset((max(number, 1) - 1) * size).limit(size)
    return shown.withColumns({"total": F.lit(total).cast("long"), "pages": F.lit(max(1, -(-total // size))).cast("long")})


def domains(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).filter(F.col(column) != "").distinct().orderBy(column)
