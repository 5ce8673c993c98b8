"""Named tools with typed parameters over a corpus; only here do rows reach the driver, as many as a tool's limit allows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import paragraphs as P
from quarry.operators import search as S


@dataclass(frozen=True)
class Param:
    kind: type | tuple[type, ...]
    required: bool = False
    choices: tuple[str, ...] = ()


@dataclass(frozen=True)
class Tool:
    run: Callable[..., DataFrame]
    tables: tuple[str, ...]
    params: dict[str, Param]


LANGUAGE = Param(str, choices=(*P.LANGUAGES, "all"))
_BOOK, _PARA = Param((int, str), required=True), Param(int, required=True)


def _of(df: DataFrame, book_id, **more) -> DataFrame:
    return df.filter(F.col("book_id") == book_id)


def _nearby(sentences: DataFrame, book_id, para_id, before=None, after=None, language="english") -> DataFrame:
    paras = P.get_paragraph(_of(sentences, book_id), language)
    centre = sentences.sparkSession.range(1).select(F.lit(book_id).alias("book_id"), F.lit(para_id).cast("long").alias("para_id"))
    return P.nearby_context(paras, centre, before, after).orderBy("para_id")


TOOLS = {
    "list_books": Tool(S.list_books, ("books",), {"nikaya": Param(str), "sub_nikaya": Param(str), "category": Param(str), "limit": Param(int)}),
    "search_books": Tool(S.search_books, ("books",), {"query": Param(str, required=True), "limit": Param(int)}),
    "get_table_of_contents": Tool(
        lambda headings, book_id, max_depth=None: S.table_of_contents(_of(headings, book_id), max_depth), ("headings",), {"book_id": _BOOK, "max_depth": Param(int)}
    ),
    "get_paragraph": Tool(
        lambda sentences, book_id, para_id, language="english": P.get_paragraph(_of(sentences, book_id).filter(F.col("para_id") == para_id), language),
        ("sentences",),
        {"book_id": _BOOK, "para_id": _PARA, "language": LANGUAGE},
    ),
    "get_paragraph_range": Tool(
        lambda sentences, book_id, para_start, para_end, language="english": P.paragraph_range(_of(sentences, book_id), para_start, para_end, language).orderBy("para_id"),
        ("sentences",),
        {"book_id": _BOOK, "para_start": _PARA, "para_end": _PARA, "language": LANGUAGE},
    ),
    "get_nearby_context": Tool(_nearby, ("sentences",), {"book_id": _BOOK, "para_id": _PARA, "before": Param(int), "after": Param(int), "language": LANGUAGE}),
    "get_book_stats": Tool(
        lambda sentences, books, book_id: P.book_stats(
            _of(sentences, book_id), sentences.sparkSession.range(1).select(F.lit(book_id).alias("book_id")).join(_of(books, book_id), "book_id", "left")
        ),
        ("sentences", "books"),
        {"book_id": _BOOK},
    ),
    "find_paragraphs_by_keyword": Tool(
        lambda sentences, keyword, book_id=None, column="english", limit=None: S.keyword_search(sentences, keyword, column, book_id, limit),
        ("sentences",),
        {"keyword": Param(str, required=True), "book_id": Param((int, str)), "column": Param(str, choices=P.LANGUAGES), "limit": Param(int)},
    ),
}


def frame(name: str, args: dict, tables: dict[str, DataFrame]) -> DataFrame:
    """The tool's result; a ValueError for an unknown tool or an argument that does not fit."""
    tool = TOOLS.get(name)
    if tool is None:
        raise ValueError(f"unknown tool: {name}")
    if extra := args.keys() - tool.params.keys():
        raise ValueError(f"unknown arguments: {sorted(extra)}")
    for k, p in tool.params.items():
        v = args.get(k)
        if v is None and p.required:
            raise ValueError(f"{k} is missing")
        if v is not None and (not isinstance(v, p.kind) or p.choices and v not in p.choices):
            raise ValueError(f"{k} does not fit: {v!r}")
    return tool.run(*(tables[t] for t in tool.tables), **{k: v for k, v in args.items() if v is not None})


def call(name: str, args: dict, tables: dict[str, DataFrame], most: int = 1000) -> dict:
    """The rows and their count, or the error, as plain values for a model or a page."""
    try:
        rows = [r.asDict() for r in frame(name, args, tables).limit(most).collect()]
    except (ValueError, KeyError) as e:
        return {"error": str(e)}
    return {"rows": rows, "count": len(rows)}


def converse(model: Callable[[list[dict]], dict], prompt: str, tables: dict[str, DataFrame], most_calls: int = 10) -> tuple[str, list[dict]]:
    """A model's answer and the tool calls that led to it.

    The model gets the messages so far and gives {"text": ..., "calls": [{"name": ..., "args": ...}]}; the results of
    its calls are the next message. It ends with a turn without calls, or with the first after most_calls.
    """
    messages, done = [{"role": "user", "text": prompt}], []
    while True:
        turn = model(messages)
        calls = turn.get("calls") or []
        if not calls or len(done) >= most_calls:
            return (turn.get("text") or "").strip(), done
        results = [{**c, "result": call(c["name"], c.get("args") or {}, tables)} for c in calls]
        done += results
        messages += [{"role": "model", **turn}, {"role": "user", "results": results}]
