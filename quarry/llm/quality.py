"""Quality rules by cross-document line frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import WS, WS_CHARS, ascii_lower, fingerprint, stage, words

#: Words of a window whose repetition counts.
WINDOW = 8


def repeat_words(w: Column, hashes: Column) -> Column:
    """Words of w inside windows whose hash occurs twice or more; hashes has one per window, in order.

    The windows are sorted by hash, so equal ones are neighbours; then the positions of these are
    swept from the left. This takes n log n steps and is skipped where all hashes differ.
    """

    def swept(s: Column) -> Column:
        again = F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]))
        at = F.array_sort(F.transform(again, lambda e: e["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            at,
            zero,
            lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n"), (p + WINDOW).alias("end")),
            lambda a: a["n"],
        )

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # transform() over an array of one binds the sorted array to a name, so that it is made once
    found = F.get(F.transform(F.array(F.array_sort(pairs)), swept), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found).cast("long")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null text has no words and no lines. Columns of these names in docs are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns(
        {
            "_quarry_w": words(F.col(text)),
            "_quarry_l": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{WS}]")),
        }
    )
    starts = F.when(F.size("_quarry_w") >= WINDOW, F.sequence(F.lit(1), F.size("_quarry_w") - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>")
    )
    df = df.withColumns({"_quarry_h": F.transform(starts, lambda i: F.xxhash64(F.slice("_quarry_w", i, WINDOW)))})
    df = df.withColumns(
        {
            "n_words": F.size("_quarry_w").cast("long"),
            "word_chars": F.length(F.array_join("_quarry_w", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("_quarry_l") - F.size(F.array_distinct("_quarry_l"))).cast("long"),
            "n_repeat_words": repeat_words(F.col("_quarry_w"), F.col("_quarry_h")),
        }
    ).drop("_quarry_w", "_quarry_l", "_quarry_h")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumns({"base_failed": failed})


def quality_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_docs: int = 10,
    max_share: float = 0.05,
    least_left: float = 0.3,
    least_words: int = 20,
    count: str = "texts",
    keep_key: bool = False,
) -> DataFrame:
    """The base rules and the verdict by cross-document line frequency, one row per row of docs.

    Lines are stripped, A-Z folded and hashed. A line is boilerplate on a host where it stands in
    more than min_docs distinct documents and in more than max_share of the host's distinct
    documents. What counts as a document is `count`: "texts" counts copies of one text once, so
    copying a clean document does not turn its lines into boilerplate; "documents" counts every row.
    Boilerplate lines are removed, and a document is depleted when less than least_left of its words,
    or fewer than least_words, are left. kept: neither failed by the base rules nor depleted.

    Null or empty text: no words, so base_failed. Null host: a host of its own. Repeated rows each
    get their row; ties cannot occur. An empty table gives an empty table. Other columns of docs,
    whatever their names, are ignored: the result has doc_id, the counts, n_removed_words,
    base_failed and kept, and with keep_key host and two hashes of the text, t1 and t2.
    """
    if count not in ("texts", "documents"):
        raise ValueError(f"count is texts or documents, not {count!r}")
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: ascii_lower(F.btrim(x, F.lit(WS_CHARS))))
    lines = F.transform(
        F.filter(keys, lambda x: x != ""),
        lambda x: F.struct(*(h.alias(k) for k, h in zip(("h1", "h2"), fingerprint(x), strict=True)), F.size(F.split(x, f"[{WS}]+", -1)).alias("n")),
    )
    t1, t2 = fingerprint(F.col("text"))
    # one pass over the texts; what follows is narrow
    rows, _ = stage(
        base_rules(src.withColumns({"lines": lines, "t1": t1, "t2": t2})).drop("text").withColumn("rid", F.monotonically_increasing_id()),
        "quality",
    )
    every = rows.select("rid", "host", "t1", "t2", F.explode("lines").alias("l")).select("*", "l.*").drop("l")
    document = ["t1", "t2"] if count == "texts" else ["rid"]
    often = (
        every.select("host", "h1", "h2", *document)
        .distinct()
        .groupBy("host", "h1", "h2")
        .agg(F.count("*").alias("docs"))
        .filter(F.col("docs") > min_docs)
    )
    totals = rows.select(F.col("host").alias("host2"), *document).distinct().groupBy("host2").agg(F.count("*").alias("all_docs"))
    boiler = (
        often.join(totals, F.col("host").eqNullSafe(F.col("host2")))
        .filter(F.col("docs") > max_share * F.col("all_docs"))
        .select("host2", F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    )
    same = (F.col("h1") == F.col("b1")) & (F.col("h2") == F.col("b2")) & F.col("host").eqNullSafe(F.col("host2"))
    removed = (
        every.join(boiler, same, "left_semi")
        .groupBy("rid")
        .agg(F.sum("n").alias("removed"))
        .withColumnRenamed("rid", "rid2")
    )
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < least_left * F.col("n_words")) | (left < least_words))
    return (
        rows.join(removed, F.col("rid") == F.col("rid2"), "left")
        .withColumn("n_removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept",
            *(["host", "t1", "t2"] if keep_key else []),
        )
    )


def quality_filter(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **options) -> DataFrame:
    """docs without the rows that quality_verdicts() rejects; columns and repeated rows stay as they are.

    The verdict depends on text and host alone, so the rows are matched by doc_id, host and the
    hashes of the text.
    """
    good = quality_verdicts(docs, doc_id, text, host, keep_key=True, **options).filter("kept")
    good = good.select(*(F.col(c).alias(f"_quarry_good_{c}") for c in ("doc_id", "host", "t1", "t2"))).distinct()
    t1, t2 = fingerprint(F.col(text))
    same = (
        F.col(doc_id).eqNullSafe(F.col("_quarry_good_doc_id"))
        & F.col(host).eqNullSafe(F.col("_quarry_good_host"))
        & (t1 == F.col("_quarry_good_t1"))
        & (t2 == F.col("_quarry_good_t2"))
    )
    return docs.join(good, same, "left_semi")
