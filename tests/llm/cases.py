"""Small tables with the odd cases that every operator has to handle."""

from pyspark.sql import SparkSession

TEXTS = [
    None,
    "",
    " \t\n ",
    "One line that is long enough to count.\nand a tail\n\nx",
    "One line that is long enough to count.\nanother tail",
    "ONE LINE that is long enough to count.  \nOne line that is long enough to count.",
    "Released under the MIT License. MIT license, Apache License, Version 2.0.",
    "école Ünïcode ÉCOLE 日本語 don't <|endoftext|> a\x1cb",
    "same eight words here are said again now " * 40,
    "w " * 30_000,
]


def odd(spark: SparkSession):
    """Rows with nulls in every column, empty and long texts, ties, repeated rows and clashing extra columns."""
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "a null id with some words", "s0"), (None, None, None), (-5, "below zero", "s1")]
    return spark.createDataFrame(
        [(*r, 1, "z", 2, 3, "l") for r in rows],
        "doc_id long, text string, source string, shard int, lang string, n_lines long, h1 long, size string",
    )


def empty(spark: SparkSession):
    return odd(spark).limit(0)
