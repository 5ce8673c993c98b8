"""A training-data pipeline of five operators, each stage written and reread before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.line_dedup import dedup_lines
from quarry.llm.mixing import mixed_documents
from quarry.llm.near_dedup import drop_near_duplicates
from quarry.llm.packing import pack
from quarry.llm.quality import quality_filter
from quarry.llm.queries import documents, tokenizer_path
from quarry.llm.shared import discard, scratch

#: SQL can express neither the near-duplicate stage's components nor the draws of the mixing stage.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines left; n_chars, where there is one, is that of the new text."""
    out = dedup_lines(docs).select(*docs.columns)
    return out.selectExpr(*("cast(length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents; what a stage wrote goes when the next one has written its own."""
    docs, before = documents(spark, sf_dir), None
    where = scratch(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{where}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
