"""Logical tables of a corpus: schemas, options, checks, and their binding to the driver's tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "books": "book_id string, book_name string, nikaya string, sub_nikaya string, category string",
    "headings": "book_id string, para_id long, level int, title string, parent long, chapter_len int, sc_id string",
    "sentences": "book_id string, para_id long, line_id long, pali_sentence string, english_translation string, vietnamese_translation string, thaipage string, vripage string, ptspage string",
    "nissaya": "book_id string, para_id long, line_id long, content string, channel_id string",
    "book_links": "src_book string, src_para long, src_line long, dst_book string, dst_para long, dst_line long",
    "pali_definition": "word string, plain string, stem string, book_id string, para_id long, line_id long",
    "en_translation": "sc_id string, book_id string, sutta_name string, palitext string, entext string",
    "glossary": "id long, pali string, english string, domain string, sub_domain string, context string, note string, source_id string, created_at double",
    "task_queue": "id long, job_type string, job_params string, status string, priority int, api_key_id long, started_at double, finished_at double, error_msg string, max_retries int, retry_delay int, run_after double, created_at double, heartbeat_at double",
    "task_logs": "id long, task_id long, level string, message string, ts double",
    "api_keys": "id long, provider string, alias string, api_key string, is_active int, exhausted_at double, total_calls long, total_errors long, created_at double",
    "settings": "key string, value string, updated_at double",
}


class CorpusCatalog:
    """Reads a corpus kept as one Parquet table per logical table under a root, which is an option and has no default."""

    def __init__(self, spark: SparkSession, root: str | None):
        if not root:
            raise ValueError("the corpus has no path")
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")

    def _there(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def optional(self, name: str) -> DataFrame:
        """The table, or an empty one where it is missing."""
        return self.table(name) if self._there(name) else self.spark.createDataFrame([], SCHEMAS[name])

    def missing(self, expected: Iterable[str] = tuple(SCHEMAS)) -> list[str]:
        return [x for x in expected if not self._there(x)]

    def sentences(self) -> DataFrame:
        """The table sentences under the names that the operators use."""
        return self.table("sentences").withColumnsRenamed(
            {"pali_sentence": "pali", "english_translation": "english", "vietnamese_translation": "vietnamese"}
        )

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/{name}")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file or folder of JSON lines; blank lines are skipped and a missing path has no rows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_texts(rows: DataFrame, path: str, name: str, text: str) -> None:
    """Each row's text as files of its own, in a folder of the name: prompts and answers as they were sent."""
    rows.select(F.col(name).alias("name"), F.col(text).alias("value")).write.mode("append").partitionBy("name").text(path)


def save_state(state: DataFrame, path: str) -> None:
    """A small state table as JSON lines in a new version below the path; the old versions stay readable."""
    version = max(_versions(state.sparkSession, path), default=0) + 1
    state.coalesce(1).write.json(f"{path}/v{version:08d}")


def load_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last whole version that save_state() wrote; no rows without any."""
    version = max(_versions(spark, path), default=0)
    return read_jsonl(spark, f"{path}/v{version:08d}", schema)


def _versions(spark: SparkSession, path: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v*/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return [int(x.getPath().getParent().getName()[1:]) for x in found]


def with_column_if_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def missing_tables(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Names that are expected and not present; both frames have a column name."""
    return expected.select("name").distinct().join(present.select("name"), "name", "left_anti")


class DriverTables:
    """The driver's tables as the logical tables of a corpus."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sentences(self) -> DataFrame:
        """conversations by line: book_id, para_id, line_id (from 0), pali, english for the assistant's turns, and made-up pages."""
        c = self.raw("conversations")
        lines = c.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("para_id"), "role", F.posexplode(F.split("text", "\n")).alias("line_id", "pali"))
        # system turns have a second translation, and every other line pages
        page = F.concat_ws(".", "para_id", "line_id")
        return lines.withColumns(
            {
                "line_id": F.col("line_id").cast("long"),
                "english": F.when(F.col("role") == "assistant", F.col("pali")),
                "vietnamese": F.when(F.col("role") == "system", F.concat(F.lit("vi "), "pali")),
                "thaipage": page,
                "vripage": F.when(F.col("para_id") % 2 == 0, F.concat(F.lit("v"), page)),
                "ptspage": F.lit(None).cast("string"),
            }
        )

    def headings(self) -> DataFrame:
        """The user's turns, each with a chapter of two paragraphs."""
        c = self.raw("conversations").filter("role = 'user'")
        return c.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("para_id"), F.lit(2).alias("chapter_len"))

    def headings_with_ids(self) -> DataFrame:
        """headings() with an sc_id, the number of a document; it is null or empty at the start of some books."""
        kind = F.col("book_id") % 5
        sc_id = F.when((F.col("para_id") > 1) | (kind > 1), F.col("book_id") + F.col("para_id")).cast("string")
        return self.headings().withColumn("sc_id", F.when((F.col("para_id") <= 1) & (kind == 1), "").otherwise(sc_id))

    def links(self) -> DataFrame:
        """From each line to the same line of the next paragraph, where there is one."""
        s = self.sentences().select("book_id", "para_id", "line_id")
        src = s.select(F.col("book_id").alias("src_book"), F.col("para_id").alias("src_para"), F.col("line_id").alias("src_line"))
        dst = s.select(F.col("book_id").alias("dst_book"), F.col("para_id").alias("dst_para"), F.col("line_id").alias("dst_line"))
        on = (F.col("src_book") == F.col("dst_book")) & (F.col("src_para") + 1 == F.col("dst_para")) & (F.col("src_line") == F.col("dst_line"))
        return src.join(dst, on)

    def tree(self) -> DataFrame:
        """part as a tree: id, parent (id div 4, root 0) and title."""
        return self.raw("part").select(F.col("p_partkey").alias("id"), F.expr("p_partkey div 4").alias("parent"), F.col("p_name").alias("title"))
