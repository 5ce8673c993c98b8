"""What the operators share: the shared folder, staged tables, word and line patterns."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and line rules, inside a character class.
WS = r"\x20\x09-\x0D"
#: The same characters one by one, as trim() takes them.
WS_CHARS = " \t\n\x0b\x0c\r"
_RECLAIM = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, with its scheme: spark.checkpoint.dir.

    Where that is unset, a temporary folder serves a local master, whose driver and executors are one
    process; a cluster gets an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if where is None and not sc._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    where = where or tempfile.mkdtemp(prefix="quarry-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    path = sc._jvm.org.apache.hadoop.fs.Path(where)
    whole = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def reclaimed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query planned in here as soon as the query has ended."""
    was = spark.conf.get(_RECLAIM, None)
    spark.conf.set(_RECLAIM, "true")
    try:
        yield
    finally:
        spark.conf.set(_RECLAIM, was) if was is not None else spark.conf.unset(_RECLAIM)


def stage(df: DataFrame, name: str, *partition_by: str) -> tuple[DataFrame, str]:
    """Writes df as compressed Parquet in the shared folder and reads it back, which cuts its lineage there; the path is for discard()."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    with reclaimed(spark):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes staged tables that no frame reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file; a reader sees the old one or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = new.getFileSystem(conf).create(new)
    out.write(bytearray(text.encode()))
    out.close()
    # of the file contexts' calls this one replaces its target
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), conf).rename(new, to, options)


def get_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def settled(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint, for frames of any columns; Spark keeps it unless spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_dir(df.sparkSession)
    with reclaimed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(docs: DataFrame, doc_id: str, text: str, range_bytes: int, most: int = 50_000) -> DataFrame:
    """(doc_id, text) in partitions that are ranges of ascending doc_id of about range_bytes of text, sorted within.

    There are no more ranges than `most` or the shuffle partitions, whichever is larger. Rows of one doc_id keep their
    order, and many of them are spread over several ranges.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(max(most, partitions(docs.sparkSession)), -(-total // range_bytes)))
    src = src.withColumn("_at", F.monotonically_increasing_id())
    parted = src.repartitionByRange(ranges, "doc_id", "_at") if ranges > 1 else src.coalesce(1)
    return parted.sortWithinPartitions("doc_id", "_at").select("doc_id", "text")


def fingerprint(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with separate seeds, 128 bits together."""
    return F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)


def words(text: Column) -> Column:
    """The maximal runs of other than WS, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WS}]+", -1), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z folded, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
