"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.shared import WS_CHARS, ascii_lower, discard, fingerprint, get_text, partitions, put_text, reclaimed, scratch, stage

#: Spark then takes the order of a bucket that is one file as given, and does not take buckets for partitions of a union, where it
#: may read them as plain files (Spark 4.1).
_SETTINGS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.unionOutputPartitioning": "false"}


@contextlib.contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    was = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        with reclaimed(spark):
            yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


class LineRuns:
    """Levelled sorted runs of line hashes in a folder, with a manifest, so another driver can go on with them.

    A run is a table of (h1, h2, docs, keeper): the number of documents that hold a line and the
    largest doc_id among them. It is bucketed by the hashes, a sorted file a bucket, and all runs have the
    same buckets, so a batch is joined with the runs as they are, bucket by bucket, without a shuffle or a
    sort of them. A batch of documents adds one run to level 0. When a level has `fan_in` runs, they are
    merged into one run of the next level, so an entry is rewritten once a level and the runs stay few.

    Batches come in descending order of doc_id. An entry that has reached `min_docs` then is settled:
    later batches can neither raise its keeper nor change that its lines go. A batch is therefore
    merge-anti-joined with the settled entries of the runs and adds only the rest.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int, fan_in: int = 3, buckets: int | None = None):
        self.spark, self.path, self.min_docs, self.fan_in = spark, path, min_docs, fan_in
        # Spark allows no more buckets by default
        self.buckets = buckets or min(100_000, partitions(spark))
        self.levels: list[list[str]] = [[]]
        self.schema = ""

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LineRuns:
        """The runs that the manifest in the folder lists."""
        kept = json.loads(get_text(spark, f"{path}/manifest.json"))
        runs = cls(spark, path, kept["min_docs"], kept["fan_in"], kept["buckets"])
        runs.levels, runs.schema = kept["levels"], kept["schema"]
        for name in runs.names():
            clustered = f"clustered by (h1, h2) sorted by (h1, h2) into {runs.buckets} buckets"
            spark.sql(f"create table if not exists {name} ({runs.schema}) using parquet {clustered} location '{path}/{name}'")
        return runs

    def _save(self) -> None:
        kept = {k: getattr(self, k) for k in ("min_docs", "fan_in", "buckets", "levels", "schema")}
        put_text(self.spark, f"{self.path}/manifest.json", json.dumps(kept))

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for name in self.names()]

    def _write(self, entries: DataFrame, level: int) -> None:
        """entries come out of an aggregation, so each bucket is in one partition and becomes one file."""
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"quarry_line_run_{uuid.uuid4().hex}"
        where = {"path": f"{self.path}/{name}", "compression": "zstd"}
        entries.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").options(**where).format("parquet").saveAsTable(name)
        self.schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema.fields)
        self.levels[level].append(name)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table if exists {name}")
        discard(self.spark, *(f"{self.path}/{name}" for name in names))

    @staticmethod
    def _merge(entries: DataFrame) -> DataFrame:
        return entries.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        return every

    def add(self, lines: DataFrame) -> None:
        """lines: (doc_id, h1, h2), each line of a document once."""
        with _in_order(self.spark):
            new = lines.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
            for run in self.runs():
                new = new.join(run.filter(F.col("docs") >= self.min_docs).select("h1", "h2"), ["h1", "h2"], "left_anti")
            self._write(new, 0)
            level, old = 0, []
            while len(self.levels[level]) >= self.fan_in:
                merged, self.levels[level] = self.levels[level], []
                self._write(self._merge(self._union([self.spark.table(name) for name in merged])), level + 1)
                old += merged
                level += 1
        # what the manifest lists is there before and after
        self._save()
        self._drop(old)

    def frequent(self, name: str) -> tuple[DataFrame, str]:
        """(h1, h2, keeper) of the lines that at least min_docs documents hold, staged, and its path."""
        with _in_order(self.spark):
            return stage(self._merge(self._union(self.runs())).filter(F.col("docs") >= self.min_docs).select("h1", "h2", "keeper"), name)

    def drop(self) -> None:
        """Deletes the runs and their folder."""
        self._drop(self.names())
        discard(self.spark, self.path)


def line_hashes(text: Column, min_chars: int) -> Column:
    """For each line of text, in order, the two hashes of its key; null where the key has fewer than min_chars code points."""

    def hashed(line: Column) -> Column:
        h1, h2 = fingerprint(line)
        return F.when(F.length(line) >= min_chars, F.struct(h1.alias("h1"), h2.alias("h2")))

    keys = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: ascii_lower(F.btrim(x, F.lit(WS_CHARS))))
    return F.transform(keys, hashed)


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fan_in: int = 3,
    batch_rows: int = 100_000_000,
) -> DataFrame:
    """docs with repeated lines removed from the text, and n_lines and n_dropped.

    Lines are parted at newlines. A line's key is the line stripped of ASCII white space at both ends
    with A-Z folded. Keys of at least min_chars code points in at least min_docs documents lose their
    lines everywhere but in the largest doc_id that holds them; other lines stay and are joined by
    newlines. The documents go through the runs (see LineRuns) in `batches` batches, or more where
    that would make one larger than batch_rows documents, up to 1024.

    Null or empty text: one empty line, which stays, so the text becomes "". A null doc_id is below
    all others. Rows with one doc_id count as documents of their own, and if theirs is the largest,
    all of them keep the line. An empty table gives an empty table. Names that begin with _quarry are reserved. Columns of docs other than the
    text stay; those named n_lines or n_dropped are replaced.
    """
    spark = docs.sparkSession
    t1, t2 = fingerprint(F.col(text))
    hashed, path = stage(
        docs.select(F.col(doc_id).alias("doc_id"), t1.alias("t1"), t2.alias("t2"), line_hashes(F.col(text), min_chars).alias("hs")).filter(
            F.exists("hs", lambda h: h.isNotNull())
        ),
        "line-hashes",
    )
    # bounds of the batches, from the ids alone
    n, quantiles = docs.agg(F.count("*"), F.percentile_approx(doc_id, [i / 1024 for i in range(1, 1024)], 10_000)).first()
    batches = min(1024, max(batches, -(-n // batch_rows)))
    cuts = [quantiles[i * 1024 // batches - 1] for i in range(1, batches)] if quantiles else []
    bounds = sorted(set(cuts), reverse=True)
    runs = LineRuns(spark, scratch(spark, "line-runs"), min_docs, fan_in)
    c = F.col("doc_id")
    for k in range(len(bounds) + 1):
        above = F.lit(True) if k == 0 else (c < bounds[k - 1]) | c.isNull() if k == len(bounds) else c < bounds[k - 1]
        within = above if k == len(bounds) else above & (c >= bounds[k])
        each = hashed.filter(within).select("doc_id", F.explode(F.array_distinct("hs")).alias("h")).filter("h is not null")
        runs.add(each.select("doc_id", "h.h1", "h.h2"))
    frequent, frequent_at = runs.frequent("frequent-lines")
    runs.drop()

    places = hashed.select("doc_id", "t1", "t2", F.posexplode("hs").alias("pos", "h")).filter("h is not null")
    gone = (
        places.select("doc_id", "t1", "t2", "pos", "h.h1", "h.h2")
        .join(frequent, ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "t1", "t2")
        .agg(F.collect_set("pos").alias("_quarry_gone"))
        .select(F.col("doc_id").alias("_quarry_id"), F.col("t1").alias("_quarry_t1"), F.col("t2").alias("_quarry_t2"), "_quarry_gone")
    )
    gone, _ = stage(gone, "dropped-lines")
    discard(spark, path, frequent_at)
    same = F.col(doc_id).eqNullSafe(F.col("_quarry_id")) & (t1 == F.col("_quarry_t1")) & (t2 == F.col("_quarry_t2"))
    joined = docs.join(gone, same, "left").withColumn("_quarry_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    # array_except looks positions up by hash; the lines that stay are then taken in order
    stay = F.array_except(F.sequence(F.lit(0), F.size("_quarry_lines") - 1), "_quarry_gone")
    left = F.transform(stay, lambda i: F.get("_quarry_lines", i))
    return joined.withColumns(
        {
            text: F.when(F.col("_quarry_gone").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(left, "\n")),
            "n_lines": F.size("_quarry_lines").cast("long"),
            "n_dropped": F.coalesce(F.size("_quarry_gone"), F.lit(0)).cast("long"),
        }
    ).drop("_quarry_id", "_quarry_t1", "_quarry_t2", "_quarry_gone", "_quarry_lines")
