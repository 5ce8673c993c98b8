"""A stream that is run to its end gives what the batch gives."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quarry.streaming import logs as L

SCHEMA = "id long, task_id long, level string, ts timestamp_ntz"


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(1)
    at, rows = datetime.datetime(2024, 1, 1), []
    for i in range(300):
        at += datetime.timedelta(seconds=rng.choice([1, 60, 200, 900, 4000]))
        rows.append((i, rng.randrange(4), "INFO", at))
    for k in range(3):
        spark.createDataFrame(rows[k * 100 : k * 100 + 100], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return tmp_path


def run(df, where, mode):
    df.writeStream.format("memory").queryName(where).outputMode(mode).trigger(availableNow=True).start().awaitTermination(120)
    return df.sparkSession.table(where)


def test_tail_and_quota(spark, folder):
    batch = spark.read.schema(SCHEMA).parquet(f"{folder}/in").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = lambda: L.log_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1)
    got = run(L.tail(stream(), 2), "tailed", "append")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in batch.filter("task_id = 2").collect())
    got = run(L.daily_quota(stream()), "quotas", "complete")
    want = batch.groupBy("task_id", F.to_date("ts").alias("d")).count().collect()
    assert {(r.task_id, r.day.date()): r.used for r in got.collect()} == {(r.task_id, r.d): r["count"] for r in want}


def test_silences(spark, folder):
    got = run(L.silences(L.log_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1)), "silent", "append").collect()
    last, want = {}, []
    for r in spark.read.schema(SCHEMA).parquet(f"{folder}/in").orderBy("id").collect():
        if r.task_id in last and (r.ts - last[r.task_id]).total_seconds() > 300:
            want.append((r.task_id, (r.ts - last[r.task_id]).total_seconds()))
        last[r.task_id] = r.ts
    assert sorted((r.task_id, r.gap_s) for r in got) == sorted(want)


def test_watchdog(spark, folder):
    got = run(L.watchdog(L.log_stream(spark, f"{folder}/in", SCHEMA, files_per_batch=1)), "watched", "append").collect()
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/in").withColumn("t", F.col("ts").cast("timestamp").cast("double")).collect()
    end = max(r.t for r in rows) - 60
    last = {k: max(r.t for r in rows if r.task_id == k) for k in range(4)}
    # every task whose last entry is behind the last watermark by more than the limit is reported with it
    assert {(k, t) for k, t in last.items() if t < end - 300} <= {(r.task_id, r.last_seen) for r in got}
    assert all((r.task_id, r.last_seen) in {(x.task_id, x.t) for x in rows} for r in got)


def test_follow_stops(spark, folder):
    seen = []
    stream = lambda: L.log_stream(spark, f"{folder}/in", SCHEMA)
    write = lambda df, n: seen.extend(r.id for r in df.collect())
    looks = L.follow(stream(), 2, write, lambda: bool(seen), f"{folder}/cp", wait_s=0)
    want = [r.id for r in spark.read.schema(SCHEMA).parquet(f"{folder}/in").filter("task_id = 2").collect()]
    assert looks == 2 and sorted(seen) == sorted(want)
    assert L.follow(stream(), 2, write, lambda: False, f"{folder}/cp", wait_s=0, idle_looks=1) == 2 and len(seen) == len(want)
