"""Streams over task logs and API calls. Times are event times; `ts` is cast to a timestamp with zone, as watermarks need."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def log_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder, in the order they came; the checkpoint of the query is the cursor."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def tail(logs: DataFrame, task_id: int) -> DataFrame:
    return logs.filter(F.col("task_id") == task_id).select("id", "task_id", "level", "ts")


def follow(
    logs: DataFrame, task_id: int, write: Callable[[DataFrame, int], None], ended: Callable[[], bool], checkpoint: str, wait_s: float = 5, idle_looks: int = 360
) -> int:
    """Hands over a task's new entries, look by look, until it has ended or `idle_looks` looks in a row found nothing; the number of looks.

    Whether it has ended is asked before a look, so what came in with the end is still handed over.
    """
    idle = looks = 0
    found = [0]

    def hand_over(batch: DataFrame, n: int) -> None:
        rows = batch.persist()
        found[0] += rows.count()
        write(rows, n)
        rows.unpersist()

    while idle <= idle_looks:
        last, found[0] = ended(), 0
        query = tail(logs, task_id).writeStream.foreachBatch(hand_over).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
        looks += 1
        if last:
            break
        idle = 0 if found[0] else idle + 1
        time.sleep(wait_s)
    return looks


def watchdog(logs: DataFrame, limit: float = 300, late: str = "1 minute") -> DataFrame:
    """(task_id, last_seen, silent): each task when its last entry is more than `limit` seconds behind the watermark, once for each silence.

    The state of a task is the time of its last entry, and is dropped with the report, so silent tasks leave nothing behind.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            yield pd.DataFrame({"task_id": [key[0]], "last_seen": [last]})
            return
        last = max([*(t for f in frames for t in f["t"]), *([state.get[0]] if state.exists else [])])
        state.update((last,))
        state.setTimeoutTimestamp(max(int((last + limit) * 1000), state.getCurrentWatermarkMs() + 1))

    rows = logs.withWatermark("ts", late).select("task_id", "ts", F.col("ts").cast("double").alias("t"))
    return rows.groupBy("task_id").applyInPandasWithState(run, "task_id long, last_seen double", "last double", "append", GroupStateTimeout.EventTimeTimeout)


def poll(look: Callable[[], DataFrame], start: Callable[[list], None], wait_s: float = 5, looks: int | None = None) -> int:
    """Starts what each look at the queue finds (see tasks.startable, whose rows are bounded), `looks` times or for ever; the number started."""
    started = done = 0
    while looks is None or done < looks:
        rows = look().collect()
        if rows:
            start(rows)
        started, done = started + len(rows), done + 1
        if looks is None or done < looks:
            time.sleep(wait_s)
    return started


def daily_quota(calls: DataFrame, late: str = "1 day", per_day: int = 1500) -> DataFrame:
    """Calls by task and day, with what is left of the day's quota; days close `late` after their end."""
    w = F.window("ts", "1 day")
    used = calls.withWatermark("ts", late).groupBy("task_id", w).agg(F.count("*").alias("used"))
    left = F.greatest(F.lit(0), per_day - F.col("used")).cast("long")
    return used.select("task_id", F.col("window.start").alias("day"), "used", left.alias("remaining"))


def silences(logs: DataFrame, limit: float = 300, late: str = "1 hour", idle_s: float = 7 * 86_400) -> DataFrame:
    """Gaps of more than `limit` seconds between a task's entries, in order of event time within each batch.

    The state of a task is the time of its last entry; it is dropped once the watermark is `idle_s` past it.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = sorted(t for f in frames for t in f["t"])
        last = state.get[0] if state.exists else None
        found = []
        for t in times:
            if last is not None and t - last > limit:
                found.append((key[0], t, t - last))
            last = t if last is None else max(last, t)
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(max(int((last + idle_s) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(found, columns=["task_id", "t", "gap_s"])

    rows = logs.withWatermark("ts", late).select("task_id", "ts", F.col("ts").cast("double").alias("t"))
    return rows.groupBy("task_id").applyInPandasWithState(
        run, "task_id long, t double, gap_s double", "last double", "append", GroupStateTimeout.EventTimeTimeout
    )
