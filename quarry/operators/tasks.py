"""Task queue, key pool and log analytics; the present time is a parameter everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runnable(tasks: DataFrame, now: float) -> DataFrame:
    return tasks.filter((F.col("status") == "pending") & (F.col("run_after").isNull() | (F.col("run_after") <= now)))


def next_task(tasks: DataFrame, now: float, n: int = 1) -> DataFrame:
    return runnable(tasks, now).orderBy("priority", "created_at", "id").limit(n)


def startable(tasks: DataFrame, now: float, most: int) -> DataFrame:
    """The next tasks to start so that no more than `most` run: what a poller takes at each look."""
    free = max(0, most - tasks.filter("status = 'running'").count())
    return next_task(tasks, now, free)


def usable_keys(keys: DataFrame, provider: str | None = None, allowed: list[int] | None = None) -> DataFrame:
    """Active keys that are not exhausted, of a provider and among the allowed ids, where these are given."""
    df = keys.filter((F.col("is_active") == 1) & F.col("exhausted_at").isNull())
    if provider is not None:
        df = df.filter(F.col("provider") == provider)
    return df if allowed is None else df.filter(F.col("id").isin(allowed))


def next_key(keys: DataFrame, provider: str, allowed: list[int] | None = None) -> DataFrame:
    return usable_keys(keys, provider, allowed).orderBy("total_calls", "id").limit(1)


def after_model_change(keys: DataFrame, old: str, new: str) -> DataFrame:
    """Another model has other limits, so no key stays exhausted."""
    return keys if old == new else keys.withColumn("exhausted_at", F.lit(None).cast("double"))


def restored_keys(keys: DataFrame, now: float, cooldown: float = 3600) -> DataFrame:
    return keys.filter(F.col("exhausted_at") < now - cooldown)


def cooldown_left(keys: DataFrame, now: float, cooldown: float = 3600) -> DataFrame:
    left = F.greatest(F.lit(0), F.ceil((F.col("exhausted_at") + cooldown - now) / 60))
    return keys.filter("exhausted_at is not null").withColumn("minutes_left", left.cast("long"))


def recent(tasks: DataFrame, n: int) -> DataFrame:
    return tasks.orderBy(F.desc("created_at"), F.desc("id")).limit(n)


def status_counts(tasks: DataFrame, n: int = 50) -> DataFrame:
    """Of the latest n tasks, as many as the dashboard shows."""
    return recent(tasks, n).groupBy("status").agg(F.count("*").alias("n"))


def stale(tasks: DataFrame, now: float, limit: float = 300) -> DataFrame:
    return tasks.filter((F.col("status") == "running") & (F.coalesce("heartbeat_at", "started_at") < now - limit))


def reschedule(tasks: DataFrame, now: float) -> DataFrame:
    """The pending rows that follow failed tasks with a retry left, after a transient error."""
    again = tasks.filter((F.col("status") == "failed") & F.col("retryable") & (F.col("max_retries") > 0))
    return again.select(
        F.col("id").alias("of_id"), "job_type", F.lit("pending").alias("status"), "priority", (F.col("max_retries") - 1).alias("max_retries"), "retry_delay", (F.lit(now) + F.col("retry_delay")).alias("run_after")
    )


def cancelled(status: Column) -> Column:
    return F.when(status.isin("pending", "running"), "cancelled").otherwise(status)


def retried(tasks: DataFrame) -> DataFrame:
    """Clones to run anew: type, parameters and priority alone pass over."""
    return tasks.select(F.col("id").alias("of_id"), "job_type", "priority", F.lit("pending").alias("status"))


def current_state(events: DataFrame) -> DataFrame:
    """(task, state, at) events to the last state of each task; terminal states also give the end and the error's text, if events have one."""
    error = F.col("error") if "error" in events.columns else F.lit(None).cast("string").alias("error")
    last = events.groupBy("task_id").agg(F.max(F.struct("ts", "event_id", "state", error)).alias("r"))
    ended = F.col("r.state").isin("done", "failed", "cancelled")
    return last.select(
        "task_id", F.col("r.state").alias("state"), F.when(ended, F.col("r.ts")).alias("finished_at"), F.when(ended, F.col("r.error")).alias("error_msg")
    )


def key_counters(events: DataFrame) -> DataFrame:
    return events.groupBy("key_id").agg(F.count("*").alias("total_calls"), F.count_if(F.col("is_error")).alias("total_errors"))


def key_flags(events: DataFrame) -> DataFrame:
    """Keys as their log of (key_id, ts, event_id, what) leaves them: calls, errors, exhausted_at and is_active.

    what: call, error, exhausted (an error too), cleared, on, off or delete; a key whose last flag is delete is gone.
    """
    at = F.struct("ts", "event_id")
    is_ = lambda *names: F.col("what").isin(*names)
    last = lambda *names: F.max(F.when(is_(*names), F.struct("ts", "event_id", "what")))
    df = events.groupBy("key_id").agg(
        F.count_if(is_("call")).alias("total_calls"),
        F.count_if(is_("error", "exhausted")).alias("total_errors"),
        last("exhausted", "cleared").alias("spent"),
        last("on", "off").alias("switch"),
        F.max(F.when(is_("delete"), at)).alias("gone"),
        F.max(at).alias("latest"),
    )
    exhausted = F.when(F.col("spent.what") == "exhausted", F.col("spent.ts"))
    active = F.coalesce(F.col("switch.what") != "off", F.lit(True)).cast("int")
    return df.filter("gone is null or gone < latest").select(
        "key_id", "total_calls", "total_errors", exhausted.alias("exhausted_at"), active.alias("is_active")
    )


def progress(done: Column, total: Column, elapsed: Column) -> dict[str, Column]:
    """Percent done, items a second and the whole seconds left, null where nothing is done yet or nothing is left."""
    rate = done / F.greatest(elapsed, F.lit(0.001))
    left = F.when((rate > 0) & (done < total), F.floor((total - done) / rate)).cast("long")
    return {"percent": done / F.greatest(total, F.lit(1)) * 100, "rate": rate, "left_s": left}


def durations(started: Column, finished: Column, now: float) -> dict[str, Column]:
    """How long a task took and how long ago it began, in words."""
    d, ago = finished - started, F.lit(now) - started
    whole = lambda x: F.floor(x + 0.5).cast("long").cast("string")
    took = F.when(d < 60, F.concat(F.format_number(d, 1), F.lit("s"))).otherwise(
        F.concat(whole(d / 60), F.lit("m "), whole(d % 60), F.lit("s"))
    )
    unit = lambda s, u: F.concat(whole(ago / s), F.lit(f"{u} ago"))
    return {
        "took": F.coalesce(took, F.lit("—")),
        "ago": F.when(started.isNull(), "—").when(ago < 60, unit(1, "s")).when(ago < 3600, unit(60, "m")).when(ago < 86400, unit(3600, "h")).otherwise(unit(86400, "d")),
    }


def backoff(k: Column) -> dict[str, Column]:
    """Seconds to wait before try k, from 0, by the three schedules in use."""
    return {
        "exponential": (F.lit(60) * F.pow(F.lit(2), k)).cast("long"),
        "linear": (5 * k).cast("long"),
        "capped": F.least(F.lit(120), 30 * (k + 1)).cast("long"),
    }


def round_robin(rows: DataFrame, order: str, n: int, group: str) -> DataFrame:
    """Each row's slot in a pool of n keys, by turns within a group."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return rows.withColumn("slot", F.pmod(nth, F.lit(n)).cast("long"))


def quota(calls: DataFrame, per_day: int = 1500) -> DataFrame:
    """Calls used and left by key and day."""
    used = calls.groupBy("key_id", "day").agg(F.count("*").alias("used"))
    return used.withColumns({"remaining": F.greatest(F.lit(0), per_day - F.col("used")).cast("long"), "exhausted": F.col("used") >= per_day})


def pool_state(quotas: DataFrame) -> DataFrame:
    """For each day of quota() the keys used, those with calls left, and whether none has any."""
    left = F.count_if(~F.col("exhausted"))
    return quotas.groupBy("day").agg(F.count("*").alias("keys"), left.alias("available"), (left == 0).alias("all_exhausted"))


def gaps(logs: DataFrame, ts: str, of: str, key: str) -> DataFrame:
    """Each entry with the seconds since the one before it of the same `of` (a task or a key), null for its first.

    The order is taken in days: within each by a window, and across days by the last entry of the days before, so the
    entries of one that has very many meet by days.
    """
    daily = logs.withColumn("_day", F.to_date(ts))
    last = daily.groupBy(of, "_day").agg(F.max(ts).alias("_last"))
    before = last.select(of, "_day", F.lag("_last").over(Window.partitionBy(of).orderBy("_day")).alias("_before"))
    inside = F.lag(ts).over(Window.partitionBy(of, "_day").orderBy(ts, key))
    df = daily.withColumn("_prev", inside).join(before, [of, "_day"])
    return df.withColumn("gap_s", (F.unix_micros(ts) - F.unix_micros(F.coalesce("_prev", "_before"))) / 1e6).drop("_day", "_prev", "_before")


def log_tail(logs: DataFrame, task_id: int, last_id: int) -> DataFrame:
    return logs.filter((F.col("task_id") == task_id) & (F.col("id") > last_id)).orderBy("id")


def token_stats(rows: DataFrame, budget: int = 8192, share: float = 0.85) -> DataFrame:
    """Mean tokens and sentences of samples, tokens per sentence, and the sentences that fit a budget."""
    m = rows.agg(F.avg("tokens").alias("mean_tokens"), F.avg("sentences").alias("mean_sentences"))
    per = F.when(F.col("mean_sentences") > 0, F.col("mean_tokens") / F.col("mean_sentences"))
    m = m.withColumn("per_sentence", per)
    return m.withColumn("recommended", F.when(F.col("per_sentence") > 0, F.floor(budget * share / F.col("per_sentence"))).cast("long"))


def usage_rows(answers: DataFrame) -> DataFrame:
    """Answers (sc_id, n_sentences, prompt, raw, seconds, finish_reason) as rows of what they took, a token for each four characters."""
    chars = {c: F.length(F.coalesce(F.col(c), F.lit(""))).cast("long") for c in ("prompt", "raw")}
    tokens = {c: F.floor(n / 4).cast("long") for c, n in chars.items()}
    return answers.select(
        "sc_id", "n_sentences", chars["prompt"].alias("prompt_chars"), chars["raw"].alias("output_chars"), "finish_reason", F.round("seconds", 1).alias("elapsed_s"),
        tokens["prompt"].alias("prompt_tokens"), tokens["raw"].alias("candidates_tokens"), (tokens["prompt"] + tokens["raw"]).alias("total_tokens"),
    )
