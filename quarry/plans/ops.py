"""Queries over merges, tasks, keys, logs and parsing, bound to the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import parsing
from quarry.functions import text as T
from quarry.functions.roman import to_roman
from quarry.functions.staging import scratch
from quarry.operators import context as C
from quarry.operators import merge as M
from quarry.operators import paragraphs as P
from quarry.operators import tasks as K
from quarry.plans.mapping import map_headings
from quarry.sources.catalog import DriverTables

Q: dict = {}
SQL: dict[str, str] = {}
#: The present time of all queries, as seconds.
NOW = 883612800.0


def query(sql: str | None = None):
    def put(f):
        Q[f.__name__] = lambda spark, sf_dir: f(DriverTables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


_TASKS = f"""tk as (select o_orderkey as id, 'job' || o_orderkey % 3 as job_type, case o_orderstatus when 'P' then 'pending' when 'O' then 'running' else case when o_orderkey % 2 = 0 then 'done' else 'failed' end end as status,
    cast(substr(o_orderpriority, 1, 1) as integer) as priority, case when o_orderkey % 4 <> 1 then o_custkey end as api_key_id, epoch(o_orderdate) as created_at, epoch(o_orderdate) as started_at,
    case when o_orderkey % 3 = 0 then epoch(o_orderdate) + 60 * (o_orderkey % 50) end as heartbeat_at, case when o_orderkey % 4 = 0 then epoch(o_orderdate) + 1000 * (o_orderkey % 100000) end as run_after,
    cast(o_orderkey % 3 as integer) as max_retries, 1800 as retry_delay, case when o_orderkey % 5 < 2 then 'HTTP 503 Service Unavailable' when o_orderkey % 5 = 2 then 'Quota exceeded' else 'bad value' end as error_msg from orders),
    now as (select {NOW} as t)"""


def tasks(t: DriverTables) -> DataFrame:
    k = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp").cast("double")
    done = F.when(k % 2 == 0, "done").otherwise("failed")
    return t.raw("orders").select(
        k.alias("id"),
        F.concat(F.lit("job"), k % 3).alias("job_type"),
        F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "O", "running").otherwise(done).alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(k % 4 != 1, F.col("o_custkey")).alias("api_key_id"),
        at.alias("created_at"),
        at.alias("started_at"),
        F.when(k % 3 == 0, at + 60 * (k % 50)).alias("heartbeat_at"),
        F.when(k % 4 == 0, at + 1000 * (k % 100000)).alias("run_after"),
        (k % 3).cast("int").alias("max_retries"),
        F.lit(1800).alias("retry_delay"),
        F.when(k % 5 < 2, "HTTP 503 Service Unavailable").when(k % 5 == 2, "Quota exceeded").otherwise("bad value").alias("error_msg"),
    )


_KEYS = f"""ky as (select c_custkey as id, c_mktsegment as provider, c_name as alias, cast(c_custkey % 7 > 0 as integer) as is_active,
    case when c_custkey % 3 = 0 then {NOW} - c_custkey * 37 % 8000 end as exhausted_at, cast(abs(c_acctbal) as bigint) % 500 as total_calls from customer)"""


def keys(t: DriverTables) -> DataFrame:
    k = F.col("c_custkey")
    return t.raw("customer").select(
        k.alias("id"),
        F.col("c_mktsegment").alias("provider"),
        F.col("c_name").alias("alias"),
        (k % 7 > 0).cast("int").alias("is_active"),
        F.when(k % 3 == 0, NOW - k * 37 % 8000).cast("double").alias("exhausted_at"),
        (F.round(F.abs("c_acctbal")).cast("long") % 500).alias("total_calls"),
    )


def events(t: DriverTables) -> DataFrame:
    return t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"with {_TASKS} select id, priority, created_at from tk, now where status = 'pending' and (run_after is null or run_after <= t) order by priority, created_at, id limit 1")
def next_task(t):
    return K.next_task(tasks(t), NOW).select("id", "priority", "created_at")


@query(f"with {_KEYS} select id, total_calls from ky where provider = 'BUILDING' and is_active = 1 and exhausted_at is null order by total_calls, id limit 1")
def next_key(t):
    return K.next_key(keys(t), "BUILDING").select("id", "total_calls")


@query(f"with {_KEYS} select id, exhausted_at from ky where exhausted_at < {NOW} - 3600")
def restored_keys(t):
    return K.restored_keys(keys(t), NOW).select("id", "exhausted_at")


@query(f"with {_KEYS} select id, cast(greatest(0, ceil((exhausted_at + 3600 - {NOW}) / 60)) as bigint) as minutes_left from ky where exhausted_at is not null")
def cooldown_left(t):
    return K.cooldown_left(keys(t), NOW).select("id", "minutes_left")


@query(f"with {_KEYS} select provider, id, alias, is_active from ky order by provider, id")
def keys_listing(t):
    return keys(t).select("provider", "id", "alias", "is_active").orderBy("provider", "id")


@query(f"with {_TASKS} select id, status, created_at from tk order by created_at desc, id desc limit 50")
def recent_tasks(t):
    return K.recent(tasks(t), 50).select("id", "status", "created_at")


@query(f"with {_TASKS} select status, count(*) as n from (select * from tk order by created_at desc, id desc limit 50) group by 1")
def task_status_counts(t):
    return K.status_counts(tasks(t))


@query(f"with {_TASKS}, {_KEYS} select tk.id, status, alias from tk left join ky on api_key_id = ky.id")
def task_with_key(t):
    k = keys(t).select(F.col("id").alias("key_id"), "alias")
    return tasks(t).join(k, F.col("api_key_id") == F.col("key_id"), "left").select("id", "status", "alias")


@query(f"with {_TASKS} select id, coalesce(heartbeat_at, started_at) as last_seen from tk where status = 'running' and coalesce(heartbeat_at, started_at) < {NOW} - 300")
def stale_tasks(t):
    return K.stale(tasks(t), NOW).select("id", F.coalesce("heartbeat_at", "started_at").alias("last_seen"))


@query(f"with {_TASKS} select id as of_id, job_type, 'pending' as status, priority, max_retries - 1 as max_retries, retry_delay, {NOW} + retry_delay as run_after from tk where status = 'failed' and max_retries > 0 and error_msg <> 'bad value'")
def reschedule(t):
    return K.reschedule(tasks(t).withColumn("retryable", T.error_class(F.col("error_msg"))["retryable"]), NOW)


@query("select k, cast(60 * power(2, k) as bigint) as exponential, 5 * k as linear, least(120, 30 * (k + 1)) as capped from (select distinct p_size % 8 as k from part) order by k".replace("select k,", "select cast(k as bigint) as k,").replace("5 * k", "cast(5 * k as bigint)").replace("least(120, 30 * (k + 1))", "cast(least(120, 30 * (k + 1)) as bigint)"))
def backoff_schedule(t):
    k = t.raw("part").select((F.col("p_size") % 8).cast("long").alias("k")).distinct()
    return k.select("k", *(v.alias(n) for n, v in K.backoff(F.col("k")).items()))


_D = "(heartbeat_at - started_at)"
_AGO = f"({NOW} - started_at)"


@query(f"""with {_TASKS} select id, strftime(make_timestamp(cast(started_at as bigint) * 1000000), '%Y-%m-%d %H:%M:%S') as started,
    coalesce(case when {_D} < 60 then printf('%.1f', {_D}) || 's' else cast(floor({_D} / 60 + 0.5) as bigint) || 'm ' || cast(floor({_D} % 60 + 0.5) as bigint) || 's' end, '—') as took,
    case when {_AGO} < 60 then cast(floor({_AGO} + 0.5) as bigint) || 's ago' when {_AGO} < 3600 then cast(floor({_AGO} / 60 + 0.5) as bigint) || 'm ago' when {_AGO} < 86400 then cast(floor({_AGO} / 3600 + 0.5) as bigint) || 'h ago' else cast(floor({_AGO} / 86400 + 0.5) as bigint) || 'd ago' end as ago from tk""")
def task_durations(t):
    d = K.durations(F.col("started_at"), F.col("heartbeat_at"), NOW)
    started = T.local_time(F.col("started_at")).alias("started")
    return tasks(t).select("id", started, *(v.alias(n) for n, v in d.items()))


@query(f"with {_TASKS} select id, case when status in ('pending', 'running') then 'cancelled' else status end as status, 'cancel' as action from tk union all select id, 'pending', 'retry' from tk where status in ('failed', 'done')")
def task_transitions(t):
    k = tasks(t)
    cancel = k.select("id", K.cancelled(F.col("status")).alias("status"), F.lit("cancel").alias("action"))
    again = K.retried(k.filter("status in ('failed', 'done')"))
    return cancel.unionByName(again.select(F.col("of_id").alias("id"), "status", F.lit("retry").alias("action")))


_STATES = "case event_type when 'purchase' then 'done' when 'error' then 'failed' when 'logout' then 'cancelled' else 'running' end"


@query(f"with e as (select user_id, event_id, ts, event_type, props, {_STATES} as state from events), r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from e) select user_id as task_id, state, case when state in ('done', 'failed', 'cancelled') then cast(epoch_us(ts) as bigint) end as finished_at, case when state in ('done', 'failed', 'cancelled') and event_type = 'error' then props end as error_msg from r where n = 1")
def task_state(t):
    state = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "logout", "cancelled").otherwise("running")
    e = events(t).select(F.col("user_id").alias("task_id"), "event_id", F.unix_micros("ts").alias("ts"), state.alias("state"), F.when(F.col("event_type") == "error", F.col("props")).alias("error"))
    return K.current_state(e)


@query(f"with {_TASKS}, gone as (select id from tk where id in (select s_suppkey from supplier) and status in ('done', 'failed', 'cancelled')) select 'task' as kind, id from tk where id not in (select id from gone) union all select 'log', event_id from events where user_id not in (select id from gone)")
def cascade_delete(t):
    logs = t.raw("events").select("event_id", F.col("user_id").alias("task_id"))
    left, entries = M.cascade_delete(tasks(t), logs, t.raw("supplier").select(F.col("s_suppkey").alias("id")))
    return left.select(F.lit("task").alias("kind"), "id").unionByName(entries.select(F.lit("log").alias("kind"), F.col("event_id").alias("id")))


@query("select user_id as key_id, count(*) as total_calls, count(*) filter (where event_type = 'error') as total_errors from events group by 1")
def key_counters(t):
    return K.key_counters(t.raw("events").select(F.col("user_id").alias("key_id"), (F.col("event_type") == "error").alias("is_error")))


@query("select event_id, user_id, (row_number() over (partition by user_id order by event_id) - 1) % 3 as slot from events")
def round_robin(t):
    return K.round_robin(t.raw("events").select("event_id", "user_id"), "event_id", 3, "user_id")


@query(f"with {_TASKS} select distinct error_msg, error_msg <> 'bad value' as retryable, error_msg = 'Quota exceeded' as rate_limit, case error_msg when 'Quota exceeded' then 'quota' when 'bad value' then 'other' else 'server' end as kind from tk")
def error_class(t):
    return tasks(t).select("error_msg").distinct().select("error_msg", *(v.alias(n) for n, v in T.error_class(F.col("error_msg")).items()))


@query("select key, coalesce(value, 'none') as value from (values ('1'), ('no such key')) k(key) left join (select cast(user_id as varchar) as u, max_by(event_type, event_id) as value from events group by 1) s on key = u")
def settings_lookup(t):
    table = settings(t)
    wanted = t.spark.createDataFrame([("1",), ("no such key",)], "key string")
    return wanted.join(table, "key", "left").select("key", F.coalesce("value", F.lit("none")).alias("value"))


def settings(t: DriverTables) -> DataFrame:
    rows = t.raw("events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"), "event_id")
    return M.last_write(rows, ["key"], "value", "event_id")


@query("select cast(user_id as varchar) as key, max_by(event_type, event_id) as value from events group by 1")
def settings_merge(t):
    return settings(t)


@query("with s as (select cast(user_id as varchar) as key, max_by(event_type, event_id) as value from events group by 1) select * from s union all select cast(c_custkey as varchar), c_mktsegment from customer where cast(c_custkey as varchar) not in (select key from s)")
def settings_defaults(t):
    defaults = t.raw("customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_mktsegment").alias("value"))
    return M.with_defaults(settings(t), defaults, ["key"])


@query("select user_id, event_id, event_type from events where user_id = 7 and event_id > 100 order by event_id")
def log_tail(t):
    logs = t.raw("events").select(F.col("event_id").alias("id"), F.col("user_id").alias("task_id"), "event_type")
    return K.log_tail(logs, 7, 100).select(F.col("task_id").alias("user_id"), F.col("id").alias("event_id"), "event_type")


def _gaps_sql(of: str) -> str:
    return f"with g as (select event_id, {of}, (epoch_us(ts) - epoch_us(lag(ts) over (partition by {of} order by ts, event_id))) / 1e6 as gap_s from events)"


def gaps(t: DriverTables, of: str) -> DataFrame:
    return K.gaps(events(t).select("event_id", of, "ts"), "ts", of, "event_id")


@query(f"{_gaps_sql('user_id')} select event_id, user_id as task_id, round(gap_s, 3) as gap_s from g where gap_s > 300")
def silent_gaps(t):
    """Tasks of which nothing was heard for five minutes."""
    return gaps(t, "user_id").filter("gap_s > 300").select("event_id", F.col("user_id").alias("task_id"), F.round("gap_s", 3).alias("gap_s"))


@query(f"{_gaps_sql('event_type')} select event_id, event_type as key_id, round(gap_s, 3) as gap_s, round(4 - gap_s, 3) as wait_s from g where gap_s < 4")
def throttle_check(t):
    """Calls that came sooner after the same key's last one than 15 a minute allow, and how long they had to wait."""
    wait = F.round(4 - F.col("gap_s"), 3).alias("wait_s")
    return gaps(t, "event_type").filter("gap_s < 4").select("event_id", F.col("event_type").alias("key_id"), F.round("gap_s", 3).alias("gap_s"), wait)


@query("select user_id as key_id, cast(ts as date) as day, count(*) as used, greatest(0, 1500 - count(*)) as remaining, count(*) >= 1500 as exhausted from events group by 1, 2")
def quota_status(t):
    return K.quota(events(t).select(F.col("user_id").alias("key_id"), F.to_date("ts").alias("day")))


_POOL = "q as (select user_id, cast(ts as date) as day, count(*) >= 3 as exhausted from events group by 1, 2)"


@query(f"with {_POOL} select day, count(*) as keys, count(*) filter (where not exhausted) as available, count(*) filter (where not exhausted) = 0 as all_exhausted from q group by 1")
def pool_exhausted(t):
    calls = events(t).select(F.col("user_id").alias("key_id"), F.to_date("ts").alias("day"))
    return K.pool_state(K.quota(calls, per_day=3))


_WHAT = "case event_type when 'view' then 'call' when 'click' then 'error' when 'error' then 'exhausted' when 'purchase' then case when value > 50 then 'off' else 'on' end else case when event_id % 3 = 0 then 'delete' else 'cleared' end end"


@query(f"""with e as (select user_id, event_id, epoch_us(ts) as ts, {_WHAT} as what from events), m as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n,
    row_number() over (partition by user_id, what in ('exhausted', 'cleared') order by ts desc, event_id desc) as x, row_number() over (partition by user_id, what in ('on', 'off') order by ts desc, event_id desc) as o from e)
    select user_id as key_id, count(*) filter (where what = 'call') as total_calls, count(*) filter (where what in ('error', 'exhausted')) as total_errors,
        max(case when x = 1 and what = 'exhausted' then ts end) as exhausted_at, cast(coalesce(min(case when o = 1 and what in ('on', 'off') then case what when 'on' then 1 else 0 end end), 1) as integer) as is_active
    from m group by 1 having max(case when n = 1 and what = 'delete' then 1 else 0 end) = 0""")
def key_flags(t):
    kind, odd = F.col("event_type"), F.col("event_id") % 3 == 0
    what = F.when(kind == "view", "call").when(kind == "click", "error").when(kind == "error", "exhausted")
    what = what.when(kind == "purchase", F.when(F.col("value") > 50, "off").otherwise("on")).otherwise(F.when(odd, "delete").otherwise("cleared"))
    return K.key_flags(events(t).select(F.col("user_id").alias("key_id"), F.unix_micros("ts").alias("ts"), "event_id", what.alias("what")))


_ALLOWED = "3, 9,12 , 40,1000"


@query(f"with {_KEYS} select id, provider from ky where is_active = 1 and exhausted_at is null and id in (select cast(trim(x) as bigint) from (select unnest(string_split('{_ALLOWED}', ',')) as x))")
def allowed_keys(t):
    allowed = t.spark.range(1).select(T.id_list(F.lit(_ALLOWED)).alias("ids")).first().ids
    return K.usable_keys(keys(t), allowed=allowed).select("id", "provider")


@query(f"with {_KEYS} select id, provider, cast(null as double) as exhausted_at from ky")
def model_change(t):
    return K.after_model_change(keys(t), "old model", "new model").select("id", "provider", "exhausted_at")


@query(f"with {_TASKS} select id, priority, created_at from tk, now where status = 'pending' and (run_after is null or run_after <= t) order by priority, created_at, id limit (select greatest(0, 8000 - count(*)) from tk where status = 'running')")
def startable_tasks(t):
    return K.startable(tasks(t), NOW, 8000).select("id", "priority", "created_at")


@query(f"""with {_TASKS}, j as (select job_type, count(*) filter (where status in ('done', 'failed')) as done, count(*) as total, {NOW} - min(created_at) as elapsed from tk group by 1)
    select job_type, done / total * 100 as percent, done / elapsed as rate, case when done > 0 and done < total then cast(floor((total - done) / (done / elapsed)) as bigint) end as left_s from j""")
def job_progress(t):
    ended = F.count_if(F.col("status").isin("done", "failed"))
    jobs = tasks(t).groupBy("job_type").agg(ended.alias("done"), F.count("*").alias("total"), (F.lit(NOW) - F.min("created_at")).alias("elapsed"))
    return jobs.select("job_type", *(v.alias(k) for k, v in K.progress(F.col("done"), F.col("total"), F.col("elapsed")).items()))


@query("select cast(conv_id as varchar) as sc_id, 1 as n_sentences, length(text) as prompt_chars, length(role) as output_chars, 'STOP' as finish_reason, cast(0.5 as double) as elapsed_s, length(text) // 4 as prompt_tokens, length(role) // 4 as candidates_tokens, length(text) // 4 + length(role) // 4 as total_tokens from conversations")
def usage_rows(t):
    c = t.raw("conversations")
    made = c.select(F.col("conv_id").cast("string").alias("sc_id"), F.lit(1).alias("n_sentences"), F.col("text").alias("prompt"), F.col("role").alias("raw"), F.lit(0.51).alias("seconds"), F.lit("STOP").alias("finish_reason"))
    return K.usage_rows(made)


# --- merges ---


@query("select user_id, max_by(event_type, event_id) as value from events group by 1")
def merge_checkpoints(t):
    return M.last_write(t.raw("events").select("user_id", "event_id", F.col("event_type").alias("value")), ["user_id"], "value", "event_id")


@query("select c_custkey from customer where c_custkey not in (select user_id from events)")
def remaining_headings(t):
    return M.remaining(t.raw("customer").select("c_custkey"), t.raw("events").select(F.col("user_id").alias("c_custkey")), ["c_custkey"])


_MAP = "m as (select case when event_id % 11 = 0 then 'x' || event_id when event_id % 7 = 0 then '-' || event_id else cast(event_id as varchar) end as para, case when event_id % 5 = 0 then null else cast(user_id as varchar) end as sc_id from events)"


def mapping(t: DriverTables) -> DataFrame:
    e = F.col("event_id")
    para = F.when(e % 11 == 0, F.concat(F.lit("x"), e)).when(e % 7 == 0, F.concat(F.lit("-"), e)).otherwise(e.cast("string"))
    return t.raw("events").select(para.alias("para"), F.when(e % 5 != 0, F.col("user_id").cast("string")).alias("sc_id"))


@query(f"with {_MAP} select para, case when sc_id in (select cast(s_suppkey as varchar) from supplier) then sc_id end as sc_id from m where regexp_matches(para, '^-*[0-9]+$')")
def validate_mapping(t):
    return valid_mapping(t)


def valid_mapping(t: DriverTables) -> DataFrame:
    valid = t.raw("supplier").select(F.col("s_suppkey").cast("string").alias("sc_id"))
    return M.validate_mapping(mapping(t), valid, "para", "sc_id").select("para", "sc_id")


@query(f"""with {_MAP}, v as (select para, case when sc_id in (select cast(s_suppkey as varchar) from supplier) then sc_id end as sc_id from m where regexp_matches(para, '^-*[0-9]+$')),
    a as (select cast(p_partkey as varchar) as para, (row_number() over (order by p_partkey) - 1) // 150 as batch from part) select para, batch, sc_id from a full join v using (para)""")
def filled_mapping(t):
    return M.with_omitted(valid_mapping(t), asked_parts(t), ["para"], "sc_id", ["batch"])


def asked_parts(t: DriverTables) -> DataFrame:
    return P.fixed_batches(t.raw("part").select("p_partkey"), "p_partkey", 150).select(F.col("p_partkey").cast("string").alias("para"), "batch")


@query(f"""with {_MAP}, v as (select para, case when sc_id in (select cast(s_suppkey as varchar) from supplier) then sc_id end as sc_id from m where regexp_matches(para, '^-*[0-9]+$')),
    a as (select cast(p_partkey as varchar) as para, (row_number() over (order by p_partkey) - 1) // 150 as batch from part) select batch, count(*) as asked, count(sc_id) as mapped from a full join v using (para) group by 1""")
def mapping_chunks(t):
    return M.mapped_counts(M.with_omitted(valid_mapping(t), asked_parts(t), ["para"], "sc_id", ["batch"]), ["batch"], "sc_id")


@query("""with u as (select user_id as p_partkey, max_by(event_type, event_id) as v from events group by 1)
    select p_partkey, coalesce(u.v, p_name) as p_name, u.v is not null as updated from part left join u using (p_partkey)""")
def apply_mapping(t):
    updates = t.raw("events").select(F.col("user_id").alias("p_partkey"), F.col("event_type").alias("p_name"), F.col("event_id").alias("seq"))
    return M.apply_updates(t.raw("part").select("p_partkey", "p_name"), updates, ["p_partkey"], "p_name", "seq")


@query("""with s as (select conv_id, turn, i - 1 as line, ls[i] as x from (select *, string_split(text, chr(10)) as ls from conversations where role = 'assistant') c, unnest(range(1, len(c.ls) + 1)) as t(i)),
    c as (select conv_id, turn, text, role from conversations) select conv_id, turn, case when role = 'assistant' and turn % 4 = 1 then reverse(text) when turn % 4 = 3 then 'set' || conv_id else text end as text, (role = 'assistant' and turn % 4 = 1) or turn % 4 = 3 as updated from c""")
def apply_translations(t):
    c = t.raw("conversations")
    new = F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), F.reverse("text")).when(F.col("turn") % 4 == 3, F.concat(F.lit("set"), "conv_id")).otherwise(" \t")
    updates = c.select("conv_id", "turn", new.alias("text"), F.lit(1).alias("seq"))
    return M.apply_updates(c.select("conv_id", "turn", "text"), updates, ["conv_id", "turn"], "text", "seq")


@query("select s_suppkey, s_name, c_custkey, c_name, s_nationkey as nationkey from supplier join customer on s_nationkey = c_nationkey")
def mapping_candidates(t):
    s = t.raw("supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("nationkey"))
    c = t.raw("customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"))
    return M.mapping_candidates(s, c, "nationkey")


_TOKENS = "unnest(list_distinct([lower(x) for x in regexp_split_to_array(text, '[\\s,;.‘’\"''()\\[\\]]+') if length(x) > 2 and length(x) < 40]))"


@query(f"with f as (select pali, english, min(seq) as seq from (select {_TOKENS} as pali, role as english, conv_id * 1000 + turn as seq from conversations) group by 1, 2), g as (select distinct {_TOKENS} as pali, 'user' as english from benchmark) select pali, english, seq from f anti join g using (pali, english)")
def glossary_upsert(t):
    terms = lambda table, *more: t.raw(table).select(F.explode(T.tokens(F.col("text"))).alias("pali"), *more)
    new = terms("conversations", F.col("role").alias("english"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    return M.insert_if_absent(terms("benchmark", F.lit("user").alias("english")).distinct(), new, ["pali", "english"], "seq")


# --- model output; a stub stands for the model ---


def answers(t: DriverTables) -> DataFrame:
    """Answers of a made-up model: whole, fenced, cut off, with a brace in a string, or none."""
    i = F.col("item_id")
    one = F.format_string('{"pali": "p%d", "english": "e}%d", "domain": "d"}', i, i)
    two = F.format_string('{"pali": "q%d", "english": "f%d"}', i, i)
    whole = F.concat(F.lit("["), one, F.lit(", "), two, F.lit("]"))
    raw = (
        F.when(i % 5 == 0, whole)
        .when(i % 5 == 1, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
        .when(i % 5 == 2, F.concat(F.lit("["), one, F.lit(", "), F.substring(two, 1, 12)))
        .when(i % 5 == 3, F.concat(F.lit("Here it is: "), whole, F.lit(" done")))
        .otherwise("no terms here")
    )
    return t.raw("benchmark").select("item_id", raw.alias("raw"))


@query("""select item_id, x as pali, y as english from (select item_id, unnest(case when item_id % 5 = 4 then [] when item_id % 5 = 2 then ['p' || item_id] else ['p' || item_id, 'q' || item_id] end) as x,
    unnest(case when item_id % 5 = 4 then [] when item_id % 5 = 2 then ['e}' || item_id] else ['e}' || item_id, 'f' || item_id] end) as y from benchmark)""")
def json_salvage(t):
    return answers(t).select("item_id", F.inline(parsing.json_salvage("raw"))).select("item_id", "pali", "english")


@query("select item_id, item_id as para_id, cast(1 as bigint) as line_id, 't' || item_id as english_translation, cast(case when item_id % 3 = 0 then 1 else 0 end as integer) as terms from benchmark")
def response_parse(t):
    i = F.col("item_id")
    head = F.format_string('{"translations": [{"para_id": %d, "line_id": 1, "english_translation": "t%d"}', i, i)
    tail = F.when(i % 3 == 0, '], "glossary": [{"pali": "a", "english": "b"}]}').when(i % 3 == 1, ', {"para_id": 2, "li').otherwise("]")
    parsed = t.raw("benchmark").select("item_id", parsing.response_parse(F.concat(head, tail)).alias("r"))
    return parsed.select("item_id", F.inline("r.translations"), F.size("r.glossary").alias("terms")).select("item_id", "para_id", "line_id", "english_translation", "terms")


@query("select item_id, cast(item_id as varchar) as key, case when item_id % 2 = 0 then 's}' || item_id end as value from benchmark where item_id % 4 <> 3")
def mapping_parse(t):
    i = F.col("item_id")
    value = F.when(i % 2 == 0, F.format_string('"s}%d"', i)).otherwise("null")
    body = F.concat(F.format_string('{"%d": ', i), value, F.lit("}"))
    raw = F.when(i % 4 == 3, "none").when(i % 4 == 0, F.concat(F.lit("```\n"), body, F.lit("\n```"))).when(i % 4 == 1, F.concat(body, F.lit(' and { "1": '))).otherwise(body)
    return t.raw("benchmark").select("item_id", F.explode(parsing.mapping_parse(raw)).alias("key", "value"))


@query("select p_partkey, cast(p_partkey % 4 as bigint) as kind, case p_partkey % 4 when 0 then 'a' || p_partkey || ': b | [Note: n]' when 1 then 'plain' when 2 then '(none)' else '[{bad' end as gloss from part")
def gloss_format(t):
    k = F.col("p_partkey")
    c = F.when(k % 4 == 0, F.format_string('[{"pali": "a%d", "meaning": "b"}, 3, {"note": "n"}, {}]', k)).when(k % 4 == 1, " plain ").when(k % 4 == 2, "").otherwise("[{bad")
    return t.raw("part").select("p_partkey", (k % 4).cast("long").alias("kind"), T.gloss_format(c).alias("gloss"))


def _guesses():
    """A made-up model: heading n has the reference r(n mod 100); it leaves out every seventh."""

    def answer(prompt: str) -> str:
        ids = [int(line.split()[0]) for line in prompt.split("Headings:\n")[1].split("\n\n")[0].split("\n")]
        return "```json\n{" + ", ".join(f'"{i}": "r{i % 100}"' for i in ids if i % 7) + "}\n```"

    return answer


@query("""with h as (select cast(p_size % 30 as bigint) as book_id, p_partkey as para_id, p_size % 12 as level from part)
    select book_id, para_id, case when level < 10 and para_id % 7 <> 0 and (book_id, para_id % 100) in (select (cast(s_nationkey as bigint), s_suppkey) from supplier) then 'r' || para_id % 100 end as sc_id from h""")
def heading_mapping(t):
    book = (F.col("p_size") % 30).cast("long").alias("book_id")
    heads = t.raw("part").select(book, F.col("p_partkey").alias("para_id"), (F.col("p_size") % 12).alias("level"), F.col("p_name").alias("title"), F.lit(None).cast("string").alias("sc_id"))
    refs = t.raw("supplier").select(F.col("s_nationkey").cast("long").alias("book_id"), F.concat(F.lit("r"), "s_suppkey").alias("sc_id"), F.col("s_name").alias("sutta_name"))
    mapped, _ = map_headings(heads, refs, _guesses, scratch(t.spark, "mapping"), heads.select("book_id").distinct())
    return mapped.select("book_id", "para_id", "sc_id")


_MYANMAR = {"ဓမ္မ": "dhamma", "သင်္ဃ": "saṅgha", "ဥပေက္ခာ": "upekkhā", "လောက": "loka", "သံယောဇန၊ အနိစ္စ": "saṃyojana, anicca"}


@query(f"select p_partkey, case p_partkey % 6 {' '.join(f"when {i} then '{v} ' || p_size" for i, v in enumerate(_MYANMAR.values()))} else p_name || 'ïŏ' end as roman from part")
def translit(t):
    text = F.concat("p_name", F.lit("ïŏ"))
    for i, word in enumerate(_MYANMAR):
        text = F.when(F.col("p_partkey") % 6 == i, F.concat(F.lit(word + " "), "p_size")).otherwise(text)
    return t.raw("part").select("p_partkey", to_roman(text).alias("roman"))


@query(f"""with a as (select item_id, 'p' || item_id as pali, 'e}}' || item_id as english from benchmark where item_id % 5 <> 4 union all select item_id, 'q' || item_id, 'f' || item_id from benchmark where item_id % 5 not in (2, 4)),
    h as (select 'p' || n_nationkey as pali, 'e}}' || n_nationkey as english from nation), w as (select item_id, {_TOKENS} as word from benchmark),
    k as (select item_id, string_agg(word, ', ' order by word) as known from w where word in (select lower(n_name) from nation union select lower(r_name) from region union select 'the') group by 1)
    select a.pali, a.english, a.item_id, coalesce(known, '') as known from a anti join h using (pali, english) left join k on a.item_id = k.item_id""")
def glossary_build(t):
    """Each text's known terms go with it to the model; of its answers those are kept that the glossary lacks."""
    heads = t.raw("nation").select(F.lower("n_name").alias("pali")).union(t.raw("region").select(F.lower("r_name"))).union(t.spark.range(1).select(F.lit("the"))).distinct()
    words = t.raw("benchmark").select("item_id", T.tokens(F.col("text")).alias("words"))
    known = C.overlap(words, "words", heads, ["item_id"]).groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("pali")), ", ").alias("known"))
    have = t.raw("nation").select(F.format_string("p%d", "n_nationkey").alias("pali"), F.format_string("e}%d", "n_nationkey").alias("english"))
    found = answers(t).select("item_id", F.inline(parsing.json_salvage("raw"))).select("pali", "english", "item_id")
    new = M.insert_if_absent(have, found, ["pali", "english"], "item_id")
    return new.join(known, "item_id", "left").select("pali", "english", "item_id", F.coalesce("known", F.lit("")).alias("known"))
