"""Registered queries: streams over the tables' files, drained into the shared folder, against batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import saved_groups
from ..operators.graph import cut_lineage, gone_at_end, own_path
from ..streaming import streams
from . import domain as d
from .domain import SQL
from .queries_core import _evening_facts


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files."""
    path = f"{sf_dir}/events.parquet*"
    rows = streams.read_stream(spark, path, spark.read.parquet(path).schema)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(rows: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Run a stream over all that is there, and read what it wrote with ``spark`` (the stream's own session if none)."""
    spark = spark or rows.sparkSession
    out, state = own_path(spark, name), own_path(spark, f"{name}-state")
    query = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", state).start(out)
    while query.isActive:
        query.awaitTermination(2)
    if query.exception():
        raise query.exception()
    gone_at_end(spark, out)
    gone_at_end(spark, state)
    return spark.read.schema(rows.schema).parquet(out)


def q100_stream_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select(F.concat_ws("|", "user_id", "event_type").alias("dedupe_key"), F.col("ts").alias("scraped_at"))
    return _drained(streams.stream_stage(e, late="60 days"), "staged").select("dedupe_key")


Q100 = "select distinct user_id || '|' || event_type as dedupe_key from events"


def q101_stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests decided in order of time, up to the watermark: caps for the month and for each run."""
    e = _events(streams.stateful_session(spark), sf_dir)
    asked = e.select(F.date_format("ts", "yyyy-MM").alias("month"), F.col("ts").alias("at"), (F.col("user_id") % 7).cast("string").alias("run_id"), (F.round(F.col("value") * 100)).cast("long").alias("amount"))
    rows = _drained(streams.stream_ledger(asked, _MONTH_CAP, _RUN_CAP), "ledger", spark)
    return rows.select("month", F.unix_micros("at").alias("at"), "run_id", "amount", "ok", "month_sum")


_MONTH_CAP, _RUN_CAP = 400_000, 90_000
# whole slots that end before the last time less the hour that rows may be late
_over = lambda slot: f"(epoch_ms(t) // {slot}000 + 1) * {slot}000 < (select epoch_ms(max(ts)) - 3600000 from events)"

Q101 = f"""with recursive a as (select strftime(ts, '%Y-%m') as month, ts as t, (user_id % 7)::varchar as run_id, round(value * 100)::bigint as amount from events),
o as (select *, row_number() over (partition by month order by t, run_id, amount) as n from a where {_over(3600)}),
play as (select month, 0::bigint as n, null::timestamp as t, null::varchar as run_id, 0::bigint as amount, false as ok, 0::bigint as month_sum, list_value(0,0,0,0,0,0,0)::bigint[] as runs from (select distinct month from o)
union all select month, n, t, run_id, amount, ok, month_sum + case when ok then amount else 0 end,
  list_transform(runs, lambda x, i: case when ok and i = run_id::int + 1 then x + amount else x end)
from (select o.month, o.n, o.t, o.run_id, o.amount, p.month_sum + o.amount <= {_MONTH_CAP} and p.runs[o.run_id::int + 1] + o.amount <= {_RUN_CAP} as ok, p.month_sum, p.runs from play p join o on o.month = p.month and o.n = p.n + 1))
select month, epoch_us(t) as at, run_id, amount, ok, month_sum from play where n > 0"""


def q102_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as an opened page: what its kind was when the page was last read, and how long ago."""
    e = _events(streams.stateful_session(spark), sf_dir)
    pages = e.select(F.concat(F.lit("u"), (F.col("user_id") % 200).cast("string")).alias("url"), F.lit("list").alias("role"), F.col("event_type").alias("text_hash"), F.col("ts").alias("at"))
    rows = _drained(streams.stream_changes(pages, days=1), "readings", spark)
    return rows.select("url", F.unix_micros("at").alias("at"), "state")


Q102 = f"""with recursive a as (select user_id % 200 as u, ts as t, event_type as h from events), o as (select *, row_number() over (partition by u order by t, h) as n from a where {_over(86400)}),
play as (select u, n, t, h as last_hash, t as last_at, 'new' as state from o where n = 1
union all select o.u, o.n, o.t, o.h, case when o.h = p.last_hash and epoch_us(o.t) - epoch_us(p.last_at) <= 86400000000 then p.last_at else o.t end,
  case when o.h <> p.last_hash then 'changed' when epoch_us(o.t) - epoch_us(p.last_at) > 86400000000 then 'expired' else 'unchanged' end from play p join o on o.u = p.u and o.n = p.n + 1)
select 'u' || u as url, epoch_us(t) as at, state from play"""


def q103_stream_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the answers that came in time."""
    e = _events(spark, sf_dir)
    asked = e.where("event_id % 2 = 0").select(F.col("user_id").alias("batch_id"), F.col("event_id").alias("custom_id"), F.col("ts").alias("sent_at"), F.col("value").alias("estimate"))
    told = _events(spark, sf_dir).where("event_id % 2 = 1").select(F.col("user_id").alias("batch"), (F.col("event_id") - 1).alias("custom"), F.col("ts").alias("answered_at"), F.col("event_type").alias("result"))
    return _drained(streams.stream_pending(asked, told, days=10), "answers").where("result is not null").select("batch_id", "custom_id", "result")


Q103 = "select a.user_id as batch_id, a.event_id as custom_id, b.event_type as result from events a join events b on a.event_id % 2 = 0 and b.event_id = a.event_id + 1 and a.user_id = b.user_id and b.ts >= a.ts and b.ts <= a.ts + interval 10 days"


def q104_stream_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moments at which nothing of a source is open: an even event asks, an odd one answers."""
    e = _events(streams.stateful_session(spark), sf_dir)
    changes = e.select((F.col("user_id") % 100).cast("string").alias("source_id"), F.col("ts").alias("at"), F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1).alias("delta"))
    return _drained(streams.stream_save_when_answered(changes), "answered", spark).select("source_id", F.unix_micros("at").alias("at"))


Q104 = f"""with a as (select user_id % 100 as s, ts as t, case when event_id % 2 = 0 then 1 else -1 end as delta from events),
b as (select *, sum(delta) over (partition by s order by t, delta desc rows unbounded preceding) as n from a where {_over(86400)})
select s::varchar as source_id, epoch_us(t) as at from b where n = 0"""


def q105_stream_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of progress that are over: a gap of two hours ends one."""
    e = _events(spark, sf_dir).select((F.col("user_id") % 50).alias("job"), F.col("ts").alias("at"))
    rows = _drained(streams.stream_stalls(e, minutes=120, late="10 minutes"), "spells")
    return rows.select("job", F.unix_seconds("started").alias("started"), F.unix_seconds("ended").alias("ended"), "n")


Q105 = """with e as (select user_id % 50 as job, ts from events), f as (select *, coalesce(ts - lag(ts) over w >= interval 120 minutes, true) as fresh from e window w as (partition by job order by ts)),
g as (select *, sum(fresh::int) over (partition by job order by ts rows unbounded preceding) as spell from f), s as (select job, min(ts) as a, max(ts) + interval 120 minutes as b, count(*) as n from g group by job, spell)
select job, floor(epoch(a))::bigint as started, floor(epoch(b))::bigint as ended, n from s where b <= (select max(ts) from events) - interval 10 minutes"""

def q117_kept_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups kept through two batches of changes: some listings move to their source's evening, then some are taken out.

    The first batch is brought in by a call, the second by a stream of its changes."""
    lists = d.listings(spark, sf_dir).drop("original_title", "timezone", "starts_at", "theater_id", "program_id", "image_url", "ignored", "generic")
    lists = cut_lineage(lists, "listings")
    own, source = F.col("performance_id").cast("string"), F.concat(F.lit("s"), F.col("source_id").cast("string"))
    moves, gone = F.col("work_id") % 17 == 0, F.col("source_id") % 13 == 0
    now = F.when(moves, source).otherwise(own)
    rows = lambda listings, ek: _evening_facts(saved_groups.deal(listings.withColumn("ek", ek)).withColumn("image_url", F.lit(None).cast("string")))
    path, changes, state = own_path(spark, "evening-groups"), own_path(spark, "evening-changes"), own_path(spark, "evening-state")
    for p in (path, changes, state):
        gone_at_end(spark, p)
    saved_groups.save_groups(rows(lists, own), path, dealt=True)
    pairs = lists.where(moves).select(F.explode(F.array(own, source)).alias("ek"))
    saved_groups.refresh_saved(path, rows(lists, now), pairs, dealt=True)
    lists.where(gone).select(now.alias("old_key"), F.lit(None).cast("string").alias("new_key")).distinct().write.parquet(changes)
    stream = streams.read_stream(spark, changes, "old_key string, new_key string", files_per_trigger=64)
    query = streams.stream_saved_groups(stream, path, lambda: rows(lists.where(~gone), now), dealt=True).option("checkpointLocation", state).trigger(availableNow=True).start()
    while query.isActive:
        query.awaitTermination(2)
    if query.exception():
        raise query.exception()
    several = F.col("n_rows") > 1
    return saved_groups.saved_groups(spark, path).select("ek", "n_rows", F.when(several, F.array_join(F.array_sort("performance_ids"), ",")).alias("ids"))


Q117 = f"""with {SQL}, v as (select id, performance_id::varchar as k0, case when work_id % 17 = 0 then 's' || source_id else performance_id::varchar end as k1, source_id % 13 = 0 as gone from listings),
g as (select k0 as ek from v group by 1 having count(*) > 1 union select k1 from v group by 1 having count(*) > 1),
n as (select k1 as ek, count(*) as n, string_agg(id, ',' order by id) as ids from v where not gone group by 1)
select ek, case when n > 1 then n else 1 end as n_rows, case when n > 1 then ids end as ids from g left join n using (ek)"""

QUERIES = {n: f for n, f in sorted(globals().items()) if n[0] == "q" and n[1:4].isdigit()}
ORACLE = {n: globals()["Q" + n[1:4]] for n in QUERIES}
