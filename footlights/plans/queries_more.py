"""Registered queries: scheduling, readings, pages, ledger, text and address functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import countries, money, text, times, urls
from ..operators import checks, credits, duplicates, ledger, pages, readings, schedule, serve
from ..sources import tables
from ..streaming.streams import stalls
from . import domain as d
from .domain import AS_OF, SQL, TODAY, table

_DAY = TODAY.isoformat()


def q13_deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.deal(d.sources(spark, sf_dir), 20).select("id", "priority", "shard")


Q13 = f"with {SQL} select id, priority, ((row_number() over (order by coalesce(priority, 9), id) - 1) % 20)::int as shard from sources"


def q14_hash_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.hash_shard(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), 20)


Q14 = "select c_custkey as id, (('0x' || md5(c_custkey::varchar))::uhugeint % 20)::int as shard from customer"


def q15_due_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderdate").alias("last_collected_at"))
    c = table(spark, sf_dir, "customer").join(last, F.col("c_custkey") == F.col("k"), "left")
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_nationkey") % 4).alias("priority"), F.when(F.col("c_acctbal") < 0, "off").otherwise("ok").alias("status"), "last_collected_at", (F.col("last_collected_at") + F.expr("interval 30 days")).alias("next_check_at"))
    return schedule.due_queue(rows, AS_OF, limit=500).select("id", "name", "priority", F.date_format("last_collected_at", "yyyy-MM-dd").alias("last_collected"))


Q15 = f"""with l as (select o_custkey as k, max(o_orderdate) as last from orders group by 1)
select c_custkey as id, c_name as name, c_nationkey % 4 as priority, strftime(last, '%Y-%m-%d') as last_collected from customer left join l on k = c_custkey
where c_acctbal >= 0 and (last is null or last + interval 30 days <= timestamp '{_DAY}') order by priority, last nulls first, name, id limit 500"""


def q16_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 4).alias("tier"), F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("country"))
    return schedule.stratified_sample(c, 40, {0: 0.4, 1: 0.3, 2: 0.2, 3: 0.1})


Q16 = """with r as (select c_custkey as id, c_nationkey % 4 as tier, case when c_nationkey <> 3 then c_nationkey end as country, md5(c_custkey::varchar) as h from customer),
a as (select * from r qualify row_number() over (partition by tier, country order by h, id) <= 2),
b as (select *, row_number() over (partition by tier order by h, id) as n from a) select id, tier, country from b where n <= case tier when 0 then 16 when 1 then 12 when 2 then 8 else 4 end order by tier, n limit 40"""


def q17_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of all events, a day's being one sum."""
    r = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("month"), F.col("event_id").alias("seq"), (F.col("user_id") % 5).alias("run_id"), F.round(F.col("value") * 100).cast("long").alias("amount"))
    return ledger.spend_reserve(r, 60_000, 15_000).select("month", "seq", "run_id", "amount", "ok", "why", "month_sum", "run_sum")


Q17 = """with recursive r as (select strftime(ts, '%Y-%m-%d') as month, event_id as seq, user_id % 5 as run_id, round(value * 100)::bigint as amount from events),
n as (select *, row_number() over (partition by month order by seq) as k from r),
f as (select month, 0::bigint as k, null::bigint as seq, null::bigint as run_id, null::bigint as amount, null::boolean as ok, null::varchar as why, 0::bigint as m, 0::bigint as r0, 0::bigint as r1, 0::bigint as r2, 0::bigint as r3, 0::bigint as r4, 0::bigint as run_sum from (select distinct month from n)
union all select n.month, n.k, n.seq, n.run_id, n.amount, x.ok, case when x.over_m then 'month' when x.over_r then 'run' end, f.m + x.a, f.r0 + case when n.run_id = 0 then x.a else 0 end, f.r1 + case when n.run_id = 1 then x.a else 0 end, f.r2 + case when n.run_id = 2 then x.a else 0 end,
  f.r3 + case when n.run_id = 3 then x.a else 0 end, f.r4 + case when n.run_id = 4 then x.a else 0 end, x.run + x.a
  from f join n on n.month = f.month and n.k = f.k + 1,
  lateral (select case n.run_id when 0 then f.r0 when 1 then f.r1 when 2 then f.r2 when 3 then f.r3 else f.r4 end as run0) y,
  lateral (select y.run0 as run, f.m + n.amount > 60000 as over_m, y.run0 + n.amount > 15000 as over_r, f.m + n.amount <= 60000 and y.run0 + n.amount <= 15000 as ok, case when f.m + n.amount <= 60000 and y.run0 + n.amount <= 15000 then n.amount else 0 end as a) x)
select month, seq, run_id, amount, ok, why, m as month_sum, run_sum from f where k > 0"""


def q111_budget_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments and answers of each user's events: blocks, corrections every three days, and what is given back (-1: not said)."""
    estimate = F.round(F.col("value") * 100).cast("long")
    answered = F.col("event_type").isin("click", "view")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("job"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), estimate.alias("estimate"), F.when(answered, estimate + F.col("event_id") % 700 - 300).alias("actual"))
    return ledger.budget_ledger(e, cap=120_000, block=20_000, flush_seconds=3 * 86_400).withColumns({"seq": F.coalesce("seq", F.lit(-1)), "paid": F.coalesce(F.col("paid").cast("int"), F.lit(-1))})


Q111 = """with recursive e as (select user_id as job, event_id as seq, ts, round(value * 100)::bigint as est, case when event_type in ('click', 'view') then round(value * 100)::bigint + event_id % 700 - 300 end as act from events),
n as (select *, row_number() over (partition by job order by seq) as k from e),
f as (select job, 0::bigint as k, null::bigint as seq, null::boolean as paid, 0::bigint as reserved, 0::bigint as adjusted, 0::bigint as free, 0::bigint as total, false as stopped, 0::bigint as owed, 0::bigint as flushed, null::timestamp as at from (select distinct job from n)
  union all
  select job, k, seq, case when act is null then ok end, case when act is null and ok then need else 0 end, case when flush then new_owed - flushed else 0 end,
    free + case when act is null and ok then need - est else 0 end, total + case when act is null and ok then need else 0 end + case when flush then new_owed - flushed else 0 end, stopped or act is null and not ok,
    new_owed, case when flush then new_owed else flushed end, case when flush then ts else start_at end
  from (select *, not stopped and total + need <= 120000 as ok, act is not null and epoch_us(ts) - epoch_us(start_at) > 3 * 86400 * 1000000::bigint as flush
    from (select n.job, n.k, n.seq, n.ts, n.est, n.act, f.free, f.total, f.stopped, f.flushed, coalesce(f.at, n.ts) as start_at, f.owed + case when n.act is null then 0 else n.act - n.est end as new_owed, case when n.est > f.free then greatest(20000, n.est - f.free) else 0 end as need
      from f join n on n.job = f.job and n.k = f.k + 1)))
select job, seq, coalesce(paid::int, -1) as paid, reserved, adjusted from f where k > 0
union all select job, -1, -1, -free, owed - flushed from (select *, row_number() over (partition by job order by k desc) as last from f) where last = 1"""


def q18_spend_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), F.when(F.col("event_type") == "click", "collect").when(F.col("event_type") == "view", "review").otherwise("other").alias("part"), F.col("value").cast("decimal(12,6)").alias("usd"))
    out = ledger.spend_by_run(e)
    return out.select("run_id", F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"), F.date_format("last_at", "yyyy-MM-dd HH:mm:ss").alias("last_at"), *[F.col(c).cast("double").alias(c) for c in ("collect_usd", "review_usd", "total_usd")])


Q18 = """select user_id as run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_at, round(sum(value::decimal(12,6)) filter (where event_type = 'click'), 2)::double as collect_usd,
round(sum(value::decimal(12,6)) filter (where event_type = 'view'), 2)::double as review_usd, round(sum(value::decimal(12,6)), 2)::double as total_usd from events group by 1"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("source_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("title"), F.when(F.col("event_id") % 3 != 0, F.lit("Hall")).alias("venue"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("value") > 5, F.concat(F.lpad(F.hour("ts").cast("string"), 2, "0"), F.lit(":00"))).alias("time"), F.lit(None).cast("int").alias("program_position"), (F.col("event_id") % 2 == 0).alias("seen"),
    )


_ITEMS = """items as (select user_id as source_id, event_id as seq, event_type as title, case when event_id % 3 <> 0 then 'Hall' end as venue, strftime(ts, '%Y-%m-%d') as date, case when value > 5 then strftime(ts, '%H') || ':00' end as time, event_id % 2 = 0 as seen from events),
w as (select *, bool_or(time is not null) over (partition by source_id, title, coalesce(venue, ''), date) as timed, bool_or(venue is not null) over (partition by source_id, title, date) as place,
  row_number() over (partition by source_id, title, coalesce(venue, ''), date, time order by seq) as n from items),
kept as (select * from w where n = 1 and (time is not null or not timed) and (venue is not null or not place))"""


def q19_merge_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.merge_items(_items(spark, sf_dir)).select("source_id", "seq", "title", "venue", "date", "time")


Q19 = f"with {_ITEMS} select source_id, seq, title, venue, date, time from kept"


def q20_zone_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.merge_items(_items(spark, sf_dir), seen="seen").select("source_id", "seq", "title", "venue", "date", "time")


Q20 = f"""with {_ITEMS} select source_id, seq, title, venue, date, time from kept a where seen or time is null or not exists (select 1 from kept b where b.seen and b.time is not null and b.source_id = a.source_id and b.title = a.title
and b.venue is not distinct from a.venue and b.date = a.date and abs(substr(a.time, 1, 2)::int - substr(b.time, 1, 2)::int) in (1, 2))"""


def q21_fill_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").alias("seq"), F.col("lang").alias("title"), F.lit(None).cast("string").alias("company"), F.lit(None).cast("string").alias("venue"), F.when(F.col("doc_id") % 9 == 0, F.md5("text")).alias("choreographer"), F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("lang")).alias("description"), F.lit(None).cast("string").alias("image_url"))
    return readings.fill_from_siblings(rows).select("seq", "choreographer", "description", "image_url")


Q21 = """with r as (select source, lang, doc_id, case when doc_id % 9 = 0 then md5(text) end as ch, case when doc_id % 5 = 0 then null else lang end as de from documents),
b as (select source, lang, arg_min(ch, doc_id) filter (where ch is not null) as bc, arg_min(de, doc_id) filter (where de is not null) as bd from r group by all)
select doc_id as seq, coalesce(ch, bc) as choreographer, coalesce(de, bd) as description, null::varchar as image_url from r join b on b.source is not distinct from r.source and b.lang is not distinct from r.lang"""


def q22_settle_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_orderkey").alias("run_id"), F.lit("s").alias("source_id"), F.col("o_orderkey").cast("string").alias("title"), F.lit(None).cast("string").alias("work"), F.lit(None).cast("string").alias("venue"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start"), F.date_format(F.col("o_orderdate") + F.expr("interval 400 days"), "yyyy-MM-dd").alias("end"), F.when(F.col("o_orderkey") % 8 == 0, F.lit(4)).alias("expected"))
    items = table(spark, sf_dir, "lineitem").select(F.lit("s").alias("source_id"), F.col("l_orderkey").cast("string").alias("title"), F.lit(None).cast("string").alias("work"), F.lit(None).cast("string").alias("venue"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.col("l_returnflag").alias("time"), F.when(F.col("l_linenumber") == 1, "booking").otherwise("listed").alias("date_source"))
    return schedule.settle_runs(runs, items).select("run_id", "expected", "found", "status")


Q22 = """with i as (select o_orderkey as id, count(distinct {'d': l_shipdate::date, 't': l_returnflag}) filter (where l_shipdate >= o_orderdate and l_shipdate::date <= (o_orderdate + interval 400 days)::date) as found, bool_or(l_linenumber = 1) as hunted
  from orders join lineitem on l_orderkey = o_orderkey group by 1),
r as (select o_orderkey as run_id, case when o_orderkey % 8 = 0 then 4 end as expected, coalesce(found, 0) as found, coalesce(hunted, false) as hunted from orders left join i on id = o_orderkey)
select run_id, expected, found, case when expected > 0 and found >= expected then 'complete' when found <= 1 then 'range_only' when expected is null and hunted then 'complete' else 'partial' end as status from r"""


def q23_expanded_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.concat_ws("-", "event_type", F.floor(F.dayofmonth("ts") / 6)).alias("production"), F.to_date("ts").alias("date"), F.when(F.col("value") > 60, F.lit("19:30")).alias("time"))
    out = readings.expanded_ranges(items)
    return out.select("source_id", "production", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"))


Q23 = """select user_id as source_id, event_type || '-' || (day(ts) // 6) as production, strftime(min(ts), '%Y-%m-%d') as first, strftime(max(ts), '%Y-%m-%d') as last from events group by all
having count(*) filter (where value > 60) = 0 and count(distinct ts::date) >= 3 and date_diff('day', min(ts::date), max(ts::date)) + 1 = count(distinct ts::date)"""


def q24_page_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.page_key(F.col("url")).alias("page_key"))


Q24 = r"""with p as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) as h, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') as pa, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) as q from pages),
k as (select page_id, regexp_replace(h, '^www\.', '') as h, regexp_replace(pa || '/', '^/(en|fr|de|nl|it|es)(/|$)', '/') as pa, list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|source)='))) as q from p)
select page_id, h || coalesce(nullif(lower(regexp_replace(pa, '/+$', '')), ''), '/') || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as page_key from k"""


def q25_site_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.site_family(u).alias("family"), urls.is_ticket_seller(u).alias("seller"), urls.is_aggregator(u).alias("aggregator"))


Q25 = r"""with p as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) as h from pages), l as (select page_id, h, list_filter(string_split(h, '.'), lambda x: x <> '') as l from p)
select page_id, case when len(l) >= 3 and l[-2] in ('co', 'com', 'org', 'gov', 'ac', 'net', 'gob', 'gouv', 'edu') then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end as family,
regexp_matches(h, 'ticketmaster|eventim\.|fever|tix\.') as seller, regexp_matches(h, 'viagogo\.|stubhub\.|fever|seatgeek\.') as aggregator from l"""


def q26_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.html_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(t).alias("chars"), F.md5(t).alias("text_md5"))


_HTML = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?is)<noscript\b.*?</noscript>', ' ', 'g'), '(?is)<svg\b.*?</svg>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g'))".replace('\\"', '"')
Q26 = f"with p as (select page_id, {_HTML} as t from pages) select page_id, length(t) as chars, md5(t) as text_md5 from p"


def q27_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.page_fingerprint(F.col("text")).alias("fingerprint"))


Q27 = r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as s from documents),
c as (select doc_id, regexp_replace(regexp_replace(trim(regexp_replace(lower(s), '\s+', ' ', 'g')), '^[ \-|·•,:]+', ''), '[ \-|·•,:]+$', '') as s from l),
k as (select distinct doc_id, s from c where length(s) >= 3), g as (select doc_id, string_agg(s, chr(10) order by s) as body from k group by 1)
select d.doc_id, sha256(coalesce(body, '')) as fingerprint from documents d left join g on g.doc_id = d.doc_id"""


def q28_page_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.html_text(F.col("html"))
    status = F.when(F.col("page_id") % 17 == 0, 404).otherwise(200)
    rows = table(spark, sf_dir, "pages").select("page_id", t.alias("t"), status.alias("status"), F.when(F.col("page_id") % 19 == 0, "blocked by robots.txt: /").when(F.col("page_id") % 23 == 0, "timeout").otherwise("").alias("error"), F.when(F.col("page_id") % 29 == 0, "captcha").otherwise("").alias("blocked"))
    verdict = pages.page_verdict(F.col("error"), F.col("blocked"), F.col("status"), F.col("t"), F.lit(0))
    return pages.report_counts(rows.select(verdict.alias("verdict")))


Q28 = rf"""with p as (select page_id, {_HTML} as t from pages), v as (select case when page_id % 19 = 0 then 'ROBOTS' when page_id % 23 = 0 then 'ERROR' when page_id % 29 = 0 then 'BLOCKED' when page_id % 17 = 0 then 'ERROR' when length(t) < 300 then 'EMPTY'
  when not regexp_matches(t, '(?i){pages.DATES.replace(chr(39), chr(39) * 2)}') then 'NO DATES' else 'OK' end as verdict from p) select verdict, count(*) as n, verdict <> 'OK' as problem from v group by 1"""


def q34_drop_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    g = e.withColumn("week", (F.dayofmonth("ts") > 15).cast("int")).groupBy("user_id", "event_type").agg(F.count(F.when(F.col("week") == 0, 1)).cast("int").alias("n_before"), F.count(F.when(F.col("week") == 1, 1)).cast("int").alias("n_upcoming"))
    rows = g.select("user_id", "event_type", "n_before", "n_upcoming", F.lit(False).alias("no_answer"), F.lit(False).alias("truncated"), F.lit(True).alias("complete"), F.lit("").alias("page_status"), F.col("n_upcoming").alias("n_items"), F.when(F.col("user_id") % 20 == 0, F.lit("the rest is not included")).alias("unsure"), F.lit(None).cast("string").alias("range_text"))
    return schedule.second_look(rows).select("user_id", "event_type", "why")


Q34 = """with g as (select user_id, event_type, count(*) filter (where day(ts) <= 15) as b, count(*) filter (where day(ts) > 15) as n from events group by all)
select user_id, event_type, case when user_id % 20 = 0 then 'unsure: the rest is not included' when b >= 3 and n < b * 0.5 then 'found ' || n || ' shows, ' || b || ' at the last reading' end as why from g"""


def q35_recheck_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 7 != 0, (k % 5).cast("int")).alias("tier"), F.when(k % 3 == 0, "Festival").otherwise("Opera").alias("kind"), (k % 4).alias("found"), (k % 10 == 0).alias("soon"), F.when(k % 6 == 0, F.date_add(F.lit(TODAY), (k % 90 - 9).cast("int"))).alias("announced"))
    days = times.recheck_days(F.col("tier"), F.col("kind"), F.col("found"), F.col("soon"))
    return c.select("id", days.alias("days"), times.announcement_days(days, F.col("found"), F.col("announced"), TODAY, F.col("tier")).alias("with_announcement"))


Q35 = """with c as (select c_custkey as id, case when c_custkey % 7 <> 0 then c_custkey % 5 end as tier, c_custkey % 3 = 0 as fest, c_custkey % 4 as found, c_custkey % 10 = 0 as soon, case when c_custkey % 6 = 0 then c_custkey % 90 - 9 end as ahead from customer),
d as (select *, case coalesce(tier, 2) when 0 then 7 when 1 then 14 when 2 then 30 when 3 then 30 else 14 end as d0 from c), e as (select *, case when fest and found = 0 then greatest(d0, 30) else d0 end as d1 from d),
f as (select *, case when soon and tier in (0, 1) then least(d1, 7) else d1 end as days from e)
select id, days, case when days = 0 or ahead is null then days when found > 0 then least(days, greatest(1, ahead + 1)) else least(greatest(1, ahead + 1), case when tier in (0, 1) then 30 else 60 end) end as with_announcement from f"""


def q36_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.estimate_tokens(F.col("text")).alias("tokens"))


Q36 = r"select conv_id, turn, case when coalesce(text, '') = '' then 0 else floor((length(text) - length(regexp_replace(text, '[\x{0000}-\x{024F}]', '', 'g'))) / 3.0 + length(regexp_replace(text, '[\x{0000}-\x{024F}]', '', 'g')) / 1.6)::bigint + 1 end as tokens from conversations"

_PRICES = [("small", 0.1, 0.5, 0.125, 0.01, 5), ("medium", 2.0, 10.0, 2.5, 0.1, 1), ("large", 4.0, 20.0, 5.0, 0.2, 1)]


def q37_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = text.estimate_tokens(F.col("text"))
    model = F.when(F.col("conv_id") % 4 == 0, "small").when(F.col("conv_id") % 4 == 1, "medium").when(F.col("conv_id") % 4 == 2, "large").otherwise("unknown")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", model.alias("model"), (n * 500).alias("n_in"))
    price = spark.createDataFrame(_PRICES, "model string, p_in double, p_out double, p_write double, p_read double, long_factor int")
    usd = money.cost_usd(F.col("n_in"), F.lit(1500), F.lit(None).cast("int"), F.lit(2000), F.col("turn") % 2 == 0)
    return money.with_prices(rows, price).select("conv_id", "turn", "model", F.round(usd, 6).alias("usd"))


Q37 = """with t as (select conv_id, turn, case conv_id % 4 when 0 then 'small' when 1 then 'medium' when 2 then 'large' else 'unknown' end as model, 500 * (tokens) as n_in from (""" + Q36 + """)),
p as (select * from (values ('small', 0.1::double, 0.5::double, 0.01::double, 5), ('medium', 2.0, 10.0, 0.1, 1), ('large', 4.0, 20.0, 0.2, 1), ('unknown', 4.0, 20.0, 0.2, 1)) v(model, p_in, p_out, p_read, f))
select conv_id, turn, t.model, round((n_in * p_in + 1500 * p_out + 0 + 2000 * p_read) / 1000000 * case when n_in + 2000 > 100000 then f else 1 end * case when turn % 2 = 0 then 0.5::double else 1.0::double end, 6) as usd from t join p on p.model = t.model"""


def q38_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = text.excerpt(F.col("text"), F.array(F.lit("that"), F.lit("with")), limit=3000)
    return table(spark, sf_dir, "documents").select("doc_id", F.length(out).alias("chars"), F.md5(out).alias("excerpt_md5"))


def q39_stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = text.key_of(F.col("user_id"), F.col("event_type"), F.to_date("ts"))
    e = table(spark, sf_dir, "events").select(key.alias("dedupe_key"), "event_id")
    return tables.stage_rows(e.where("event_id % 10 <> 0"), e.where("event_id % 10 = 0")).select("dedupe_key")


Q39 = "with e as (select md5(concat_ws('|', user_id, event_type, strftime(ts, '%Y-%m-%d'))) as dedupe_key, event_id from events) select distinct dedupe_key from e where event_id % 10 <> 0 and dedupe_key not in (select dedupe_key from e where event_id % 10 = 0)"


def q40_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("at"))
    patch = o.where("id % 5 = 0").select("id", F.lit("N").alias("status"), "at").unionByName(o.where("id % 10 = 0").select("id", F.lit("L").alias("status"), (F.col("at") + F.expr("interval 1 day")).alias("at")))
    return tables.upsert_last(o, patch, ["id"], F.col("at")).select("id", "status")


Q40 = "select o_orderkey as id, case when o_orderkey % 10 = 0 then 'L' when o_orderkey % 5 = 0 then 'N' else o_orderstatus end as status from orders"

_COUNTRY_VALUES = ("Deutschland", "the Netherlands", "U.K.", "Paris, FR", "Spain (Catalunya)", "  ", "Atlantis", "Österreich", "Republic of Korea", "usa")


def q41_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country forms joined to customers by key."""
    form = F.element_at(F.array(*[F.lit(v) for v in _COUNTRY_VALUES]), (F.col("c_custkey") % len(_COUNTRY_VALUES) + 1).cast("int"))
    return countries.normalize_country(table(spark, sf_dir, "customer").select("c_custkey", form.alias("form")), "form")


_VALUES = ", ".join(f"({k}, '{v}', {n})" for k, (v, n) in enumerate(zip(_COUNTRY_VALUES, ("'Germany'", "'Netherlands'", "'United Kingdom'", "'France'", "'Spain'", "null", "'Atlantis'", "'Austria'", "'South Korea'", "'United States'"), strict=True)))
Q41 = f"select c_custkey, form, country_name from customer join (values {_VALUES}) v(k, form, country_name) on k = c_custkey % {len(_COUNTRY_VALUES)}"


def q42_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit lines made of part names: two names and a group."""
    p = table(spark, sf_dir, "part")
    line = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.initcap("p_name"), F.lit(" & "), F.col("p_brand"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.initcap("p_name"), F.lit(", Ensemble (after an idea)"))).otherwise(F.concat(F.lit("Choreography: "), F.initcap("p_name"), F.lit(" and NDT")))
    return p.select("p_partkey", F.array_join(text.split_credit_line(line), "|").alias("parts"))


_INIT = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
Q42 = f"select p_partkey, case p_partkey % 3 when 0 then {_INIT} || '|' || p_brand when 1 then {_INIT} else {_INIT} end as parts from part"


_MONTH_DAY = dt.date(2008, 1, 1)


def q43_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar addresses made of order months, eight years later: the number and the first of the months that follow."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.add_months("o_orderdate", 96))
    base = F.concat(F.lit("https://example.com/calendar"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("?month="), F.date_format("day", "yyyy-MM"))).otherwise(F.concat(F.lit("/"), F.date_format("day", "yyyy/MM"), F.lit("/"))))
    o = o.select("o_orderkey", base.alias("url")).withColumn("series", urls.month_series(F.col("url"), _MONTH_DAY, 6))
    return o.select("o_orderkey", F.size("series").alias("n"), F.get("series", F.lit(0)).alias("first"), urls.month_now(F.col("url"), _MONTH_DAY).alias("now"))


Q43 = f"""with o as (select o_orderkey, date_trunc('month', o_orderdate) + interval 96 month as d, o_orderkey % 2 = 0 as q from orders), k as (select *, year(d) * 12 + month(d) as k from o),
u as (select *, d + interval 1 month as nx, least(greatest({_MONTH_DAY.year * 12 + _MONTH_DAY.month + 6} - k, 0), 24) as n from k)
select o_orderkey, n, case when n > 0 then case when q then 'https://example.com/calendar?month=' || strftime(nx, '%Y-%m') else 'https://example.com/calendar/' || strftime(nx, '%Y/%m') || '/' end end as first,
case when k < {_MONTH_DAY.year * 12 + _MONTH_DAY.month} then case when q then 'https://example.com/calendar?month={_MONTH_DAY:%Y-%m}' else 'https://example.com/calendar/{_MONTH_DAY:%Y/%m}/' end
else case when q then 'https://example.com/calendar?month=' || strftime(d, '%Y-%m') else 'https://example.com/calendar/' || strftime(d, '%Y/%m') || '/' end end as now from u"""


def q44_ics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar files made of orders, read back."""
    o = table(spark, sf_dir, "orders")
    stamp = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("DTSTART;TZID=Europe/Paris:"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T193000"))).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), F.date_format("o_orderdate", "yyyyMMdd")))
    body = F.concat_ws("\r\n", F.lit("BEGIN:VCALENDAR"), F.lit("BEGIN:VEVENT"), F.concat(F.lit("SUMMARY:Order\\, "), F.col("o_orderpriority")), stamp, F.lit("LOCATION:Town\r\n  Hall"), F.lit("END:VEVENT"), F.lit("END:VCALENDAR"))
    return pages.read_ics(o.select("o_orderkey", body.alias("value"))).select("o_orderkey", "name", "start", "location")


Q44 = "select o_orderkey, 'Order, ' || o_orderpriority as name, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') || 'T19:30:00 (Europe/Paris)' else strftime(o_orderdate, '%Y-%m-%d') end as start, 'Town Hall' as location from orders"


def q45_sitemap_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps made of page addresses, read back and filtered to event pages."""
    p = table(spark, sf_dir, "pages")
    xml = F.concat(F.lit("<urlset><url><loc> "), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>1999-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("-01T10:00</lastmod></url></urlset>"))
    out = pages.read_sitemaps(p.select("page_id", xml.alias("value")))
    return out.select("page_id", "kind", "loc", "lastmod", urls.event_like(F.col("loc"), F.col("lastmod"), TODAY).alias("event_like"))


Q45 = "select page_id, 'page' as kind, url as loc, '1999-0' || (page_id % 9 + 1) || '-01' as lastmod, false as event_like from pages where url is not null"


def q46_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of each benchmark text: its words by place, with some left out on either side."""
    words = F.transform(F.split("text", " "), lambda w, i: F.struct(w.alias("title"), (i % 5).cast("string").alias("date"), i.alias("i")))
    side = lambda k: F.transform(F.filter(words, lambda x: x["i"] % k != 0), lambda x: F.struct(x["title"].alias("title"), x["date"].alias("date")))
    out = readings.compare_readings(table(spark, sf_dir, "benchmark").select("item_id", side(7).alias("first"), side(11).alias("ref")))
    return out.select("item_id", "n_first", "n_ref", "n_same", F.size("missed").alias("n_missed"), F.size("extra").alias("n_extra"), "same_dates")


Q46 = """with w as (select item_id, unnest(list_transform(string_split(text, ' '), lambda x, i: {'t': x, 'i': i - 1})) as x from benchmark),
a as (select distinct item_id, x.t as t, x.i % 5 as d from w where x.i % 7 <> 0), b as (select distinct item_id, x.t as t, x.i % 5 as d from w where x.i % 11 <> 0),
na as (select item_id, count(*) as n, list_sort(list(distinct d)) as ds from a group by 1), nb as (select item_id, count(*) as n, list_sort(list(distinct d)) as ds from b group by 1),
s as (select item_id, count(*) as n from a join b using (item_id, t, d) group by 1)
select i.item_id, coalesce(na.n, 0) as n_first, coalesce(nb.n, 0) as n_ref, coalesce(s.n, 0) as n_same, coalesce(nb.n, 0) - coalesce(s.n, 0) as n_missed, coalesce(na.n, 0) - coalesce(s.n, 0) as n_extra, coalesce(na.ds, []) = coalesce(nb.ds, []) as same_dates
from benchmark i left join na using (item_id) left join nb using (item_id) left join s using (item_id)"""


def q47_choose_timezone(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("user_id") % 3 == 0, "Europe/Lisbon").when(F.col("user_id") % 3 == 1, "Europe/London")
    country = F.when(F.col("user_id") % 5 == 0, "Spain").when(F.col("user_id") % 5 == 1, "France").when(F.col("user_id") % 5 == 2, "United States").when(F.col("user_id") % 5 == 3, "Ireland").otherwise("")
    zone = times.choose_timezone(own, country, F.to_date("ts"), F.lit("Europe/Paris"), F.lit("France"))
    return table(spark, sf_dir, "events").select("event_id", zone.alias("zone"), F.date_format(times.local(F.col("ts"), zone), "yyyy-MM-dd HH:mm").alias("wall"))


Q47 = """with z as (select event_id, ts, case user_id % 3 when 0 then 'Europe/Lisbon' when 1 then 'Europe/London' end as own, case user_id % 5 when 0 then 'Spain' when 1 then 'France' when 2 then 'United States' when 3 then 'Ireland' else '' end as c from events),
k as (select event_id, ts, case when own is not null then case when c = 'Spain' then case when own = 'Europe/Lisbon' then 'Europe/Madrid' else own end when c = 'France' then 'Europe/Paris' else own end
  when c = 'United States' then 'America/New_York' when c = 'Ireland' then 'Europe/Dublin' when c = 'Spain' then 'Europe/Madrid' else 'Europe/Paris' end as zone from z)
select event_id, zone, strftime((ts at time zone 'UTC') at time zone zone, '%Y-%m-%d %H:%M') as wall from k"""


def q48_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("job"), F.date_trunc("second", "ts").alias("at"))
    out = stalls(e, minutes=60)
    return out.select("job", F.date_format("since", "yyyy-MM-dd HH:mm:ss").alias("since"), F.date_format("until", "yyyy-MM-dd HH:mm:ss").alias("until"))


Q48 = """with e as (select distinct user_id % 20 as job, date_trunc('second', ts) as t from events), l as (select job, lag(t) over (partition by job order by t) as s, t from e)
select job, strftime(s, '%Y-%m-%d %H:%M:%S') as since, strftime(t, '%Y-%m-%d %H:%M:%S') as until from l where epoch(t) - epoch(s) > 3600"""


def q51_cache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("url"), F.col("event_type").alias("role"), (F.col("event_id") % 3).cast("string").alias("text_hash"), F.col("ts").alias("updated_at"), "event_id")
    page = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("url"), F.lit("click").alias("role"), (F.col("c_custkey") % 3).cast("string").alias("text_hash"))
    return readings.cache_state(page, e, dt.datetime(2024, 2, 5))


Q51 = """with l as (select user_id::varchar as u, arg_max({'h': (event_id % 3)::varchar, 't': ts}, {'a': ts, 'b': (event_id % 3)::varchar}) as x from events where event_type = 'click' group by 1)
select c_custkey::varchar as url, 'click' as role, (c_custkey % 3)::varchar as text_hash, case when u is null then 'new' when x.h <> (c_custkey % 3)::varchar then 'changed' when epoch(timestamp '2024-02-05') - epoch(date_trunc('second', x.t)) > 28 * 86400 then 'expired' else 'reuse' end as state
from customer left join l on u = c_custkey::varchar"""


def q52_months_to_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n"))
    m = e.select(F.col("user_id").alias("source_id"), (F.col("day") - 1).alias("month"), (F.col("n") > 0).alias("has_shows"))
    return schedule.months_to_read(m)


Q52 = """with m as (select user_id as source_id, day(ts) - 1 as month, count(*) filter (where event_type = 'purchase') > 0 as shows from events group by all),
l as (select *, coalesce(max(case when shows then month end) over (partition by source_id order by month rows between unbounded preceding and 1 preceding), -1) as last from m),
b as (select *, max((month > last + 4)::int) over (partition by source_id order by month rows unbounded preceding) as broken from l) select source_id, month from b where broken = 0 and (month <= last + 3 or month <= 3)"""


def q53_queue_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), (F.col("user_id") % 4).cast("int").alias("tier"), F.col("event_id").alias("seq"), F.concat(F.col("event_type"), F.dayofmonth("ts").cast("string")).alias("key"), (F.col("value") < 2).alias("skipped"))
    return schedule.queue_details(e, {0: 40, 1: 40, 2: 15, 3: 15}).select("source_id", "seq", "key")


Q53 = """with e as (select user_id as s, user_id % 4 as tier, event_id as seq, event_type || day(ts) as key, value < 2 as skipped from events), f as (select * from e qualify row_number() over (partition by s, key order by seq) = 1),
n as (select *, sum(case when skipped then 0 else 1 end) over (partition by s order by seq rows unbounded preceding) as n from f) select s as source_id, seq, key from n where not skipped and n <= case when tier in (0, 1) then 40 else 15 end"""


def q54_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.facet_counts(d.theaters(spark, sf_dir), ["city", "country", "timezone"])


Q54 = f"with {SQL} select 'city' as facet, city as value, count(*) as n from theaters group by 2 union all select 'country', country, count(*) from theaters group by 2 union all select 'timezone', timezone, count(*) from theaters where timezone is not null group by 2"


def q55_credit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit lines over part names resolved against people and companies of the domain."""
    p = table(spark, sf_dir, "part")
    people = p.groupBy("p_name").agg(F.min("p_partkey").alias("id")).where("id % 2 = 0").select("id", F.col("p_name").alias("name"), F.lit(None).cast("array<string>").alias("aliases"), F.timestamp_seconds("id").alias("created_at"))
    firms = d.companies(spark, sf_dir).withColumn("aliases", F.lit(None).cast("array<string>"))
    lines = p.select(F.col("p_partkey").alias("id"), F.concat(F.initcap("p_name"), F.lit(" & "), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") % 50).cast("string"), 9, "0"))).otherwise(F.lit("Tba"))).alias("name"))
    parts, _ = credits.rebuild_credits(lines, people, firms)
    return parts.groupBy("status").agg(F.count("*").alias("n"))


def q56_unsure_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat(F.lit("unsure "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(": note"))
    return table(spark, sf_dir, "orders").where(duplicates.unsure_recently(note, TODAY)).select("o_orderkey")


Q56 = f"select o_orderkey from orders where o_orderdate > timestamp '{_DAY}' - interval 14 days"


def q57_reusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.to_date("l_shipdate")).alias("dates"))
    ok = schedule.reusable((F.col("l_orderkey") % 40).cast("int"), F.col("dates"), F.col("l_orderkey") % 6 == 0, F.col("l_orderkey") % 11 == 0, TODAY)
    return g.select("l_orderkey", ok.alias("reusable"))


Q57 = f"""with g as (select l_orderkey as k, min(l_shipdate::date) filter (where l_shipdate::date >= date '{_DAY}') as nx from lineitem group by 1)
select k as l_orderkey, case when k % 40 >= 30 or k % 6 = 0 or k % 11 = 0 then false when nx is null then k % 40 < 14 else nx > date '{_DAY}' + 28 end as reusable from g"""


def q58_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.top_cities(d.theaters(spark, sf_dir), 7)


Q58 = f"with {SQL} select city, count(*) as n from theaters group by 1 order by n desc, city limit 7"

def q59_data_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir)
    rows = p.select("id", "title", "company_id", F.when(F.col("id") % 50 != 0, F.col("theater_id")).alias("theater_id"), F.when(F.col("id") % 2 == 0, "North").otherwise("South").alias("city"), F.hour("performance_date").alias("local_hour"), F.array_contains("tags", "Time TBC").alias("time_tbc"), F.date_trunc("day", "performance_date").alias("performance_date"))
    return checks.data_checks(rows, d.companies(spark, sf_dir))


Q59 = f"""with {SQL}, r as (select id, company_id, id % 2 = 0 as north, hour(performance_date) as h, tbc, date_trunc('day', performance_date) as day from performances),
a as (select company_id, day from r where company_id is not null and not tbc group by all having count(distinct north) > 1)
select 'odd hour' as "check", id from r where not tbc and h between 1 and 8 union all select 'no venue', id from r where id % 50 = 0
union all select 'two cities', r.id from r join a on a.company_id = r.company_id and a.day = r.day where not r.tbc"""

QUERIES = {n: f for n, f in sorted(globals().items()) if n[0] == "q" and n[1:3].isdigit()}
ORACLE = {n: globals()[q] for n in QUERIES if (q := n.partition("_")[0].upper()) in globals()}
