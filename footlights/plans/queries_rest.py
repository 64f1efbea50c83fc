"""Registered queries: readings on their way to staging, dimensions, pages, reviews, schedules and small rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, text, times, urls
from ..operators import checks, credits, duplicates, groups, ledger, link, pages, readings, schedule, serve, survive
from ..operators.graph import cut_lineage, gone_at_end, own_path
from ..sources import tables
from . import domain as d
from .domain import AS_OF, SQL, TODAY, table

_DAY = TODAY.isoformat()


def _k() -> Column:
    """The key of the part table."""
    return F.col("p_partkey")


def _pick(key: Column, values: tuple) -> Column:
    """One of several fixed values by a key."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _values(values: tuple) -> str:
    """The same values as a SQL list."""
    return "[" + ", ".join("null" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def q60_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.read_table(
        spark, f"{sf_dir}/orders.parquet", equal={"o_orderstatus": "F"}, among={"o_custkey": list(range(1, 60))}, least={"o_totalprice": 1000.0}, like={"o_orderpriority": "%h%"}, due=("o_orderdate", dt.datetime(1999, 1, 1)), order=["o_orderkey"]
    )
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


Q60 = "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F' and o_custkey between 1 and 59 and o_totalprice >= 1000 and o_orderpriority ilike '%h%' and (o_orderdate is null or o_orderdate <= timestamp '1999-01-01')"


def q61_upsert_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    k = F.col("id")
    new = c.where(k % 3 == 0).select("id", F.when(k % 6 != 0, F.upper("name")).alias("name"), F.when(k % 9 != 0, F.col("bal") + 1).alias("bal"), F.lit("X").alias("seg"))
    more = c.where(k % 10 == 0).select((k + 1_000_000).alias("id"), "name", "bal", F.lit("Y").alias("seg"))
    return survive.upsert_by_policy(c, new.unionByName(more), ["id"], {"name": "keep_if_null", "bal": "overwrite", "seg": "keep"})


Q61 = """select c_custkey as id, case when c_custkey % 3 = 0 and c_custkey % 6 <> 0 then upper(c_name) else c_name end as name,
  case when c_custkey % 3 <> 0 then c_acctbal when c_custkey % 9 <> 0 then c_acctbal + 1 end as bal, c_mktsegment as seg from customer
union all select c_custkey + 1000000, c_name, c_acctbal, 'Y' from customer where c_custkey % 10 = 0"""


def q62_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    k = F.col("id")
    named = F.when(k % 8 == 0, F.array(F.lit("bal"))).otherwise(F.array(F.lit("name"), F.lit("bal")))
    patch = c.where(k % 4 == 0).select("id", F.concat(F.lit("new "), "name").alias("name"), F.when(k % 12 != 0, F.lit(7.0)).alias("bal"), named.alias("set"))
    return survive.patch_by_key(c, patch, "id")


Q62 = """select c_custkey as id, case when c_custkey % 4 = 0 and c_custkey % 8 <> 0 then 'new ' || c_name else c_name end as name,
  case when c_custkey % 4 <> 0 then c_acctbal when c_custkey % 12 <> 0 then 7.0 end as bal from customer"""


def q63_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of all shards, written and read again, with their place in the report's order."""
    s = d.sources(spark, sf_dir)
    verdict = _pick(F.col("id"), ("OK", "ERROR", "OK", "EMPTY"))
    rows = s.select(F.lit("r1").alias("run_id"), (F.col("id") % 3).alias("shard"), F.col("name").alias("source"), "priority", verdict.alias("verdict"))
    path = own_path(spark, "reports")
    tables.write_reports(rows, path)
    gone_at_end(spark, path)
    found, _ = tables.combine_reports(spark, path, "source string, priority int, verdict string, run_id string, shard int")
    return found.select("source", "priority", "verdict", "shard")


Q63 = f"with {SQL} select name as source, priority, case id % 4 when 0 then 'OK' when 1 then 'ERROR' when 2 then 'OK' else 'EMPTY' end as verdict, (id % 3)::int as shard from sources"


def q64_csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that is appended to twice, exported as text and read again."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"), F.array("o_orderpriority", F.lit("a b")).alias("tags"))
    log, out = own_path(spark, "log"), own_path(spark, "csv")
    tables.append(o.where("o_orderkey % 2 = 0"), log)
    tables.append(o.where("o_orderkey % 2 = 1"), log)
    gone_at_end(spark, log)
    tables.write_csv(spark.read.parquet(log), out, ["o_orderkey", "status", "tags", "none"])
    gone_at_end(spark, out)
    return spark.read.option("header", True).csv(out, schema="o_orderkey long, status string, tags string, none string").select("o_orderkey", F.coalesce("status", F.lit("")).alias("status"), "tags", F.coalesce("none", F.lit("")).alias("none"))


Q64 = "select o_orderkey, case when o_orderkey % 5 <> 0 then o_orderstatus else '' end as status, o_orderpriority || ', a b' as tags, '' as none from orders"


def _reading_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading for each part, as JSON text: one to three shows, every fifth written at its root, every eleventh productions as text."""
    p = table(spark, sf_dir, "part")
    shows = F.transform(
        F.sequence(F.lit(0), (F.col("p_size") % 3).cast("int")),
        lambda i: F.struct(F.date_format(F.date_add(F.lit(TODAY), (_k() % 28).cast("int") + i), "yyyy-MM-dd").alias("date"), F.when(_k() % 2 == 0, F.lit("19:30")).alias("time"), F.concat(F.lit("Hall "), (_k() % 5).cast("string")).alias("venue")),
    )
    run = F.array(F.struct(F.when(_k() % 3 != 0, F.lit(" House ")).otherwise(F.lit(" ")).alias("venue"), F.lit(_DAY).alias("start"), F.when(_k() % 4 != 0, F.lit("2000-03-01")).otherwise(F.lit("soon")).alias("end"), (_k() % 9).cast("int").alias("expected_performances"), F.lit("").alias("dates_page_url")))
    production = F.array(F.struct(F.col("p_name").alias("title"), F.col("p_brand").alias("company"), shows.alias("performances"), run.alias("runs")))
    plain, root = F.to_json(F.struct(F.lit("ok").alias("page_status"), production.alias("productions"))), F.to_json(F.struct(F.col("p_name").alias("title"), F.col("p_brand").alias("company"), shows.alias("performances")))
    as_text = F.to_json(F.struct(F.to_json(production).alias("productions")))
    return p.select("p_partkey", F.when(_k() % 5 == 0, root).when(_k() % 11 == 0, as_text).otherwise(plain).alias("json"))


def q65_flatten_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reading_texts(spark, sf_dir).select("p_partkey", readings.lift_root(readings.parse_reading(F.col("json"))).alias("result"))
    return readings.flatten_reading(r).select("p_partkey", "pos", "title", "company", "date", "time", "venue")


Q65 = f"""select p_partkey, i::int as pos, p_name as title, p_brand as company, strftime(date '{_DAY}' + (p_partkey % 28 + i)::int, '%Y-%m-%d') as date, case when p_partkey % 2 = 0 then '19:30' end as time, 'Hall ' || (p_partkey % 5) as venue
from part, unnest(generate_series(0, (p_size % 3)::bigint)) as u(i)"""


def q66_runs_of_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reading_texts(spark, sf_dir).select("p_partkey", readings.lift_root(readings.parse_reading(F.col("json"))).alias("result"))
    rows = readings.run_rows(readings.runs_of(r).withColumn("source_id", F.lit("s")))
    return rows.select("p_partkey", "title", "company", "venue", "start", "end", "expected", "dates_page_url", "run_key")


Q66 = f"""select p_partkey, p_name as title, p_brand as company, case when p_partkey % 3 <> 0 then 'House' end as venue, '{_DAY}' as start, case when p_partkey % 4 <> 0 then '2000-03-01' end as "end", (p_partkey % 9)::int as expected, null::varchar as dates_page_url,
md5('s|' || lower(p_name) || '|' || case when p_partkey % 3 <> 0 then 'house' else '' end || '|{_DAY}') as run_key from part where p_partkey % 5 <> 0"""

_TITLES, _DATES = ("Giselle", " Giselle ", "", None, "Swan"), ("2024-01-20", "20/01/2024", "2024-01-05", "2024-02-31", None, "2024-01-16", " 2024-03-01 ")
_TIMES, _ZONES = ("19:30", "7.30pm", "24:00", " 09:05 ", None), ("Europe/Paris", "Mars/Base", " Asia/Tokyo ", "UTC")


def q67_clean_performances(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select(
        k, _pick(k, _TITLES).alias("title"), _pick(k, _DATES).alias("date"), _pick(k, _TIMES).alias("time"), _pick(k, _ZONES).alias("timezone"),
        *[F.when(k % 3 == 0, F.lit(" x ")).otherwise(F.lit(" ")).alias(c) for c in ("original_title", "work", "choreographer", "company", "venue", "city", "country", "program", "ticket_url", "image_url", "detail_url")],
        F.when(k % 4 == 0, F.array(F.lit("Classical"), F.lit(" "), F.lit("Classical"))).when(k % 4 == 1, F.array(F.lit("Premiere"))).alias("tags"), F.when(k % 2 == 0, True).alias("work_is_story"), F.when(k % 5 == 0, True).alias("cancelled"),
        (k % 3 - 1).cast("int").alias("program_position"), F.repeat(F.lit("word "), (k % 200).cast("int")).alias("description"), F.when(k % 6 == 0, "pattern").otherwise("x").alias("date_basis"),
    )
    got = readings.clean_performances(e, dt.date(2024, 1, 16))
    return got.select("event_id", "title", "date", "time", "timezone", "venue", F.array_join("tags", ",").alias("tags"), "work_is_story", "cancelled", "program_position", F.length("description").alias("n_chars"), "date_source")


Q67 = f"""with e as (select event_id as k, {_values(_TITLES)}[event_id % 5 + 1] as title, {_values(_DATES)}[event_id % 7 + 1] as date, {_values(_TIMES)}[event_id % 5 + 1] as time, {_values(_ZONES)}[event_id % 4 + 1] as zone from events)
select k as event_id, trim(title) as title, trim(date) as date, case when trim(time) in ('19:30', '09:05') then trim(time) end as time, case when trim(zone) in ('Europe/Paris', 'Asia/Tokyo') then trim(zone) end as timezone,
  case when k % 3 = 0 then 'x' end as venue, case k % 4 when 0 then 'Classical' when 1 then 'Contemporary,Premiere' else 'Contemporary' end as tags, k % 2 = 0 as work_is_story, k % 5 = 0 as cancelled, case when k % 3 = 2 then 1 end as program_position,
  case when k % 200 = 0 then null when k % 200 <= 120 then 5 * (k % 200) - 1 else 597 end::int as n_chars, case when k % 6 = 0 then 'pattern' else 'listed' end as date_source
from e where trim(title) <> '' and try_cast(trim(date) as date) >= date '2024-01-16' and regexp_matches(trim(date), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"""


def q68_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    text_of = lambda *v: _pick(k, v)
    items = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).alias("source_id"), "event_id", F.col("event_type").alias("title"), *[F.lit(None).cast("string").alias(c) for c in ("original_title", "work", "choreographer", "company", "program", "image_url", "description")], F.lit(False).alias("work_is_story"),
        text_of("Hall", None).alias("venue"), text_of("Lyon", None, None).alias("city"), text_of(None, "Japan", None, "Spain", "").alias("country"), text_of(None, "Europe/Lisbon", None).alias("timezone"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
        text_of("20:00", None).alias("time"), F.array("event_type").alias("tags"), F.lit(None).cast("int").alias("program_position"), text_of("https://shop.example/1", None).alias("ticket_url"), text_of(None, "https://site.example/e").alias("detail_url"), F.lit(False).alias("cancelled"), F.lit("listed").alias("date_source"),
    )
    sources = d.sources(spark, sf_dir).where("id < 4").select("id", F.concat(F.lit("https://www.site"), F.col("id").cast("string"), F.lit(".org/a")).alias("website"), F.when(F.col("id") == 1, "Festival").otherwise("Opera house").alias("kind"), F.lit("Paris").alias("city"), F.lit("France").alias("country"), F.lit("Europe/Paris").alias("timezone"))
    got = readings.to_staging(items, sources, _DAY)
    return got.groupBy("source_id", "source", "venue", "city", "country", "timezone", "performance_time", "time_tbc", "tickets_url", "genre", "status").agg(F.count("*").alias("n"), F.count_distinct("dedupe_key").alias("n_keys"), F.min("performance_date").cast("string").alias("first"))


Q68 = f"""with {SQL}, i as (select user_id % 4 as s, event_type as title, case when event_id % 2 = 0 then 'Hall' end as venue, case when event_id % 3 = 0 then 'Lyon' end as city, [null, 'Japan', null, 'Spain', ''][event_id % 5 + 1] as country,
  case when event_id % 3 = 1 then 'Europe/Lisbon' end as zone, strftime(ts, '%Y-%m-%d') as date, case when event_id % 2 = 0 then '20:00' end as time, case when event_id % 2 = 0 then 'https://shop.example/1' end as ticket from events),
v as (select i.*, kind <> 'Festival' as venue_source from i join (select id, case when id = 1 then 'Festival' else 'Opera house' end as kind from sources) k on k.id = i.s)
select s as source_id, 'www.site' || s || '.org' as source, venue, coalesce(city, case when venue_source and (venue is null or country is null) then 'Paris' end) as city,
  coalesce(country, case when venue_source or city is null then 'France' end) as country,
  case when zone is not null then case when country = 'Spain' then 'Europe/Madrid' when country = 'Japan' then 'Asia/Tokyo' else zone end when country = 'Japan' then 'Asia/Tokyo' when country = 'Spain' then 'Europe/Madrid' else 'Europe/Paris' end as timezone,
  time as performance_time, time is null as time_tbc, ticket as tickets_url, title as genre, 'pending' as status, count(*) as n, count(distinct concat_ws('|', title, coalesce(venue, ''), date, coalesce(time, ''))) as n_keys, min(date) as first
from v group by all"""


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        k.alias("id"), (F.col("user_id") % 7).alias("source_id"), F.when(k % 9 != 0, F.col("event_type")).otherwise(F.lit(" ")).alias("title"), F.when(k % 18 != 0, F.col("event_type")).alias("work"), F.when(k % 4 != 0, F.lit("Hall")).alias("venue"),
        F.when(k % 23 != 0, F.to_date("ts")).alias("performance_date"), F.when(k % 3 == 0, "19:30").alias("performance_time"), (k % 3 != 0).alias("time_tbc"), F.col("ts").alias("scraped_at"),
    )


def q69_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that never reach the ladder: incomplete, or without a venue next to one with it."""
    usable, bad = link.reject_incomplete(_staged(spark, sf_dir))
    copies = link.same_run_copies(usable).select("id", F.lit("copy").alias("reason"))
    return bad.select("id", "reason").unionByName(copies)


Q69 = """with s as (select event_id as id, user_id % 7 as src, case when event_id % 9 <> 0 then event_type end as title, case when event_id % 18 <> 0 then event_type end as work, event_id % 4 <> 0 as has, case when event_id % 23 <> 0 then ts::date end as d, event_id % 3 = 0 as timed, ts from events),
u as (select *, coalesce(title, work) as t from s where coalesce(title, work) is not null and d is not null)
select id, 'missing title/work or date' as reason from s where coalesce(title, work) is null or d is null
union all select id, 'copy' from u a where not has and exists (select 1 from u b where b.has and b.src = a.src and b.d = a.d and b.t = a.t and abs(epoch(a.ts) - epoch(b.ts)) < 86400 and (not a.timed or b.timed))"""


def q70_suppress(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir).select("id", "title", F.to_date("performance_date").alias("local_date"), F.when(F.col("id") % 2 == 0, F.date_format("performance_date", "HH:mm")).alias("local_time"), "theater_id")
    l = d.listings(spark, sf_dir).select("performance_id", "source_id", F.col("description").alias("listed_title"))  # noqa: E741
    return link.suppress(p, l, "out of scope").select("source_id", "title_slug", F.col("local_date").cast("string").alias("local_date"), "local_time", "theater_id", "reason")


_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"
Q70 = f"""with {SQL}, p as (select id, title, strftime(performance_date, '%Y-%m-%d') as local_date, case when id % 2 = 0 then strftime(performance_date, '%H:%M') end as local_time, theater_id from performances)
select distinct source_id, {_SLUG.format("description")} as title_slug, local_date, local_time, p.theater_id, 'out of scope' as reason from listings l join p on p.id = l.performance_id
union select null, {_SLUG.format("title")}, local_date, local_time, theater_id, 'out of scope' from p"""


def q71_snapshot_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir)
    snapshots = p.select("id", F.struct("title", F.date_format("performance_date", "yyyy-MM-dd").alias("local_date"), "theater_id").alias("snapshot"))
    got = link.suppressions_from_snapshots(snapshots, p.where("id % 6 <> 0"), dt.date(1997, 1, 1))
    return got.select("title_slug", F.col("local_date").cast("string").alias("local_date"), "theater_id")


Q71 = f"with {SQL} select distinct {_SLUG.format('title')} as title_slug, strftime(performance_date, '%Y-%m-%d') as local_date, theater_id from performances where id % 6 = 0 and performance_date::date >= date '1997-01-01'"

_ACCENTS = ("Opéra Garnier", "Straße", "Łódź", "cœur", "Ærø", "Šárka", "naïve")
_PLAIN = ("Opera Garnier", "Strasse", "Lodz", "coeur", "AEro", "Sarka", "naive")


def q72_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents, generic titles and programme names in brackets."""
    title = F.when(_k() % 4 == 0, "On Tour 2000").when(_k() % 4 == 1, F.col("p_brand")).when(_k() % 4 == 2, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.unaccent(_pick(_k(), _ACCENTS)).alias("plain"), text.is_generic_title(title, F.col("p_brand")).alias("generic"), text.piece_title(title, F.col("p_brand")).alias("piece"), text.clean_text(F.when(_k() % 2 == 0, F.unhex(F.lit("4142FF43"))).otherwise(F.encode("p_name", "UTF-8"))).alias("clean")
    )


Q72 = f"""select p_partkey, {_values(_PLAIN)}[p_partkey % 7 + 1] as plain, p_partkey % 4 <> 2 as generic, case p_partkey % 4 when 0 then 'On Tour 2000' when 1 then p_brand when 2 then p_name end as piece,
case when p_partkey % 2 = 0 then 'AB' || chr(65533) || 'C' else p_name end as clean from part"""


def q73_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir).join(d.companies(spark, sf_dir).select(F.col("id").alias("_firm"), F.col("name").alias("company_name")), F.col("company_id") == F.col("_firm"), "left").drop("_firm")
    p = p.withColumn("member_ids", F.when(F.col("id") % 10 == 0, F.array(F.lit("Brand#11"))).otherwise(F.array().cast("array<string>")))
    people = d.brands(spark, sf_dir).select("id", (F.col("id").isin("Brand#11", "Brand#23")).alias("protected"))
    return credits.protected_ids(p, people, d.sources(spark, sf_dir))


Q73 = f"""with {SQL}, core as (select company_id, lower(name) as n from (select s.*, s_name as name from sources s join supplier on s_suppkey = id) where priority = 0 and kind ilike '%company%')
select distinct p.id from performances p left join supplier c on c.s_suppkey = p.company_id where choreographer_id in ('Brand#11', 'Brand#23') or (p.id % 10 = 0 and exists (select 1 from part where p_brand = 'Brand#11'))
 or p.company_id in (select company_id from core) or exists (select 1 from core where contains(lower(c.s_name), core.n))"""

_PATHS = ("/event/x", "/en/events/x-2024-25", "/archive/event/x", "/season/2024-2025/event/y", "/season/2023-24/event/y", "/event/2025/z", "/news/event", "/event/2023/z")


def q74_event_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    url, today = F.concat(F.lit("https://x.org"), _pick(k, _PATHS)), dt.date(2025, 3, 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", urls.event_like(url, F.when(k % 3 == 0, F.lit("2021-01-01")).otherwise(F.lit("2025-01-01")), today).alias("wanted"))


Q74 = "select o_orderkey, o_orderkey % 3 <> 0 and o_orderkey % 8 in (0, 1, 3, 5) as wanted from orders"

_WALL_TITLES = ("Just a moment...", "Programme", "Access Denied", "Season")
_WALL_MARKS = ("plain words", "cf-chl-x", "g-recaptcha", "captcha-delivery.com")


def q75_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walls, reasons to skip and metrics of pages whose text is a mark and a number of words."""
    k = F.col("page_id")
    body = F.concat(_pick(F.floor(k / 4), _WALL_MARKS), F.repeat(F.lit(" dance 12.05."), _pick(k, (0, 10, 60, 400)).cast("int")))
    p = table(spark, sf_dir, "pages").select(k, _pick(F.floor(k / 16), _WALL_TITLES).alias("title"), _pick(F.floor(k / 3), (200, 403, 404)).cast("int").alias("status"), body.alias("body"))
    wall = pages.detect_block(F.col("status"), F.col("title"), F.col("body"), F.lit(""))
    m = pages.page_metrics(F.col("body"))
    return p.select("page_id", wall.alias("wall"), pages.skip_reason(F.when(k % 10 == 0, "timeout").otherwise(""), wall, F.col("body"), F.lit(0)).alias("skip"), m["chars"].alias("chars"), m["dates"].alias("dates"), m["dance"].alias("dance"))


Q75 = f"""with p as (select page_id as k, {_values(_WALL_TITLES)}[(page_id // 16) % 4 + 1] as title, [200, 403, 404][(page_id // 3) % 3 + 1] as status, {_values(_WALL_MARKS)}[(page_id // 4) % 4 + 1] as mark, [0, 10, 60, 400][page_id % 4 + 1] as n from pages),
q as (select *, length(mark) + 13 * n as c, case mark when 'cf-chl-x' then 'cloudflare' when 'captcha-delivery.com' then 'datadome' when 'g-recaptcha' then 'captcha' else '' end as m,
  title in ('Just a moment...', 'Access Denied') as walled from p),
w as (select *, case when c >= 1500 then '' when walled then case when m <> '' then m else 'bot wall' end when m <> '' and not (m = 'captcha' and status < 400 and c > 300) then m when status = 403 then 'HTTP 403' else '' end as wall from q)
select k as page_id, wall, case when k % 10 = 0 then 'timeout' when wall <> '' then 'blocked (' || wall || ')' when c < 300 then 'empty page (' || c || ' characters)' else '' end as skip, c::int as chars, n::int as dates, n::int as dance from w"""


def q76_redundant_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = d.listings(spark, sf_dir)  # noqa: E741
    n = F.col("position")
    rows = l.select("id", "source_id", "title", F.col("id").alias("seq"), F.when(F.col("source_id") % 5 == 2, "Dance company").otherwise("Opera").alias("kind"), (n % 4).alias("n_dated"), F.when(n % 3 == 0, 0).otherwise(n % 4).alias("n_timed"), F.col("generic").alias("has_open_run"), F.col("cancelled").alias("credits_known"))
    return schedule.redundant_pages(rows).select("id", "redundant")


Q76 = f"""with {SQL}, r as (select id, source_id, lower(title) as t, source_id % 5 = 2 as company, position % 4 > 0 and (case when position % 3 = 0 then 0 else position % 4 end) = position % 4 and not generic as complete, cancelled as known from listings),
n as (select *, row_number() over (partition by source_id, t, complete and not known order by id) as turn from r) select id, not company and complete and (known or turn > 1) as redundant from n"""


def q77_second_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a second reading does not count, coverage signs, announced dates and English titles' small rules."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    why = schedule.second_failed((k % 3).cast("int"), k % 7 != 0, F.when(k % 2 == 0, "has_performances").otherwise("ok"), (k % 4).cast("int"))
    announced = times.announcement_date(F.when(k % 3 == 0, F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")), F.when(k % 3 == 1, F.date_format(F.col("o_orderdate"), "yyyy-MM")), dt.date(1996, 1, 10))
    return o.select("o_orderkey", why.alias("why"), announced.cast("string").alias("announced"), schedule.save_notes(F.when(k % 2 == 0, "kept || last run: old"), F.lit("new")).alias("notes"), readings.count_upcoming(F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(None)), dt.date(1996, 1, 1)).alias("n"))


Q77 = """with o as (select o_orderkey as k, o_orderdate::date as d from orders),
a as (select *, case k % 3 when 0 then d when 1 then date_trunc('month', d)::date end as w from o)
select k as o_orderkey, case when k % 4 > 0 then case when k % 7 = 0 then 'gave no answer' when k % 3 = 0 and k % 2 = 0 then 'said the page has performances but listed none' end end as why,
  case when w > date '1996-01-10' and w <= date '1996-01-10' + 400 then strftime(w, '%Y-%m-%d') end as announced, case when k % 2 = 0 then 'kept || last run: new' else '|| last run: new' end as notes, (d >= date '1996-01-01')::int as n from a"""


def q78_coverage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.array_sort(F.collect_set(F.to_date("l_shipdate"))).alias("dates"))
    k = F.col("l_partkey")
    rows = g.select("l_suppkey", "l_partkey", "dates", (k % 3 == 0).alias("paged"), (k % 2).alias("n_details"), (k % 4 != 0).alias("core"), F.when(k % 5 == 0, "Festival").otherwise("State Opera").alias("kind"), F.array_max("dates").alias("last_date"))
    return schedule.coverage_checks(rows, dt.date(1997, 1, 1)).select("l_suppkey", "l_partkey", "month_only", "short_season")


Q78 = """with g as (select l_suppkey, l_partkey as k, count(distinct l_shipdate::date) as n, min(l_shipdate::date) as a, max(l_shipdate::date) as b from lineitem group by all)
select l_suppkey, k as l_partkey, n >= 3 and k % 3 <> 0 and k % 2 = 0 and b - a <= 35 as month_only, k % 4 <> 0 and k % 5 <> 0 and b < date '1997-01-01' + 75 as short_season from g"""


def q79_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies by name or alias, works by title, story and choreographer."""
    p = table(spark, sf_dir, "part")
    firms = d.companies(spark, sf_dir).withColumn("aliases", F.array(F.concat(F.lit("Troupe "), F.col("id").cast("string"))))
    name = F.when(_k() % 3 == 0, F.concat(F.lit(" troupe "), (_k() % 40).cast("string"))).when(_k() % 3 == 1, F.upper(F.format_string("Supplier#%09d", _k() % 40))).otherwise(F.lit("Nobody"))
    rows = p.select(_k().alias("id"), name.alias("company"), F.col("p_name").alias("work"), (_k() % 5 == 0).alias("work_is_story"), F.when(_k() % 4 != 0, F.col("p_brand")).alias("choreographer_id"))
    works = p.select(_k().alias("id"), F.col("p_name").alias("title"), F.when(_k() % 6 != 0, F.col("p_brand")).alias("choreographer_id"), F.timestamp_seconds(_k()).alias("created_at"))
    out = link.resolve_work(link.resolve_dimension(rows, firms, "company", "company_id"), works)
    return out.select("id", "company_id", "work_id")


Q79 = f"""with p as (select p_partkey as k, {_SLUG.format("p_name")} as slug, p_brand as b from part), r as (select k, slug, k % 5 = 0 as story, case when k % 4 <> 0 then b end as c from p), w as (select k as w, slug, case when k % 6 <> 0 then b end as wc from p),
m as (select r.k, w.w, row_number() over (partition by r.k order by case when wc = c then 0 else 1 end, w.w) as n from r join w using (slug) where slug <> '' and case when story then wc is null else c is null or wc is null or wc = c end),
f as (select s_suppkey as id, {_SLUG.format("s_name")} as slug from supplier union all select s_suppkey, 'troupe-' || s_suppkey from supplier)
select r.k as id, f.id as company_id, m.w as work_id from r left join m on m.k = r.k and n = 1
left join f on f.slug = case r.k % 3 when 0 then 'troupe-' || (r.k % 40) when 1 then 'supplier-' || lpad((r.k % 40)::varchar, 9, '0') end"""


def q80_match_theater(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = d.theaters(spark, sf_dir).select("id", F.concat(F.lit("Theatre "), F.col("city")).alias("name"), "city", "country", "created_at", F.lit(None).cast("array<string>").alias("aliases"))
    o = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("THEATRE "), "n_name")).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit("Theatre "), "n_name", F.lit(" Hall"))).alias("venue"), F.col("n_name").alias("city"), F.lit(None).cast("string").alias("country"))
    return link.match_theater(o, t).select("id", (F.col("theater_id").isNotNull()).alias("found"), "how")


Q80 = f"""with {SQL}, t as (select distinct city from theaters)
select n_nationkey as id, city is not null and n_nationkey % 3 < 2 as found, case when city is null then null when n_nationkey % 3 = 0 then 'name' when n_nationkey % 3 = 1 then 'close name' end as how from nation left join t on city = n_name"""


def q81_decided_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of orders of one customer that touch an upcoming one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pairs = o.select(F.col("o_orderkey").alias("a_id"), "o_custkey").join(o.select(F.col("o_orderkey").alias("b_id"), "o_custkey"), "o_custkey").where("a_id < b_id").select("a_id", "b_id")
    return duplicates.upcoming_pairs(pairs, o.where(F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1))).select(F.col("o_orderkey").alias("id")))


Q81 = """select a.o_orderkey as a_id, b.o_orderkey as b_id from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey < b.o_orderkey
where greatest(a.o_orderdate, b.o_orderdate) >= timestamp '1998-01-01'"""


def q82_source_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    l = d.listings(spark, sf_dir).select("performance_id", "source_id").join(o, F.col("performance_id") == F.col("o_orderkey")).select("source_id", F.col("o_custkey").alias("theater_id"))  # noqa: E741
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    s = d.sources(spark, sf_dir).join(nation, F.col("nation") == F.col("n_nationkey"))
    s = s.select("id", F.when(F.col("id") % 3 == 0, F.concat("city", F.lit(" ("), "name", F.lit(")"))).otherwise(F.col("name")).alias("name"), "city", "venue_source")
    t = d.theaters(spark, sf_dir).select("id", F.concat(F.lit("House of "), "city").alias("name"), "city")
    known = d.sources(spark, sf_dir).where("id % 20 = 1").select(F.col("id").alias("source_id"), F.col("id").alias("theater_id"))
    return serve.refresh_source_venues(l, s, t, known)


Q82 = f"""with {SQL}, l as (select source_id, o_custkey as theater_id, count(*) as n from listings join orders on o_orderkey = performance_id group by all),
s as (select id, n_name as city, id % 3 = 0 as by_city from sources join nation on nation = n_nationkey where venue_source), k as (select id as source_id, id as theater_id from sources where id % 20 = 1),
named as (select l.source_id, l.theater_id from l join s on s.id = l.source_id join theaters t on t.id = l.theater_id where by_city and length(s.city) >= 4 and contains({_SLUG.format("'House of ' || t.city")}, {_SLUG.format("s.city")})),
claimed as (select * from k union select * from named),
free as (select l.source_id, l.theater_id, row_number() over (partition by l.theater_id order by l.n desc, l.source_id) as r from l join s on s.id = l.source_id join theaters t on t.id = l.theater_id where s.city = t.city and l.theater_id not in (select theater_id from claimed))
select * from claimed union all select source_id, theater_id from free where r = 1"""


def q83_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of a bill in order, and one piece given twice in it."""
    p = d.performances(spark, sf_dir).select("id", "title", "theater_id")
    bills = p.groupBy(F.col("theater_id").cast("string").alias("ek")).agg(F.array_sort(F.collect_list("id")).alias("piece_ids"))
    rows = groups.pieces_of(bills, p.select("id", "title"))
    return rows.select("ek", F.size("pieces").alias("n"), F.md5(F.array_join(F.transform("pieces", lambda x: F.concat_ws(":", x["pos"], x["id"], x["title"])), "|")).alias("pieces_md5"))


Q83 = f"with {SQL}, r as (select theater_id::varchar as ek, id, title, row_number() over (partition by theater_id order by id) - 1 as pos from performances) select ek, count(*)::int as n, md5(string_agg(concat_ws(':', pos, id, title), '|' order by pos)) as pieces_md5 from r group by 1"


def q84_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    pending = e.where(k % 3 != 0).select((F.col("user_id") % 20).alias("batch_id"), k.alias("custom_id"), F.round("value", 2).alias("estimate"), F.col("ts").alias("updated_at"))
    answers = e.where(k % 2 == 0).select((F.col("user_id") % 20).alias("batch_id"), k.alias("custom_id"), F.when(k % 8 == 0, "errored").otherwise("succeeded").alias("result"))
    return readings.reconcile_pending(pending, answers, dt.datetime(2024, 2, 10))


Q84 = """select user_id % 20 as batch_id, event_id as custom_id, case when event_id % 3 = 0 then 'unknown' when event_id % 2 = 0 and event_id % 8 <> 0 then 'store' when event_id % 2 = 0 then 'refund' when epoch(timestamp '2024-02-10') - epoch(ts) > 30 * 86400 then 'expired' else 'wait' end as outcome,
case when event_id % 3 <> 0 and (event_id % 8 = 0 or (event_id % 2 = 1 and epoch(timestamp '2024-02-10') - epoch(ts) > 30 * 86400)) then round(value, 2) end as refund from events where event_id % 3 <> 0 or event_id % 2 = 0"""


def q85_company_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir).select("id", F.when(F.col("id") % 3 != 0, F.col("company_id")).alias("company_id"), "choreographer_id")
    lines = d.brands(spark, sf_dir).select(F.col("id").alias("line_id"), F.when(F.col("id") != "Brand#11", F.array(F.concat(F.lit("co "), "id"), F.lit("x"))).alias("company_ids"))
    return credits.company_fallback(p, lines).select("id", "company_id")


Q85 = f"with {SQL} select id, case when id % 3 <> 0 and company_id is not null then company_id::varchar when choreographer_id <> 'Brand#11' then 'co ' || choreographer_id end as company_id from performances"


def q86_credit_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.performances(spark, sf_dir).select(F.array("choreographer_id", "program_id").alias("choreographer_ids"), F.concat_ws("-", "theater_id", F.to_date("performance_date").cast("string")).alias("evening_key"), F.to_date("performance_date").alias("local_date"))
    return serve.credit_listing(p.withColumn("choreographer_ids", F.array_distinct(F.array_compact("choreographer_ids"))), d.brands(spark, sf_dir)).select("id", "name", "n_evenings", F.col("next_date").cast("string").alias("next_date"))


Q86 = f"with {SQL} select choreographer_id as id, choreographer_id as name, count(distinct theater_id || '-' || performance_date::date) as n_evenings, strftime(min(performance_date::date), '%Y-%m-%d') as next_date from performances where choreographer_id is not null group by 1"


def q87_piece_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = d.listings(spark, sf_dir)  # noqa: E741
    rows = l.select("id", F.col("performance_id").alias("program_id"), F.lit(1).alias("theater_id"), F.lit(dt.datetime(2000, 1, 1, 20)).alias("starts_at"), F.col("description").alias("title"), F.lit(None).cast("string").alias("choreographer_id"), F.timestamp_seconds(F.col("position") * 60 + F.col("source_id")).alias("created_at"))
    return groups.same_piece_twice(rows).select("program_id", F.array_join("ids", ",").alias("ids"))


Q87 = f"with {SQL} select performance_id as program_id, string_agg(id, ',' order by position * 60 + source_id, id) as ids from listings group by performance_id, description having count(*) > 1"


def q88_merge_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.listings(spark, sf_dir).select(F.col("performance_id").alias("run_key"), F.col("id").alias("seq"), _pick(F.col("position"), ("month", "site", "month")).alias("lens"), F.when(F.col("position") % 2 == 0, F.col("title")).alias("work"), F.col("company_id").alias("company"), F.when(F.col("position") > 3, F.col("position")).alias("expected"), F.col("ticket_url").alias("dates_page_url"), F.lit(None).cast("string").alias("venue_event_url"))
    return readings.merge_runs(rows).select("run_key", "work", "company", "expected", "dates_page_url", F.array_join("lenses", ",").alias("lenses"))


Q88 = f"""with {SQL}, r as (select performance_id as run_key, id as seq, case when position % 3 = 1 then 'site' else 'month' end as lens, case when position % 2 = 0 then title end as work, company_id as company, case when position > 3 then position end as expected, ticket_url as url from listings)
select run_key, arg_min(work, seq) filter (where work is not null) as work, arg_min(company, seq) filter (where company is not null) as company, arg_min(expected, seq) filter (where expected is not null) as expected, arg_min(url, seq) filter (where url is not null) as dates_page_url,
  case when count(distinct lens) = 1 then min(lens) when arg_min(lens, seq) = 'site' then 'site,month' else 'month,site' end as lenses from r group by 1"""


def q89_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    what = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    rows = e.select((F.col("user_id") % 30).alias("source_id"), F.date_format("ts", "yyyy-MM-dd").alias("date"), what.alias("what"))
    return schedule.announcements(rows)


Q89 = """with r as (select user_id % 30 as source_id, strftime(ts, '%Y-%m-%d') as date, event_type, min(case when event_id % 2 = 0 then upper(event_type) else event_type end) as what from events group by all)
select source_id, date, what, row_number() over (partition by source_id order by date, what) = 1 as is_next from r"""


def q90_capped_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second looks of each customer's orders, in order, where one in two is wanted and three are granted at first."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("seq"), (F.col("o_orderkey") % 2 == 0).alias("wanted"))
    return schedule.capped_looks(o, share=0.0, least=3)


Q90 = "select o_custkey as job, o_orderkey as seq, o_orderkey % 2 = 0 and sum((o_orderkey % 2 = 0)::int) over (partition by o_custkey order by o_orderkey) <= 3 as granted from orders"


def q91_feeds_and_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest pages of each site, and the feeds with most dates."""
    o = table(spark, sf_dir, "orders")
    site = (F.col("o_custkey") % 10).cast("string")
    entries = o.select(site.alias("site"), F.when(F.col("o_orderkey") % 9 == 0, "sitemap").otherwise("page").alias("kind"), F.concat(F.lit("https://x/"), (F.col("o_orderkey") % 500).cast("string")).alias("loc"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastmod"))
    newest = pages.top_sitemap_pages(entries, "site", 5).select("site", F.lit("page").alias("kind"), "loc", "lastmod")
    feeds = o.select(F.col("o_custkey").alias("page_id"), F.concat(F.lit("https://f/"), F.col("o_orderkey").cast("string")).alias("url"), F.repeat(F.lit("on 2025-01-02 \n "), (F.col("o_orderkey") % 6).cast("int")).alias("text"))
    best = pages.top_feeds(feeds, most=1).select(F.col("page_id").cast("string").alias("site"), F.lit("feed").alias("kind"), F.col("url").alias("loc"), F.col("n_dates").cast("string").alias("lastmod"))
    return newest.unionByName(best)


Q91 = """with e as (select (o_custkey % 10)::varchar as site, 'https://x/' || (o_orderkey % 500) as loc, max(strftime(o_orderdate, '%Y-%m-%d')) as lastmod from orders where o_orderkey % 9 <> 0 group by all),
n as (select *, row_number() over (partition by site order by lastmod desc, loc) as r from e), f as (select o_custkey as p, 'https://f/' || o_orderkey as url, o_orderkey % 6 as n from orders where o_orderkey % 6 >= 2),
g as (select *, row_number() over (partition by p order by n desc, url) as r from f)
select site, 'page' as kind, loc, lastmod from n where r <= 5 union all select p::varchar, 'feed', url, n::varchar from g where r = 1"""

_ANSWERS = ("a", "row_b", "it is {b}", "listing 70{n}", "nothing", "{b8}", "#2", "c1")


def q92_review_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that answers name, of pairs and of candidates; words and addresses of a case; the richer row."""
    k = F.col("s_suppkey")
    ids = F.array(F.md5(F.concat(F.lit("a"), k.cast("string"))), F.md5(F.concat(F.lit("b"), k.cast("string"))))
    rows = F.transform(ids, lambda i, n: F.struct(i.alias("id"), F.array((n * 10 + 700 + k % 10).cast("long")).alias("listings")))
    said = F.replace(F.replace(F.replace(_pick(k, _ANSWERS), F.lit("{b8}"), F.substring(F.get(ids, F.lit(1)), 1, 8)), F.lit("{b}"), F.get(ids, F.lit(1))), F.lit("{n}"), (k % 10).cast("string"))
    facts = lambda n, i: F.struct(F.lit(n).alias("sites"), (k % 2).cast("int").alias("timed"), F.lit(1).alias("filled"), (k % 3 + i).cast("int").alias("best_rank"), F.get(ids, F.lit(i)).alias("id"))
    rich = duplicates.richer(facts(1, 0), facts(1, 1))
    links = F.array(F.struct(F.lit(2).alias("rank"), F.lit("https://x/b").alias("url")), F.struct(F.lit(1).alias("rank"), F.when(k % 2 == 0, F.lit("https://x/a.pdf")).otherwise(F.lit("https://x/a")).alias("url")))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", duplicates.keep_id(said, rows, rich=rich).alias("of_pair"), duplicates.keep_id(said, rows, F.lit(True)).alias("of_list"), F.array_join(duplicates.case_urls(links), " ").alias("pages"), F.array_join(text.case_words(F.array("s_name", F.lit(None), F.lit("The Swan"))), " ").alias("words")
    )


Q92 = """with s as (select s_suppkey as k, md5('a' || s_suppkey) as a, md5('b' || s_suppkey) as b, s_name from supplier)
select k as s_suppkey, case when k % 8 in (1, 2, 5) then b else a end as of_pair, case k % 8 when 2 then b when 3 then a when 5 then b when 6 then b when 7 then a end as of_list,
case when k % 2 = 0 then 'https://x/b' else 'https://x/a https://x/b' end as pages, array_to_string(regexp_extract_all(s_name, '\\w+'), ' ') || ' The Swan' as words from s"""


def q93_deck(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return schedule.with_recent(c.where("id % 3 = 0"), c.where("id % 4 = 0").withColumn("name", F.lower("name")))


Q93 = "select c_custkey as id, case when c_custkey % 3 = 0 then c_name else lower(c_name) end as name from customer where c_custkey % 3 = 0 or c_custkey % 4 = 0"

_SEEN = ("doors 19.30 h", "at 7:30 pm", "19h30", "119:30", "7.30 PM", "19:300", "begin 19:30", None)


def q94_time_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    whole = _pick(k, ("20h", "8 pm", "8pm", "20:00 Uhr", "2000"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.time_seen(F.lit("19:30"), _pick(k, _SEEN)).alias("seen"), text.time_seen(F.lit("20:00"), whole).alias("whole"))


Q94 = "select s_suppkey, s_suppkey % 8 in (0, 1, 2, 4, 6) as seen, s_suppkey % 5 <> 4 as whole from supplier"


def q95_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a page by site, one spelling of an address, a feed asked for a wider window, booking links."""
    k = F.col("p_partkey")
    page = F.lit("https://www.house.org/season")
    links = F.array(F.lit("https://house.org/a"), F.concat(F.lit("https://tickets.house.org/"), k.cast("string")), F.lit("https://www.facebook.com/house"), F.lit("https://other.example/x"), F.lit("https://house.org/a"))
    feed = F.concat(F.lit("https://house.org/api?"), _pick(k, ("start=2024-01-01&end=2024-02-01", "from=01.01.2024&to=01.02.2024", "x=1", "start=20240101&end=20240201&v=2")))
    c = urls.classify_links(links, page)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(c["same"], " ").alias("same"), F.array_join(c["other"], " ").alias("other"), urls.same_address_key(F.concat(F.lit("https://x.org/a%20b?q="), k.cast("string"), F.lit("#top"))).alias("address"),
        urls.widen_feed_url(feed, dt.date(2025, 3, 1)).alias("wide"), urls.ticket_link(_pick(k, ("https://shop.example/1", None)), F.lit("https://house.org/e")).alias("ticket"),
    )


Q95 = """select p_partkey, 'https://house.org/a https://tickets.house.org/' || p_partkey as same, 'https://other.example/x' as other, 'https://x.org/a b?q=' || p_partkey as address,
'https://house.org/api?' || case p_partkey % 4 when 0 then 'start=2025-03-01&end=2026-03-01' when 1 then 'from=01.03.2025&to=01.03.2026' when 3 then 'start=20250301&end=20260301&v=2' end as wide, case when p_partkey % 2 = 0 then 'https://shop.example/1' end as ticket from part"""


def q96_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of requests before they are sent, and which trim of a prompt fits."""
    k = F.col("conv_id")
    price = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("p_in"), F.lit(o).alias("p_out"), F.lit(i).alias("p_write"), F.lit(r).alias("p_read"), F.lit(f).alias("long_factor")) for m, i, o, r, f in (("small", 1.0, 5.0, 0.1, 3), ("large", 4.0, 20.0, 0.4, 1))])).alias("p")).select("p.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", _pick(k, ("small", "large", "other")).alias("model"), (k % 40 * 5000).alias("n"))
    usd = money.estimate_request(F.lit(2000), F.col("n"), k % 2 == 0, k % 3 == 0)
    sizes = F.array(F.col("n"), F.floor(F.col("n") / 2), F.floor(F.col("n") / 4))
    return money.with_prices(rows, price).select("conv_id", "turn", F.round(usd, 6).alias("usd"), money.trim_step(sizes).alias("step"))


Q96 = """with r as (select conv_id, turn, conv_id % 3 as m, conv_id % 40 * 5000 as n, case when conv_id % 2 = 0 then 4500 else 1500 end as o from conversations)
select conv_id, turn, round((n * i + o * p + 2000 * r2) / 1000000 * case when n + 2000 > 100000 then f else 1 end * case when conv_id % 3 = 0 then 0.5::double else 1 end, 6) as usd, case when n <= 85000 then 1 when n // 2 <= 85000 then 2 else 3 end as step
from r join (values (0, 1.0::double, 5.0::double, 0.1::double, 3), (1, 4.0, 20.0, 0.4, 1), (2, 4.0, 20.0, 0.4, 1)) v(m, i, p, r2, f) using (m)"""


def q97_save_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a run for every customer as a source, and the sources after it."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    runs = c.where(k % 10 != 0).select(
        k.alias("source_id"), (k % 3).alias("n_items"), (k % 4 * 10).alias("n_details"), F.lit(25).alias("detail_cap"), (k % 17 == 0).alias("out_of_time"), (k % 5 == 0).cast("int").alias("n_blocked"), (k % 2).alias("readable"), (k % 19 == 0).alias("unanswered"), (k % 7 == 0).cast("int").alias("left_open"),
        F.when(k % 8 == 0, F.array(F.lit("not_published_yet"))).when(k % 8 == 1, F.array(F.lit("no_dance_programme"), F.lit("not_a_schedule"))).otherwise(F.array(F.lit("has_performances"))).alias("page_statuses"), (k % 6).alias("upcoming"),
    )
    done = schedule.finalize_sources(runs)
    s = F.col("source_id")
    results = done.select(
        "source_id", F.col("n_items").alias("found"), "status", (s % 13 == 0).alias("opens_soon"), (F.col("unanswered") | (F.col("left_open") > 0)).alias("again"), F.when(s % 6 == 1, F.date_add(F.lit(TODAY), (s % 50 - 10).cast("int"))).alias("announced"),
        F.lit("season").alias("announced_what"), F.lit("soon").alias("announced_quote"), F.lit("run 1").alias("summary"), F.lit("https://x/s").alias("schedule_url"), F.when(s % 4 == 0, F.array(F.lit("https://x/1"), F.lit("https://x/2"))).alias("start_pages"),
    )
    sources = c.select(
        k.alias("id"), F.when(k % 7 != 0, (k % 5).cast("int")).alias("priority"), F.when(k % 3 == 0, "Festival").otherwise("Opera").alias("kind"), F.lit("n").alias("notes"), F.lit("old").alias("status"), F.lit(TODAY).alias("next_check_at"), F.when(k % 2 == 0, F.lit(dt.date(1999, 12, 1))).otherwise(F.lit(dt.date(2000, 6, 1))).alias("announcement_at"),
        F.lit("earlier").alias("announcement_note"), F.when(k % 3 == 1, F.lit("https://own")).alias("schedule_url"), F.when(k % 8 == 0, F.array(F.lit("https://x/1"))).alias("extra_schedule_urls"),
    )
    out = schedule.save_source(sources, results, TODAY)
    text_of = lambda c: F.col(c).cast("string").alias(c)
    return out.select("id", "status", text_of("next_check_at"), "notes", text_of("announcement_at"), "announcement_note", "schedule_url", F.array_join("extra_schedule_urls", " ").alias("pages"))


Q97 = f"""with c as (select c_custkey as k, case when c_custkey % 7 <> 0 then c_custkey % 5 end as tier, c_custkey % 3 = 0 as fest, c_custkey % 3 as items, c_custkey % 7 = 0 or c_custkey % 19 = 0 as again from customer),
r as (select *, case when items > 0 then case when k % 4 * 10 > 25 or k % 17 = 0 or k % 5 = 0 or again then 'partial' else 'ok' end when k % 7 = 0 then 'partial' when k % 5 = 0 and k % 2 = 0 then 'blocked' when k % 8 = 0 then 'waiting' when k % 8 = 1 then 'no_dance' else 'failed' end as st0, k % 6 > 0 and items < 0.5 * (k % 6) as chk from c),
t as (select *, case when chk and st0 = 'no_dance' then 'failed' else st0 end as st, case when k % 6 = 1 then k % 50 - 10 end as ahead, case coalesce(tier, 2) when 0 then 7 when 1 then 14 when 2 then 30 when 3 then 30 else 14 end as d0 from r),
u as (select *, case when fest and items = 0 then greatest(d0, 30) else d0 end as d1 from t), v as (select *, case when again then 0 when k % 13 = 0 and tier in (0, 1) then least(d1, 7) else d1 end as d2 from u),
w as (select *, case when d2 = 0 or ahead is null then d2 when items > 0 then least(d2, greatest(1, ahead + 1)) else least(greatest(1, ahead + 1), case when tier in (0, 1) then 30 else 60 end) end as days from v)
select k as id, case when k % 10 = 0 then 'old' else st end as status, strftime(date '{_DAY}' + case when k % 10 = 0 then 0 else days end::int, '%Y-%m-%d') as next_check_at, case when k % 10 = 0 then 'n' else 'n || last run: run 1' end as notes,
  case when k % 10 <> 0 and ahead is not null then strftime(date '{_DAY}' + ahead::int, '%Y-%m-%d') when k % 10 <> 0 and k % 2 = 0 and st in ('ok', 'partial', 'waiting', 'no_dance') then null when k % 2 = 0 then '1999-12-01' else '2000-06-01' end as announcement_at,
  case when k % 10 <> 0 and ahead is not null then 'season: ' || strftime(date '{_DAY}' + ahead::int, '%Y-%m-%d') || ' ("soon")' else 'earlier' end as announcement_note, case when k % 3 = 1 then 'https://own' when k % 10 <> 0 then 'https://x/s' end as schedule_url,
  case when k % 10 <> 0 and k % 4 = 0 then 'https://x/1 https://x/2' when k % 8 = 0 then 'https://x/1' end as pages from w"""


def q98_titles_and_hunts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English titles kept from the last reading, pages to hunt dates on, sources with rows of this run."""
    p = table(spark, sf_dir, "part")
    url = F.concat(F.lit("https://h/"), (_k() % 9).cast("string"))
    last = p.where(_k() % 2 == 0).select(url.alias("url"), F.lit("list").alias("role"), F.concat(F.lit("The "), "p_name").alias("title"), F.concat("p_name", F.lit(" "), _k().cast("string")).alias("original_title"))
    new = p.select(url.alias("url"), F.lit("list").alias("role"), _k().alias("id"), F.concat("p_name", F.lit(" "), _k().cast("string")).alias("title"), F.when(_k() % 3 == 0, F.concat("p_name", F.lit(" "), _k().cast("string"))).alias("original_title"))
    titles = readings.keep_english_titles(new, last).select(F.lit("title").alias("kind"), F.col("id").cast("string").alias("id"), F.col("title").alias("value"), F.col("changed").cast("string").alias("more"))
    l = d.listings(spark, sf_dir)  # noqa: E741
    runs = l.select("source_id", (F.col("source_id") % 4).alias("tier"), F.col("position").alias("seq"), F.when(F.col("position") % 2 == 0, "complete").otherwise("partial").alias("status"), F.concat(F.lit("https://dates/"), F.col("position").cast("string")).alias("dates_page_url"), F.when(F.col("generic"), F.lit("https://stage/x")).alias("venue_event_url"))
    seen = d.sources(spark, sf_dir).select(F.col("id").alias("source_id"), F.lit("https://dates/3").alias("url")).where("id % 8 = 1")
    hunts = schedule.hunt_targets(runs, seen, 3).select(F.lit("hunt").alias("kind"), F.col("source_id").cast("string").alias("id"), F.col("url").alias("value"), F.col("place").cast("string").alias("more"))
    s = d.sources(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, "todo").otherwise("failed").alias("status"), F.lit(dt.datetime(1999, 1, 1)).alias("last_collected_at"))
    got = link.mark_collected(s, l.where("source_id % 3 = 0").select("source_id"), AS_OF)
    marked = got.select(F.lit("source").alias("kind"), F.col("id").cast("string").alias("id"), F.date_format("last_collected_at", "yyyy-MM-dd").alias("value"), F.col("status").alias("more"))
    return titles.unionByName(hunts).unionByName(marked)


Q98 = f"""with {SQL}, h as (select source_id as s, 'https://dates/' || position as url, min((position, 0)) as pl from listings where source_id % 4 in (0, 1) and position % 2 = 1 group by all
  union all select source_id, 'https://stage/x', min((position, 1)) from listings where source_id % 4 in (0, 1) and position % 2 = 1 and generic group by 1),
g as (select *, row_number() over (partition by s order by pl, url) as r from h where not (s % 8 = 1 and url = 'https://dates/3'))
select 'title' as kind, p_partkey::varchar as id, case when p_partkey % 2 = 0 then 'The ' || p_name else p_name || ' ' || p_partkey end as value, case when p_partkey % 2 = 0 then 'true' else 'false' end as more from part
union all select 'hunt', s::varchar, url, r::varchar from g where r <= 3
union all select 'source', s.id::varchar, case when exists (select 1 from listings l where l.source_id = s.id and l.source_id % 3 = 0) then '{_DAY}' else '1999-01-01' end,
  case when s.id % 2 = 1 then 'failed' when exists (select 1 from listings l where l.source_id = s.id and l.source_id % 3 = 0) then 'ok' else 'todo' end from sources s"""


def q99_clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a clean-up closes, removals in scope, and payments from blocks."""
    p = d.performances(spark, sf_dir)
    k = F.col("id")
    day = F.to_date("performance_date")
    now = dt.date(1996, 6, 1)
    held = p.select("id", day.alias("day")).where(k % 5 == 0)
    pairs = p.where(k % 4 == 0).select("id", k.alias("a_id"), (k + 4).alias("b_id"))
    closed = duplicates.housekeeping(held, pairs, p.where(k % 6 == 0).select("id", k.alias("performance_id")), p.select("id", day.alias("day")), now)
    closed = closed.select("kind", "id", F.col("new_status").alias("value"))
    rows = p.select("id", "title", day.alias("local_date"), F.lit(None).cast("string").alias("local_time"), "theater_id")
    left, rules, counts = checks.scope_removals(p.where(k % 3 == 0).select(k.alias("drop_id"), F.lit("not dance").alias("verdict")), p.where(k % 9 == 0).select("id"), rows, d.listings(spark, sf_dir).select("performance_id", "source_id", F.col("description").alias("listed_title")))
    removed = left.groupBy((k % 2).cast("string").alias("id")).agg(F.count("*").cast("string").alias("value")).select(F.lit("left").alias("kind"), "id", "value")
    told = counts.select(F.lit("removed").alias("kind"), F.col("verdict").alias("id"), F.col("n").cast("string").alias("value"))
    n_rules = rules.groupBy(F.coalesce(F.col("source_id").cast("string"), F.lit("any")).alias("id")).agg(F.count("*").cast("string").alias("value")).select(F.lit("rules").alias("kind"), "id", "value")
    actions = link.action_counts(p.select(F.when(k % 7 == 0, "hold").otherwise("update").alias("action"))).select(F.lit("action").alias("kind"), F.col("action").alias("id"), F.col("n").cast("string").alias("value"))
    spends = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("job")).agg(F.count("*").alias("n")).select("job", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("seq"), F.lit(5).cast("long").alias("amount"))
    paid = ledger.budget_blocks(spends, cap=20, block=10).groupBy("job").agg(F.sum("reserved").alias("r"), F.count(F.when(F.col("paid"), 1)).alias("p"))
    payments = paid.select(F.lit("paid").alias("kind"), F.col("job").cast("string").alias("id"), F.concat_ws("/", "p", "r").alias("value"))
    return closed.unionByName(removed).unionByName(told).unionByName(n_rules).unionByName(actions).unionByName(payments)


Q99 = f"""with {SQL}, p as (select id, performance_date::date as day, {_SLUG.format("title")} as slug, theater_id from performances), gone as (select * from p where id % 3 = 0 and id % 9 <> 0),
rules as (select distinct l.source_id::varchar as s, {_SLUG.format("l.description")} as slug, g.day, g.theater_id from listings l join gone g on g.id = l.performance_id union select 'any', slug, day, theater_id from gone where slug <> '')
select 'held' as kind, id::varchar as id, 'expired' as value from p where id % 5 = 0 and day < date '1996-06-01'
union all select 'pair', a.id::varchar, 'rejected' from p a left join p b on b.id = a.id + 4 where a.id % 4 = 0 and (b.id is null or greatest(a.day, b.day) < date '1996-06-01')
union all select 'conflict', id::varchar, 'dismissed' from p where id % 6 = 0 and day < date '1996-06-01'
union all select 'left', (id % 2)::varchar, count(*)::varchar from p where id % 3 <> 0 or id % 9 = 0 group by id % 2
union all select 'removed', case when id % 9 = 0 then 'protected' else 'not dance' end, count(*)::varchar from p where id % 3 = 0 group by all
union all select 'rules', s, count(*)::varchar from rules group by s
union all select 'action', case when id % 7 = 0 then 'hold' else 'update' end, count(*)::varchar from p group by all
union all select 'paid', l_orderkey::varchar, least(count(*), 4) || '/' || case when count(*) > 2 then 20 else 10 end from lineitem group by l_orderkey"""

QUERIES = {n: f for n, f in sorted(globals().items()) if n[0] == "q" and n[1:3].isdigit()}
ORACLE = {n: globals()["Q" + n[1:3]] for n in QUERIES if "Q" + n[1:3] in globals()}
