"""Registered queries on runs: reference readings, trimmed requests, counts of a clean-up, editors' picks in credit lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import credits, duplicates, readings, requests
from . import domain as d
from .domain import SQL, table


def q118_reference_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a page of a test run, and where its reference reading comes from; 40 may be read afresh."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where("doc_id is not null")
    k = F.col("doc_id")
    rows = docs.select(k.alias("seq"), F.md5("text").alias("text_hash"), F.when(k % 3 == 0, F.md5("text")).when(k % 3 == 1, F.md5(F.concat("text", F.lit(" ")))).alias("cached_hash"), F.when(k % 2 == 0, "large").when(k % 7 != 0, "small").alias("cached_model"), (k % 5 == 0).alias("has_second"))
    return readings.choose_reference(rows, 40, ("large", "larger")).select("seq", "reference")


Q118 = """with r as (select doc_id as seq, case when doc_id % 6 = 0 and text is not null then 'cache' when doc_id % 5 = 0 then 'second look' end as kind from documents where doc_id is not null)
select seq, coalesce(kind, case when row_number() over (partition by kind is null order by seq) <= 40 then 'fresh' else 'none' end) as reference from r"""


def q119_trimmed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a page with links, venues and event data, trimmed to 4,000 tokens."""
    k = F.col("doc_id")
    some = lambda label, n: F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.concat(F.lit(label), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    text = F.coalesce("text", F.lit(""))
    pages = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("Page "), k.cast("string")).alias("head"), F.when(k % 5 != 0, text).alias("events"), F.when(k % 3 != 0, F.concat(F.lit("https://example.com/data "), text)).alias("feeds"),
        F.concat(text, F.repeat(F.lit("танец "), (k % 11 * 20).cast("int"))).alias("text"), some("Opera house ", k % 400).alias("venues"), some("https://example.com/shows/", k % 350).alias("same"),
        some("https://example.org/tour/", k % 100).alias("other"), some("https://example.com/season/show-", k % 250).alias("sitemap"), (k % 3 * 500).alias("fixed_tokens"),
    )
    out = requests.trim_requests(pages, most=4_000)
    return out.select("doc_id", F.md5("request").alias("request_md5"), "tokens", "step")


_lines = lambda label, n, most: f"array_to_string(list_transform(range(1, least({n}, {most}) + 1), lambda i: '{label}' || i), chr(10))"
_part = lambda label, body: f"case when length({body}) > 0 then '{label}:' || chr(10) || {body} || chr(10) || chr(10) else '' end"


def _request_sql(k: int) -> str:
    x = requests.LIMITS[k]
    parts = [
        _part("Venues", _lines("Opera house ", "doc_id % 400", x["venues"])), _part("Event data", f"substr(coalesce(events, ''), 1, {x['events']})"), _part("Background data", "coalesce(feeds, '')") if x["feeds"] else "''",
        _part("Sitemap", _lines("https://example.com/season/show-", "doc_id % 250", x["sitemap"])), _part("Links", _lines("https://example.com/shows/", "doc_id % 350", x["same"])),
        _part("Links elsewhere", _lines("https://example.org/tour/", "doc_id % 100", x["other"])), _part("Text", f"substr(t, 1, {x['text']})"),
    ]
    return f"select *, {k + 1} as step, 'Page ' || doc_id || chr(10) || chr(10) || {' || '.join(parts)} as request from p"


Q119 = f"""with p as (select doc_id, case when doc_id % 5 <> 0 then coalesce(text, '') end as events, case when doc_id % 3 <> 0 then 'https://example.com/data ' || coalesce(text, '') end as feeds,
coalesce(text, '') || repeat('танец ', doc_id % 11 * 20) as t from documents),
r as ({' union all '.join(_request_sql(k) for k in range(len(requests.LIMITS)))}),
o as (select *, length(regexp_replace(request, '[\\x{{0000}}-\\x{{024F}}]', '', 'g')) as other from r),
n as (select *, doc_id % 3 * 500 + floor((length(request) - other) / 3.0::double + other / 1.6::double)::bigint + 1 as tokens from o)
select doc_id, md5(request) as request_md5, tokens, step from n qualify row_number() over (partition by doc_id order by tokens > 4000, case when tokens <= 4000 then step else -step end) = 1"""


def q120_clean_up_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many held rows, pairs and conflicts a clean-up closes."""
    p = d.performances(spark, sf_dir)
    k, day = F.col("id"), F.to_date("performance_date")
    held, pairs = p.select("id", day.alias("day")).where(k % 5 == 0), p.where(k % 4 == 0).select("id", k.alias("a_id"), (k + 4).alias("b_id"))
    return duplicates.housekeeping_counts(duplicates.housekeeping(held, pairs, p.where(k % 6 == 0).select("id", k.alias("performance_id")), p.select("id", day.alias("day")), dt.date(1996, 6, 1)))


Q120 = f"""with {SQL}, p as (select id, performance_date::date as day from performances)
select (select count(*) from p where id % 5 = 0 and day < '1996-06-01') as held_expired,
(select count(*) from p a left join p b on b.id = a.id + 4 where a.id % 4 = 0 and (b.id is null or greatest(a.day, b.day) < '1996-06-01')) as pairs_closed,
(select count(*) from p where id % 6 = 0 and day < '1996-06-01') as conflicts_past"""

def q121_credit_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of credit lines after an editor's picks: lines without one as they are, the others built anew."""
    p = table(spark, sf_dir, "part")
    k, w = F.col("p_partkey"), F.split(F.initcap("p_name"), " ")
    people = p.groupBy("p_name").agg(F.min("p_partkey").alias("id")).where("id % 5 <> 0").select("id", F.col("p_name").alias("name"), F.lit(None).cast("array<string>").alias("aliases"), F.timestamp_seconds("id").alias("created_at"))
    firms = d.companies(spark, sf_dir).withColumn("aliases", F.lit(None).cast("array<string>"))
    firm = F.concat(F.lit(" & Supplier#"), F.lpad((k % 50).cast("string"), 9, "0"))
    name = F.when(k % 4 == 0, F.initcap("p_name")).when(k % 4 == 1, F.concat(F.initcap("p_name"), firm)).when(k % 4 == 2, F.concat(w[1], firm)).otherwise(F.concat(w[0], F.lit(" & Extra "), w[1]))
    lines = p.select(k.alias("id"), name.alias("name"))
    pick = people.agg(F.min("id")).first()[0]
    strange = p.join(people.select(F.col("name").alias("p_name")), "p_name", "left_anti").where(k % 20 == 1).select(k.alias("line_id"), F.initcap("p_name").alias("part"), F.lit(pick).alias("member_id"))
    left_out = p.where(k % 20 == 2).select(k.alias("line_id"), w[1].alias("part"), F.lit(None).cast("long").alias("member_id"))
    extra = p.where(k % 20 == 3).select(k.alias("line_id"), F.concat(F.lit("Extra "), w[1]).alias("part"), F.lit(pick).alias("member_id"))
    decisions = strange.unionByName(left_out).unionByName(extra)
    _, anew, _ = credits.resolve_credit_parts(decisions, people, lines, firms)
    rest, _ = credits.rebuild_credits(lines.join(decisions.select(F.col("line_id").alias("id")), "id", "left_anti"), people, firms)
    return anew.unionByName(rest).select("line_id", "pos", "part", "status", "member_id", "company_id", F.array_join("candidates", ",").alias("candidates"))


Q121 = """with people as (select p_name, min(p_partkey) as id from part group by 1 having min(p_partkey) % 5 <> 0),
x as (select p_partkey as k, p_name, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b, p_partkey % 20 as m, h.id as who, (select min(id) from people)::varchar as pick from part left join people h using (p_name)),
cap as (select *, upper(a[1]) || a[2:] as ca, upper(b[1]) || b[2:] as cb, (m = 1 and who is null) or m in (2, 3) as touched, p_name in (select p_name from x where m = 1 and who is null) as taken from x),
bearers as (select split_part(p_name, ' ', 2) as b, string_agg(id::varchar, ',' order by id::varchar) as ids, count(*) as n from people group by 1),
full_names as (
  select k, 0 as pos, ca || ' ' || cb as part, 'self' as status, k::varchar as member_id, null as company_id, null as candidates from cap where k % 4 = 0
  union all select k, 0, ca || ' ' || cb, case when m = 1 and who is null then 'decided' when who is not null then 'person' else 'new person' end, case when m = 1 and who is null then pick when who is not null then who::varchar else 'new:' || a || '-' || b end, null, null from cap where k % 4 = 1
  union all select k, 0, cb, case when m = 2 then 'decided' when n = 1 then 'person' else 'unresolved' end, case when m <> 2 and n = 1 then ids end, null, case when m <> 2 and n is distinct from 1 then coalesce(ids, '') end from cap left join bearers using (b) where k % 4 = 2
  union all select k, 0, ca, case when who is not null or (touched and taken) then 'person' else 'new person' end, case when who is not null then who::varchar when touched and taken then pick else 'new:' || a || '-' || b end, null, null from cap where k % 4 = 3
  union all select k, 1, 'Extra ' || cb, case when touched then 'decided' else 'new person' end, case when touched then pick else 'new:extra-' || b end, null, null from cap where k % 4 = 3
  union all select k, 1, 'Supplier#' || lpad((k % 50)::varchar, 9, '0'), case when s_suppkey is not null then 'company' else 'unresolved' end, null, s_suppkey::varchar, case when s_suppkey is null then '' end from cap left join supplier on s_suppkey = k % 50 where k % 4 in (1, 2))
select k as line_id, pos, part, status, member_id, company_id, candidates from full_names"""

QUERIES = {f.__name__: f for f in (q118_reference_readings, q119_trimmed_requests, q120_clean_up_counts, q121_credit_decisions)}
ORACLE = {"q118_reference_readings": Q118, "q119_trimmed_requests": Q119, "q120_clean_up_counts": Q120, "q121_credit_decisions": Q121}
