"""Registered queries on nested event data and on SQL text that calls the library's functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pages, sql_surface
from . import domain as d
from .domain import AS_OF, table
from .queries_core import Q11


def _nested(page_id: Column, url: Column) -> Column:
    """A page whose block holds 1 to 9 objects one inside the other, some of them events, some in lists."""
    key = F.array(*[F.lit(k) for k in pages.EVENT_KEYS])
    kind = F.array(F.lit('"WebPage"'), F.lit('["Thing", "EventSeries"]'), F.lit('"Festival"'))

    def wrap(inner: Column, k: Column) -> Column:
        deep = F.when(k % 4 == 1, F.concat(F.lit("[["), inner, F.lit("]]"))).when(k % 4 == 2, F.concat(F.lit('[{"n": 0}, '), inner, F.lit("]"))).otherwise(inner)
        return F.concat(F.lit('{"@type": '), F.element_at(kind, ((page_id + k) % 3 + 1).cast("int")), F.lit(', "n": '), k.cast("string"), F.lit(', "'), F.element_at(key, ((page_id + k) % 5 + 1).cast("int")), F.lit('": '), deep, F.lit("}"))

    core = F.concat(F.lit('{"@type": "DanceEvent", "n": '), F.length(url).cast("string"), F.lit("}"))
    block = F.aggregate(F.sequence(F.lit(1), (page_id % 9 + 1).cast("int")), core, wrap)
    return F.concat(F.lit('<p>a</p><script type="application/ld+json">no data</script><script type="application/ld+json">'), block, F.lit("</script>"))


def q114_nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the pages' blocks, however deep."""
    p = table(spark, sf_dir, "pages")
    rows = pages.extract_events(p.select("page_id", _nested(F.col("page_id"), F.coalesce("url", F.lit(""))).alias("html")))
    return rows.select("page_id", "block", "path", F.get_json_object("event", "$.n").cast("long").alias("n"))


_KEYS = "[" + ", ".join(f"'{k}'" for k in pages.EVENT_KEYS) + "]"
Q114 = f"""with recursive wrapped as (
  select page_id, 0 as k, '{{"@type": "DanceEvent", "n": ' || length(coalesce(url, '')) || '}}' as j from pages
  union all select page_id, k + 1, '{{"@type": ' || ['"WebPage"', '["Thing", "EventSeries"]', '"Festival"'][(page_id + k + 1) % 3 + 1] || ', "n": ' || (k + 1) || ', "' || {_KEYS}[(page_id + k + 1) % 5 + 1] || '": '
    || case (k + 1) % 4 when 1 then '[[' || j || ']]' when 2 then '[{{"n": 0}}, ' || j || ']' else j end || '}}' from wrapped where k < page_id % 9 + 1),
nodes as (
  select page_id, '$' as path, j::json as v from wrapped where k = page_id % 9 + 1
  union all select page_id, path || step.p, step.v from (
    select page_id, path, unnest(case when json_type(v) = 'ARRAY' then list_transform(range(0, json_array_length(v)::bigint), lambda i: {{'p': '[' || i || ']', 'v': json_extract(v, '$[' || i || ']')}})
      else list_filter(list_transform({_KEYS}, lambda k: {{'p': '.' || k, 'v': json_extract(v, '$."' || k || '"')}}), lambda s: s.v is not null) end) as step from nodes where json_type(v) in ('ARRAY', 'OBJECT')))
select page_id, 1 as block, path, (v->>'n')::bigint as n from nodes where json_type(v) = 'OBJECT' and (v->>'@type' in ('DanceEvent', 'Festival') or contains(v->>'@type', 'EventSeries'))"""


def q115_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and their makers by SQL text alone: keys, closeness, generic titles, ranks, evenings and notes."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sql_surface.create_scalar_functions(own)
    own.read.parquet(f"{sf_dir}/part.parquet").createOrReplaceTempView("part")
    return own.sql("""
        select p_partkey, slugify(p_name || ' (' || p_type || ')') as slug, title_close(p_name, p_type) as close, piece_title(p_name || ' (' || p_brand || ')', p_brand) as piece,
          is_generic_title(case when p_partkey % 3 = 0 then upper(p_brand) else p_name end, p_brand) as generic, without_bracket(p_name || ' (' || p_type || ')') as bare,
          source_rank(p_partkey % 11 <> 0, case when p_partkey % 5 = 0 then 'Editor' when p_partkey % 5 = 1 then 'Festival' when p_partkey % 5 = 2 then 'Dance company' else 'Opera house' end, p_size % 3, p_partkey % 2 = 0, p_partkey % 7 = 0) as rank,
          evening_key(case when p_partkey % 2 = 0 then p_brand end, string(p_partkey), string(p_size), timestamp'2026-01-01 00:00:30' + make_dt_interval(0, 0, p_size)) as evening,
          unsure_recently('unsure 2026-01-' || lpad(p_partkey % 40, 2, '0'), date'2026-01-20') as unsure, minutes_of_day(string(p_size % 30) || ':' || lpad(p_size, 2, '0')) as minute,
          site_family('https://www.' || lower(replace(p_brand, '#', '')) || '.co.uk/a') as family
        from part""")


_slug = lambda c: f"regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_grams = lambda c: f"list_distinct(flatten(list_transform(string_split({c}, '-'), lambda w: list_transform(range(len(w) + 1), lambda i: substr('  ' || w || ' ', i + 1, 3)))))"
Q115 = f"""with x as (select *, {_slug('p_name')} as a, {_slug('p_type')} as b from part), y as (select *, {_grams('a')} as ga, {_grams('b')} as gb from x),
z as (select *, len(list_intersect(ga, gb)) as common from y)
select p_partkey, {_slug("p_name || ' (' || p_type || ')'")} as slug, (common / (len(ga) + len(gb) - common) >= 0.3 or (len(b) >= 5 and contains(a, b)) or (len(a) >= 5 and contains(b, a))) as close, p_name as piece,
p_partkey % 3 = 0 as generic, p_name as bare,
case when p_partkey % 11 = 0 then 6 when p_partkey % 5 = 0 then 0 when p_partkey % 5 > 2 and p_partkey % 2 = 0 then case when p_size % 3 = 0 then 1 else 4 end when p_partkey % 5 = 1 then 2 when p_partkey % 7 = 0 or p_partkey % 5 = 2 then 3 else 5 end as rank,
md5(concat_ws('|', case when p_partkey % 2 = 0 then p_brand else p_partkey::varchar end, p_size::varchar, strftime(timestamp '2026-01-01' + to_minutes(p_size::bigint), '%Y-%m-%d %H:%M'))) as evening,
p_partkey % 40 > 6 and p_partkey % 40 <= 31 as unsure, p_size % 30 * 60 + p_size as minute, lower(replace(p_brand, '#', '')) || '.co.uk' as family from z"""


def q116_sql_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public pages by a table function in SQL text."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    p = d.performances(own, sf_dir)
    p = p.select("id", F.concat(F.lit("show-"), F.col("id").cast("string")).alias("slug"), F.concat_ws("|", F.coalesce("program_id", F.col("id").cast("string")), "theater_id").alias("evening_key"), "performance_date", "program_position", F.col("performance_date").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"), "company_id", "theater_id", "program_id", F.array_compact(F.array("choreographer_id")).alias("member_ids"))
    for name, df in (("performances", p), ("choreographers", d.brands(own, sf_dir)), ("companies", d.companies(own, sf_dir)), ("theaters", d.theaters(own, sf_dir)), ("programs", d.brands(own, sf_dir))):
        df.createOrReplaceTempView(name)
    sql_surface.create_sitemap_function(own)
    return own.sql(f"select kind, slug, date_format(lastmod, 'yyyy-MM-dd HH:mm') as lastmod from sitemap_entries(timestamp'{AS_OF}')")


QUERIES = {f.__name__: f for f in (q114_nested_events, q115_sql_functions, q116_sql_sitemap)}
ORACLE = {"q114_nested_events": Q114, "q115_sql_functions": Q115, "q116_sql_sitemap": Q11}
