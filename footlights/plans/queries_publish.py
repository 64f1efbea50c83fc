"""Registered queries on publishing as a whole: dimensions made in one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions
from .domain import AS_OF, table


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's first line as a statement: venues by nation in several spellings, companies, people, works, programmes."""
    first = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f"))
    rows = table(spark, sf_dir, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, sf_dir, "part"), F.col("f.l_partkey") == F.col("p_partkey"))
    rows = rows.join(table(spark, sf_dir, "supplier"), F.col("f.l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k, sk, pk, n = F.col("o_orderkey"), F.col("s_suppkey"), F.col("p_partkey"), F.col("n_name")
    venue = F.when(k % 6 == 1, F.concat(F.lit("Opera "), n)).when(k % 6 == 2, F.concat(F.lit("OPERA  "), n, F.lit(" Stage"))).when(k % 6 == 3, F.concat(F.lit("Teatro "), n)).when(k % 6 == 4, F.concat(F.lit("Teatro "), n, F.lit(" Nuovo Hall")))
    venue = venue.when(k % 6 == 5, F.concat(F.lit("Nuovo Hall "), (F.col("c_custkey") % 40).cast("string")))
    return rows.select(
        k.alias("id"), F.when(sk % 5 == 0, F.concat(F.lit("s"), sk.cast("string"))).alias("source_id"), venue.alias("venue"), n.alias("city"), F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("timezone"),
        F.when(sk % 4 != 0, F.when(k % 2 == 0, F.upper("s_name")).otherwise(F.col("s_name"))).alias("company"), F.when(pk % 5 != 0, F.col("p_brand")).alias("choreographer"), F.lit(None).cast("string").alias("choreographer_nationality"),
        F.when(pk % 9 != 0, F.concat(F.lit("Work "), (pk % 50).cast("string"))).alias("work"), (pk % 11 == 0).alias("work_is_story"), F.when(k % 4 == 0, F.concat(F.lit("Evening "), (k % 30).cast("string"))).alias("program"),
        F.lit(None).cast("array<string>").alias("tags"), F.col("p_type").alias("genre"),
    )


def _resolved(spark: SparkSession, sf_dir: str) -> dimensions.Resolved:
    at = lambda c: F.timestamp_seconds(c.cast("long")).alias("created_at")
    none = F.lit(None).cast("array<string>").alias("aliases")
    nation, supplier, part = (table(spark, sf_dir, t) for t in ("nation", "supplier", "part"))
    key = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    theaters = nation.where("n_nationkey % 3 = 0").select(key("v", F.col("n_nationkey")).alias("id"), F.concat(F.lit("Opera "), F.col("n_name")).alias("name"), none, F.col("n_name").alias("city"), at(F.col("n_nationkey")))
    companies = supplier.where("s_suppkey % 2 = 0").select(key("c", F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"), none, at(F.col("s_suppkey")))
    people = part.select("p_brand").distinct().where("p_brand <> 'Brand#1'").select(key("b", F.col("p_brand")).alias("id"), F.col("p_brand").alias("name"), none, at(F.lit(0)))
    works = part.where("p_partkey in (5, 10, 15)").select(key("w", F.col("p_partkey")).alias("id"), F.concat(F.lit("Work "), F.col("p_partkey").cast("string")).alias("title"), F.when(F.col("p_partkey") != 10, F.lit("bBrand#2")).alias("choreographer_id"), at(F.col("p_partkey")))
    programs = part.where("p_partkey in (4, 8)").select(key("g", F.col("p_partkey")).alias("id"), F.concat(F.lit("Evening "), F.col("p_partkey").cast("string")).alias("title"), F.when(F.col("p_partkey") == 8, F.lit("c2")).alias("company_id"), at(F.col("p_partkey")))
    kind = F.when(F.col("s_suppkey") % 2 == 0, "Opera house").otherwise("Dance company").alias("kind")
    sources = supplier.select(key("s", F.col("s_suppkey")).alias("id"), kind, key("v", F.col("s_suppkey") % 25).alias("theater_id"), key("c", F.col("s_suppkey")).alias("company_id"))
    return dimensions.resolve_dimensions(_staged(spark, sf_dir), theaters, companies, people, works, programs, sources, AS_OF)


def q106_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dimensions of every statement, known or made in the batch, and what was noted."""
    return _resolved(spark, sf_dir).rows.select("id", *dimensions.DIMENSIONS, F.array_join("notes", "; ").alias("notes"))


def q107_new_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries that the batch makes and the names that known venues take on."""
    r = _resolved(spark, sf_dir)
    none = F.lit(None).cast("string")
    kinds = [("theater", r.theaters, "name", F.col("city")), ("company", r.companies, "name", F.col("city")), ("choreographer", r.choreographers, "name", none), ("work", r.works, "title", F.col("choreographer_id")), ("program", r.programs, "title", F.col("company_id"))]
    out = r.aliases.select(F.lit("alias").alias("kind"), F.col("theater_id").alias("id"), F.col("alias").alias("name"), none.alias("belongs"))
    for kind, df, name, belongs in kinds:
        out = out.unionByName(df.select(F.lit(kind).alias("kind"), "id", F.col(name).alias("name"), belongs.alias("belongs")))
    return out


_slug = lambda c: f"regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_grams = lambda c: f"list_distinct(flatten(list_transform(string_split({c}, '-'), lambda w: list_transform(range(len(w) + 1), lambda i: substr('  ' || w || ' ', i + 1, 3)))))"
_id = lambda kind, *parts: f"'{kind}-' || md5(concat_ws('|', " + ", ".join(f"coalesce('=' || {p}, '-')" for p in parts) + "))"
_score = lambda a, b: f"len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))"
_close = "(score >= 0.6 or length(b) >= 5 and contains(a, b) or length(a) >= 5 and contains(b, a))"

_SQL = f"""
with recursive first_line as (select l_orderkey, min({{'n': l_linenumber, 'p': l_partkey, 's': l_suppkey}}) as f from lineitem group by 1),
staged as (select o_orderkey as id, case when s_suppkey % 5 = 0 then 's' || s_suppkey end as source_id, s_suppkey, n_name as city,
  case o_orderkey % 6 when 1 then 'Opera ' || n_name when 2 then 'OPERA  ' || n_name || ' Stage' when 3 then 'Teatro ' || n_name when 4 then 'Teatro ' || n_name || ' Nuovo Hall' when 5 then 'Nuovo Hall ' || (c_custkey % 40) end as venue,
  case when s_suppkey % 4 <> 0 then case when o_orderkey % 2 = 0 then upper(s_name) else s_name end end as company, case when p_partkey % 5 <> 0 then p_brand end as choreographer,
  case when p_partkey % 9 <> 0 then 'Work ' || (p_partkey % 50) end as work, p_partkey % 11 = 0 as story, case when o_orderkey % 4 = 0 then 'Evening ' || (o_orderkey % 30) end as program
  from orders join first_line on o_orderkey = l_orderkey join part on f.p = p_partkey join supplier on f.s = s_suppkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
v_known as (select 'v' || n_nationkey as id, {_slug("'Opera ' || n_name")} as slug, n_name as city from nation where n_nationkey % 3 = 0),
v_rows as (select s.id, venue, {_slug('venue')} as key, s.city, k.id as exact from staged s left join v_known k on {_slug('venue')} = k.slug where venue is not null),
v_first as (select key, min(id) as first_id, arg_min(venue, id) as venue, arg_min(city, id) as city, row_number() over (order by min(id)) as n from v_rows where exact is null group by key),
v_pairs as (select f.key, k.id as to_id, null::varchar as to_key, k.slug as a, f.key as b, {_score(_grams('k.slug'), _grams('f.key'))} as score from v_first f join v_known k on lower(f.city) = lower(k.city)
  union all select f.key, {_id('venue', 'e.key')}, e.key, e.key, f.key, {_score(_grams('e.key'), _grams('f.key'))} from v_first f join v_first e on lower(f.city) = lower(e.city) and e.first_id < f.first_id),
v_close as (select * from v_pairs where {_close}),
v_order as (select n, key, not exists (select 1 from v_close c where c.key = f.key and to_key is null) as free, (select coalesce(list(to_key), []) from v_close c where c.key = f.key and to_key is not null) as near from v_first f),
v_pass as (select 0::bigint as n, []::varchar[] as leaders union all
  select o.n, case when o.free and not list_has_any(o.near, leaders) then list_append(leaders, o.key) else leaders end from v_pass p join v_order o on o.n = p.n + 1),
v_lead as (select unnest(leaders) as key from (select leaders from v_pass order by n desc limit 1)),
v_best as (select c.key, arg_max(to_id, (score, to_id)) as to_id from v_close c where to_key is null or to_key in (select key from v_lead) group by c.key),
v_made as (select f.key, first_id, f.venue, f.city, l.key is not null as leads, case when l.key is not null then {_id('venue', 'f.key')} else b.to_id end as to_id from v_first f left join v_lead l using (key) left join v_best b using (key)),
v as (select r.id, coalesce(exact, to_id) as found, case when exact is null and r.id = first_id then case when leads then 'new venue: ' else 'venue matched by close name: ' end || r.venue end as note from v_rows r left join v_made m on r.key = m.key and r.exact is null),
c_rows as (select s.id, company, {_slug('company')} as key, 'c' || k.s_suppkey as exact from staged s left join supplier k on {_slug('company')} = {_slug('k.s_name')} and k.s_suppkey % 2 = 0 where company is not null),
c_made as (select key, min(id) as maker, arg_min(company, id) as name from c_rows where exact is null group by key),
c as (select r.id, coalesce(exact, {_id('company', 'r.key')}) as found, case when r.id = maker then 'new company: ' || company end as note from c_rows r left join c_made m on r.key = m.key and exact is null),
p_rows as (select id, choreographer, {_slug('choreographer')} as key, case when choreographer <> 'Brand#1' then 'b' || choreographer end as exact from staged where choreographer is not null),
p_made as (select key, min(id) as maker, arg_min(choreographer, id) as name from p_rows where exact is null group by key),
p as (select r.id, coalesce(exact, {_id('choreographer', 'r.key')}) as found, case when r.id = maker then 'new choreographer: ' || choreographer end as note from p_rows r left join p_made m on r.key = m.key and exact is null),
base as (select s.*, coalesce(v.found, case when venue is null and source_id is not null and s_suppkey % 2 = 0 then 'v' || (s_suppkey % 25) end) as theater_id, coalesce(c.found, case when company is null and source_id is not null then 'c' || s_suppkey end) as company_id, p.found as choreographer_id,
  v.note as v_note, c.note as c_note, p.note as p_note from staged s left join v using (id) left join c using (id) left join p using (id)),
w_known as (select 'w' || p_partkey as id, {_slug("'Work ' || p_partkey")} as key, case when p_partkey <> 10 then 'bBrand#2' end as who, p_partkey as at from part where p_partkey in (5, 10, 15)),
w_rows as (select id, work, {_slug('work')} as key, story, case when not story then choreographer_id end as who from base where work is not null),
w_best as (select r.id, arg_min(k.id, (case when k.who = r.who then 0 else 1 end, k.at)) as exact from w_rows r join w_known k on r.key = k.key and case when story then k.who is null else r.who is null or k.who is null or k.who = r.who end group by r.id),
w_open as (select r.* from w_rows r left join w_best b using (id) where exact is null),
w_titles as (select key, arg_min({{'who': who}}, id).who as first_who, least(min(case when story then id end), case when arg_min({{'who': who}}, id).who is null then min(id) end) as t_free from w_open group by key),
w_own as (select key, who, min(id) as maker from w_open join w_titles using (key) where who is not null group by key, who, t_free having t_free is null or min(id) < t_free),
w_made as (select key, who, maker from w_own union all select key, null, t_free from w_titles where t_free is not null),
w_whose as (select o.*, t_free, own.maker as own_maker, case when story then null when o.who is null then first_who when own.maker is not null then o.who end as whose from w_open o join w_titles t using (key) left join w_own own on own.key = o.key and own.who = o.who),
w as (select r.id, coalesce(b.exact, {_id('work', 'r.key', 'n.whose')}) as found, case when b.exact is null and r.id = case when n.whose is null then t_free else own_maker end then 'new work: ' || r.work end as note
  from w_rows r left join w_best b using (id) left join w_whose n using (id)),
g_known as (select 'g' || p_partkey as id, {_slug("'Evening ' || p_partkey")} as key, case when p_partkey = 8 then 'c2' end as who, p_partkey as at from part where p_partkey in (4, 8)),
g_rows as (select id, program, {_slug('program')} as key, company_id as who from base where program is not null),
g_best as (select r.id, arg_min(k.id, k.at) as exact from g_rows r join g_known k on r.key = k.key and (r.who is null or r.who is not distinct from k.who) group by r.id),
g_open as (select r.* from g_rows r left join g_best b using (id) where exact is null),
g_first as (select key, min(id) as first_id, arg_min({{'who': who}}, id).who as first_who from g_open group by key),
g_made as (select key, who, min(id) as maker from g_open where who is not null group by key, who union all select key, null, first_id from g_first where first_who is null),
g as (select r.id, coalesce(b.exact, {_id('program', 'r.key', 'coalesce(r.who, f.first_who)')}) as found, case when b.exact is null and r.id = m.maker then 'new program: ' || r.program end as note
  from g_rows r left join g_best b using (id) left join g_first f on f.key = r.key left join g_made m on m.key = r.key and m.who is not distinct from coalesce(r.who, f.first_who))"""

Q106 = f"""{_SQL}
select b.id, theater_id, company_id, choreographer_id, w.found as work_id, g.found as program_id, concat_ws('; ', v_note, c_note, p_note, w.note, g.note) as notes from base b left join w using (id) left join g using (id)"""

Q107 = f"""{_SQL}
select 'alias' as kind, to_id as id, trim(venue) as name, null as belongs from v_made where not leads
union all select 'theater', to_id, trim(venue), city from v_made where leads
union all select 'company', {_id('company', 'key')}, trim(name), (select city from staged where id = maker) from c_made
union all select 'choreographer', {_id('choreographer', 'key')}, trim(name), null from p_made
union all select 'work', {_id('work', 'key', 'who')}, (select trim(work) from staged where id = maker), who from w_made
union all select 'program', {_id('program', 'key', 'who')}, (select trim(program) from staged where id = maker), who from g_made"""

QUERIES = {f.__name__: f for f in (q106_dimensions, q107_new_entries)}
ORACLE = {"q106_dimensions": Q106, "q107_new_entries": Q107}
