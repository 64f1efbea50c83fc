"""Registered queries on change sets: verdicts carried out, snapshots kept, and everything taken back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, duplicates
from ..operators.graph import cut_lineage
from . import domain as d
from .domain import SQL, TODAY, table
from .queries_core import _PARTS, _RANK, _VENUES, _cases, _part_rows, _venues


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as performances, their listings by supplier, and orders as staging rows; each is read several times, so written once."""
    text = lambda c: F.col(c).cast("string")
    p = table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.col("p_name").alias("title"), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("editor "), text("p_partkey"))).alias("editorial"))
    lists = d.listings(spark, sf_dir).groupBy("work_id", "source_id").agg(F.min("id").alias("id"))
    lists = lists.select("id", text("work_id").alias("performance_id"), text("source_id").alias("source_id"), F.lit(False).alias("ignored"))
    s = d.performances(spark, sf_dir).select(text("id").alias("id"), text("work_id").alias("performance_id"))
    return p, cut_lineage(lists, "listings"), cut_lineage(s, "staging")


def _verdicts(spark: SparkSession, sf_dir: str) -> tuple[changes.Verdicts, tuple[DataFrame, DataFrame, DataFrame]]:
    """Every second part takes a neighbour in, in an order of its own; every third part's listings of some sources are wrong."""
    p, lists, s = _tables(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    drop = F.col("p_partkey") - 1 - F.col("p_size") % 4
    merges = part.where((F.col("p_partkey") % 2 == 0) & (drop >= 0)).select((F.col("p_partkey") * 7919 % 1000003).cast("long").alias("seq"), drop.cast("string").alias("drop_id"), F.col("p_partkey").cast("string").alias("keep_id"))
    wrong = lists.where((F.col("performance_id").cast("long") % 3 == 0) & (F.col("source_id").cast("long") % 7 == 0)).select("performance_id", F.col("id").alias("listing_id"))
    return changes.verdict_changes(p, lists, s, merges, wrong), (p, lists, s)


def q108_verdict_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performances, listings and staging rows after all verdicts."""
    v, (p, lists, s) = _verdicts(spark, sf_dir)
    none = F.lit(None).cast("string")
    out = changes.apply_changes(p, v.performances, "id").select(F.lit("performances").alias("kind"), "id", none.alias("performance_id"), none.alias("source_id"), F.col("editorial").alias("value"))
    out = out.unionByName(changes.apply_changes(lists, v.listings, "id").select(F.lit("listings").alias("kind"), "id", "performance_id", "source_id", F.col("ignored").cast("string").alias("value")))
    return out.unionByName(changes.apply_changes(s, v.staging, "id").select(F.lit("staging").alias("kind"), "id", "performance_id", none.alias("source_id"), none.alias("value")))


def q109_verdict_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the verdicts changed: table, key, operation, and the facts of the image before."""
    v, _ = _verdicts(spark, sf_dir)
    of = lambda c: F.variant_get("before", f"$.{c}", "string").alias(f"{c}_before")
    none = lambda c: F.lit(None).cast("string").alias(f"{c}_before")
    out = v.performances.select("table_name", "key", "op", of("title"), of("editorial"), none("performance_id"))
    for other in (v.listings, v.staging):
        out = out.unionByName(other.select("table_name", "key", "op", none("title"), none("editorial"), of("performance_id")))
    return out


def q110_verdicts_undone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings after all verdicts and after taking them back: they are what they were."""
    v, (_, lists, _) = _verdicts(spark, sf_dir)
    done = cut_lineage(v.listings, "changes")
    return changes.apply_changes(changes.apply_changes(lists, done, "id"), changes.undo(done), "id")


# the merges one after another: where each part is, and by which merges it came there
_PLAYED = f"""
with recursive {SQL}, p0 as (select p_partkey::varchar as id, p_name as title, case when p_partkey % 4 = 0 then 'editor ' || p_partkey end as editorial from part),
l0 as (select min(id) as id, work_id::varchar as performance_id, source_id::varchar as source_id from listings group by work_id, source_id),
s0 as (select id::varchar as id, work_id::varchar as performance_id from performances),
m as (select p_partkey * 7919 % 1000003 as seq, p_partkey - 1 - p_size % 4 as dropped, p_partkey as kept from part where p_partkey % 2 = 0 and p_partkey - 1 - p_size % 4 >= 0),
o as (select *, row_number() over (order by seq, dropped::varchar, kept::varchar) as n from m),
start as (select list(k order by k) as place, list([]::bigint[] order by k) as way from (select distinct unnest([dropped, kept]) as k from m)),
ks as (select list(k order by k) as ks from (select distinct unnest([dropped, kept]) as k from m)),
play as (
  select 0::bigint as n, place, way from start
  union all
  select o.n, list_transform(place, lambda x: case when x = dp then kp else x end),
    list_transform(range(1, len(place) + 1), lambda i: case when place[i] = dp and dp <> kp then [o.seq::bigint] || way[i] else way[i] end)
  from (select q.n + 1 as nn, q.place, q.way, x.*, q.place[list_position(ks, x.dropped)] as dp, q.place[list_position(ks, x.kept)] as kp from play q join o x on x.n = q.n + 1, ks) o),
final as (select unnest(ks) as id, unnest(place) as keep_id, unnest(way) as way from (select * from play order by n desc limit 1), ks),
g as (select id::varchar as id, keep_id::varchar as keep_id, way from final where id <> keep_id or keep_id in (select keep_id from final where id <> keep_id)),
inv as (select l.*, keep_id, way from l0 l join g on l.performance_id = g.id),
stay as (select keep_id, source_id, arg_min(id, (way, id)) as id from inv group by all),
l1 as (select id, keep_id as performance_id, source_id from inv where id in (select id from stay) union all select * from l0 where performance_id not in (select id from g)),
wrong as (select coalesce(keep_id, performance_id) as of_id, l.id from l0 l left join g on l.performance_id = g.id where performance_id::bigint % 3 = 0 and source_id::bigint % 7 = 0),
l2 as (select l.*, w.id is not null as ignored from l1 l left join wrong w on l.id = w.id and l.performance_id = w.of_id),
p1 as (select p.id, title, coalesce((select arg_min(q.editorial, h.way) from g h join p0 q on q.id = h.id where h.keep_id = p.id and q.editorial is not null), p.editorial) as editorial from p0 p where p.id not in (select id from g where id <> keep_id)),
s1 as (select s.id, coalesce(keep_id, performance_id) as performance_id from s0 s left join g on s.performance_id = g.id)"""

Q108 = f"""{_PLAYED}
select 'performances' as kind, id, null as performance_id, null as source_id, editorial as value from p1
union all select 'listings', id, performance_id, source_id, ignored::varchar from l2
union all select 'staging', id, performance_id, null, null from s1"""

Q109 = f"""{_PLAYED}
select 'performances' as table_name, p.id as key, case when q.id is null then 'delete' else 'update' end as op, p.title as title_before, p.editorial as editorial_before, null as performance_id_before
from p0 p left join p1 q using (id) where q.id is null or p.editorial is distinct from q.editorial
union all select 'listings', a.id, case when b.id is null then 'delete' else 'update' end, null, null, a.performance_id from l0 a left join l2 b using (id) where b.id is null or a.performance_id <> b.performance_id or b.ignored
union all select 'staging', a.id, 'update', null, null, a.performance_id from s0 a join s1 b using (id) where a.performance_id <> b.performance_id"""

Q110 = f"""with {SQL} select min(id) as id, work_id::varchar as performance_id, source_id::varchar as source_id, false as ignored from listings group by work_id, source_id"""

def q112_queue_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review queue, a case a row, with the performances it names and who lists them in which rank."""
    held, pairs, conflicts = _cases(spark, sf_dir)
    queue = duplicates.review_queue(held, pairs, conflicts, TODAY, limit=150)
    of = lambda df, kind, place, who: df.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), F.lit(place).alias("place"), who.alias("performance_id"))
    k = F.col("id")
    mentions = of(held, "held", 0, k + 1).unionByName(of(held, "held", 1, k + 2)).unionByName(of(pairs, "pair", 0, k * 7)).unionByName(of(pairs, "pair", 1, k * 7 + 1)).unionByName(of(conflicts, "conflict", 0, k * 3))
    p = d.performances(spark, sf_dir).where("id % 11 <> 0").select("id", "title", "company_id")
    lists = d.listings(spark, sf_dir)
    out = duplicates.queue_with_evidence(queue, mentions, p, lists.withColumn("ignored", F.col("position") == 5), d.sources(spark, sf_dir), _venues(lists))
    by = lambda x: F.concat_ws("/", x["listing_id"], x["source"].cast("string"), x["rank"].cast("string"), x["title"], x["time_tbc"].cast("string"))
    line = lambda e: F.concat_ws(" ", e["place"].cast("string"), e["id"].cast("string"), e["title"], F.array_join(F.coalesce(F.transform(e["listed_by"], by), F.array()), ","))
    return out.select("kind", "id", "reason", F.greatest(F.coalesce(F.size("evidence"), F.lit(0)), F.lit(0)).alias("n"), F.array_join(F.transform("evidence", line), "; ").alias("evidence"))


Q112 = f"""with {SQL}, {_VENUES}, k as (select 'held' as kind, o_orderkey as id, o_orderdate::date as day, 'possible match' as reason from orders
union all select 'pair', p_partkey, null, p_type from part union all select 'conflict', s_suppkey, null, 'time' from supplier),
q as (select kind, id, reason from k where id % 10 <> 0 qualify row_number() over (partition by kind order by day, id) <= 150),
m as (select *, 0 as place, case kind when 'held' then id + 1 when 'pair' then id * 7 else id * 3 end as pid from q union all select *, 1, case kind when 'held' then id + 2 else id * 7 + 1 end from q where kind <> 'conflict'),
p as (select id, title, company_id from performances where id % 11 <> 0),
x as (select l.* exclude (company_id), coalesce(l.company_id, p.company_id) as company_id from listings l join p on p.id = l.performance_id where position <> 5),
r as (select l.performance_id, string_agg(concat_ws('/', l.id, l.source_id, {_RANK}, l.title, l.time_tbc), ',' order by l.id) as listed from x l left join sources s on s.id = l.source_id left join venues v on v.source_id = l.source_id and v.theater_id = l.theater_id group by l.performance_id),
e as (select kind, m.id, count(*) as n, string_agg(concat_ws(' ', place, p.id, p.title, coalesce(r.listed, '')), '; ' order by place) as evidence from m join p on p.id = m.pid left join r on r.performance_id = p.id group by kind, m.id)
select q.kind, q.id::varchar as id, reason, coalesce(n, 0) as n, evidence from q left join e using (kind, id) where q.kind <> 'pair' or n = 2"""


def q113_undecided_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate pairs that nobody has decided on: those of some sums of ids were decided, one or the other way round."""
    rows = _part_rows(spark, sf_dir)
    a, b = F.col("a_id"), F.col("b_id")
    decided = duplicates.find_duplicate_candidates(rows).where((a + b) % 3 == 0).select(F.when(a % 2 == 0, a).otherwise(b).alias("drop_id"), F.when(a % 2 == 0, b).otherwise(a).alias("keep_id"))
    return duplicates.find_duplicate_candidates(rows, decided=decided)


Q113 = f"with {_PARTS} select a_id, b_id, reason from found where (a_id + b_id) % 3 <> 0"

QUERIES = {f.__name__: f for f in (q108_verdict_tables, q109_verdict_snapshots, q110_verdicts_undone, q112_queue_evidence, q113_undecided_pairs)}
ORACLE = {"q108_verdict_tables": Q108, "q109_verdict_snapshots": Q109, "q110_verdicts_undone": Q110, "q112_queue_evidence": Q112, "q113_undecided_pairs": Q113}
