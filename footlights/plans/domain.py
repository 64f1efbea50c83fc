"""The star-schema tables as the engine's domain: what orders, line items, suppliers and parts stand for.

orders are performances, line items are listings, suppliers are sources and companies, customers are theaters, parts are
works, brands are choreographers and programmes. ``SQL`` holds the same views as SQL text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The moment of all registered queries.
AS_OF = dt.datetime(2000, 1, 1)
TODAY = AS_OF.date()

#: A zone for each region (fixed values of this binding).
ZONES = {"AFRICA": "Africa/Cairo", "AMERICA": "America/New_York", "ASIA": "Asia/Tokyo", "EUROPE": "Europe/Paris", "MIDDLE EAST": "Asia/Dubai"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; local timestamps become instants (the session zone is UTC)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def theaters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    zone = F.lit(None).cast("string")
    for k, z in enumerate(ZONES.values()):
        zone = F.when(F.col("n_regionkey") == k, z).otherwise(zone)
    stamp = F.timestamp_seconds(F.col("c_custkey") * 3600)
    return rows.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 10 != 0, F.lower("c_name")).alias("slug"), F.col("n_name").alias("city"), F.col("r_name").alias("country"),
        F.when(F.col("c_acctbal") >= 0, zone).alias("timezone"), stamp.alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"),
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    kind = F.when(k % 50 == 0, "Editor").when(k % 5 == 1, "Festival").when(k % 5 == 2, "Dance company").otherwise("Opera house")
    return table(spark, sf_dir, "supplier").select(
        k.alias("id"), F.col("s_name").alias("name"), kind.alias("kind"), F.when(k % 7 != 0, (k % 4).cast("int")).alias("priority"), k.alias("company_id"), (k % 7 != 0).alias("venue_source"), F.col("s_nationkey").alias("nation")
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lower("s_name").alias("slug"), F.timestamp_seconds(F.col("s_suppkey") * 60).alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("k"))
    return rows.select(F.col("p_brand").alias("id"), F.col("p_brand").alias("name"), F.col("p_brand").alias("title"), F.lower("p_brand").alias("slug"), F.timestamp_seconds("k").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by order, line, part and supplier, with what their site states; empty statements are null.

    They are dealt by part, by which they are both grouped and joined, so they move once."""
    rows = table(spark, sf_dir, "lineitem").repartition("l_partkey").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(
        *[F.min(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]
    )
    rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    some = lambda cond, c: F.when(cond, c)
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.col("l_orderkey").alias("performance_id"), F.col("l_suppkey").alias("source_id"), F.col("l_linenumber").alias("position"),
        some(F.col("l_discount") > 0, F.col("p_brand")).alias("theater_id"), some(F.col("l_tax") > 0, F.col("l_shipdate")).alias("starts_at"), (F.col("l_returnflag") == "R").alias("time_tbc"), F.lit("UTC").alias("timezone"),
        some(F.col("l_quantity") > 25, F.concat(F.lit("https://tickets.example.com/"), F.col("l_linenumber").cast("string"))).alias("ticket_url"), F.col("p_name").alias("title"), F.lit(None).cast("string").alias("original_title"),
        F.col("l_partkey").alias("work_id"), F.col("p_brand").alias("choreographer_id"), F.lit(None).cast("string").alias("program_id"), F.col("l_linenumber").alias("program_position"), some(F.col("l_discount") <= 0.05, F.col("l_suppkey")).alias("company_id"),
        F.lit(None).cast("string").alias("image_url"), F.col("p_type").alias("description"), (F.col("l_returnflag") == "A").alias("cancelled"), F.lit(False).alias("ignored"), (F.col("l_linestatus") == "O").alias("generic"), F.col("l_shipdate").alias("last_seen_at"),
    )


def performances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the part and supplier of their first line."""
    first = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f"))
    rows = table(spark, sf_dir, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(table(spark, sf_dir, "part"), F.col("f.l_partkey") == F.col("p_partkey"), "left")
    tags = F.array_compact(F.array(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 7 == 0, "Time TBC"), F.when(F.col("o_orderstatus") == "F", "Cancelled")))
    return rows.select(
        F.col("o_orderkey").alias("id"), F.coalesce("p_name", F.lit("untitled")).alias("title"), F.col("o_custkey").alias("theater_id"), F.col("f.l_suppkey").alias("company_id"), F.col("f.l_partkey").alias("work_id"),
        F.col("p_brand").alias("choreographer_id"), F.when(F.col("o_orderkey") % 3 != 0, F.col("p_brand")).alias("program_id"), F.col("f.l_linenumber").alias("program_position"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))).alias("performance_date"), F.lit(None).cast("string").alias("timezone"), F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("country"), tags.alias("tags"),
    )


_ZONE_SQL = "case r_regionkey " + " ".join(f"when {k} then '{z}'" for k, z in enumerate(ZONES.values())) + " end"

#: The same views in SQL.
SQL = f"""
theaters as (select c_custkey as id, c_name as name, case when c_custkey % 10 <> 0 then lower(c_name) end as slug, n_name as city, r_name as country,
  case when c_acctbal >= 0 then {_ZONE_SQL} end as timezone, to_timestamp(c_custkey * 3600) as created_at
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
sources as (select s_suppkey as id, s_name as name, case when s_suppkey % 50 = 0 then 'Editor' when s_suppkey % 5 = 1 then 'Festival' when s_suppkey % 5 = 2 then 'Dance company' else 'Opera house' end as kind,
  case when s_suppkey % 7 <> 0 then s_suppkey % 4 end as priority, s_suppkey as company_id, s_suppkey % 7 <> 0 as venue_source, s_nationkey as nation from supplier),
grouped as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, min(l_quantity) as l_quantity, min(l_discount) as l_discount, min(l_tax) as l_tax, min(l_returnflag) as l_returnflag,
  min(l_linestatus) as l_linestatus, min(l_shipdate) as l_shipdate from lineitem group by all),
listings as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id, l_orderkey as performance_id, l_suppkey as source_id, l_linenumber as position,
  case when l_discount > 0 then p_brand end as theater_id, case when l_tax > 0 then l_shipdate end as starts_at, l_returnflag = 'R' as time_tbc,
  case when l_quantity > 25 then 'https://tickets.example.com/' || l_linenumber end as ticket_url, p_name as title, l_partkey as work_id, p_brand as choreographer_id, l_linenumber as program_position,
  case when l_discount <= 0.05 then l_suppkey end as company_id, p_type as description, l_returnflag = 'A' as cancelled, l_linestatus = 'O' as generic, l_shipdate as last_seen_at
  from grouped join part on l_partkey = p_partkey),
first_line as (select l_orderkey, min({{'n': l_linenumber, 'p': l_partkey, 's': l_suppkey}}) as f from lineitem group by 1),
performances as (select o_orderkey as id, coalesce(p_name, 'untitled') as title, o_custkey as theater_id, f.s as company_id, f.p as work_id, p_brand as choreographer_id,
  case when o_orderkey % 3 <> 0 then p_brand end as program_id, f.n as program_position, o_orderdate + to_minutes(cast(o_orderkey % 1440 as int)) as performance_date,
  o_orderkey % 7 = 0 as tbc, o_orderstatus = 'F' as cancelled, o_orderpriority as tag
  from orders left join first_line on o_orderkey = l_orderkey left join part on f.p = p_partkey)
"""
