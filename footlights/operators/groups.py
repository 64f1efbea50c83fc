"""Evenings: keys, header rows, ordered groups, the evening view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key_of, piece_title, unaccent
from ..functions.times import minute_of


def evening_key(program: Column, own: Column, theater: Column, starts_at: Column) -> Column:
    """md5 of programme (or the own id), theater and minute."""
    return key_of(F.coalesce(program.cast("string"), own.cast("string")), theater, F.date_format(minute_of(starts_at), "yyyy-MM-dd HH:mm"))


def header_flags(rows: DataFrame) -> DataFrame:
    """Add ``is_header`` to rows of evenings.

    rows: id, ek, ptitle (piece title), program_title, work_id, program_position, choreographer_id, choreographer_kind,
    member_ids. A header bears the programme's title, has no work of its own or one that another row shares, and has no
    position, no choreographer, a credit line, or people whom a row with another title holds (nobody is held by anybody).
    Both tests are windows over the evening, so rows move once, and not at all where they are dealt by ``ek`` already.
    """
    titled = F.coalesce(F.lower("ptitle") == F.lower("program_title"), F.lit(False))
    other = F.coalesce(F.lower("ptitle") != F.lower("program_title"), F.lit(False)) & F.col("choreographer_id").isNotNull() & F.col("ek").isNotNull()
    members = F.coalesce("member_ids", F.array().cast(rows.schema["member_ids"].dataType))
    shared = F.count("*").over(Window.partitionBy("ek", "work_id"))
    # a row that bears the title is no other row, so none is compared with itself
    holders = F.collect_set(F.when(other, members)).over(Window.partitionBy("ek"))
    out = rows.withColumn("_n", shared).withColumn("_holders", holders)
    free = F.col("work_id").isNull() | (F.col("ek").isNotNull() & (F.col("_n") > 1))
    held = F.exists("_holders", lambda m: F.size(F.array_except(members, m)) == 0)
    loose = F.col("program_position").isNull() | F.col("choreographer_id").isNull() | F.coalesce(F.col("choreographer_kind") == "credit_line", F.lit(False)) | held
    return out.withColumn("is_header", titled & free & loose).select(*rows.columns, "is_header")


def group_evenings(rows: DataFrame) -> DataFrame:
    """One row for each evening with several rows, by one aggregation: a list of the evening's rows, read in order.

    rows: those of ``header_flags`` and starts_at, created_at, ticket_url, image_url, description, company_id, cancelled,
    tags, editorial, credit_line, member_names, work_title. Order: headers last, position (none last), start, created, id.
    """
    position = F.coalesce(F.col("program_position"), F.lit(2**31 - 1))
    more = F.lower(unaccent(F.concat_ws(" ", "ptitle", "credit_line", "member_names", "work_title")))
    row = F.struct(F.col("is_header").alias("h"), position.alias("p"), "starts_at", "created_at", "id", "member_ids", "ticket_url", "image_url", "description", "company_id", "tags", "editorial", "credit_line", more.alias("more"))
    out = rows.groupBy("ek").agg(F.count("*").alias("n_rows"), F.sort_array(F.collect_list(row)).alias("_rows"), F.every("cancelled").alias("cancelled")).where("n_rows > 1")
    every = lambda c: F.transform("_rows", lambda x: x[c])
    known = lambda c: F.filter(every(c), lambda x: x.isNotNull())
    first = lambda c, name: F.get(known(c), F.lit(0)).alias(name)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(known(c)))).cast("array<string>")
    # headers come last, so the others are in the order of pieces, and so are headers where there is nothing else
    pieces = F.transform(F.filter("_rows", lambda x: ~x["h"]), lambda x: x["id"])
    return out.select(
        "ek", "n_rows", every("id").alias("performance_ids"), F.array_distinct(F.flatten(known("member_ids"))).alias("choreographer_ids"),
        first("ticket_url", "ticket_url"), first("image_url", "any_image"), first("description", "any_description"), first("company_id", "any_company"), "cancelled",
        union("tags").alias("tags"), union("editorial").alias("editorial"), F.array_join(F.array_sort(F.array_distinct(known("credit_line"))), ", ").alias("credit_lines"),
        F.array_join(every("more"), " ").alias("more_text"), F.when(F.size(pieces) > 0, pieces).otherwise(every("id")).alias("piece_ids"),
    )


def refresh_groups(groups: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Groups after the evenings ``keys(ek)`` changed: those are made anew, one that is no longer multiple has ``n_rows`` 1.

    One outer join by ``ek`` of the groups, the keys and what is made anew."""
    k = keys.select("ek").distinct()
    fresh = group_evenings(rows.join(k, "ek", "left_semi"))
    old = groups.join(k.withColumn("_named", F.lit(True)), "ek", "left").withColumn("n_rows", F.when(F.col("_named"), F.lit(1).cast("long")).otherwise(F.col("n_rows")))
    both = old.alias("o").join(fresh.alias("f"), F.col("o.ek") == F.col("f.ek"), "full_outer")
    return both.select(*[F.when(F.col("f.ek").isNotNull(), F.col(f"f.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in groups.columns])


def pieces_of(groups: DataFrame, performances: DataFrame, ids: str = "piece_ids") -> DataFrame:
    """Ordered details of a group's pieces: ``(ek, pieces array<struct<pos, ...>>)``; explode, join, regroup by place."""
    facts = [c for c in performances.columns if c != "id"]
    rows = groups.select("ek", F.posexplode(ids).alias("pos", "pid")).join(performances, F.col("pid") == F.col("id"))
    return rows.groupBy("ek").agg(F.array_sort(F.collect_list(F.struct("pos", "id", *facts))).alias("pieces"))


def evening_listing(listing: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per evening: the group's values where there is one, else the listing's own.

    listing (view rows): id, ek, title, program_title, tags, editorial, ticket_url, image_url, description, cancelled,
    search_text, choreographer_ids and more, which stay. The shown row of a group is its first performance.
    """
    g = groups.where("n_rows > 1").select(*[F.col(c).alias(f"g_{c}") for c in groups.columns])
    rows = listing.join(g, F.col("ek") == F.col("g_ek"), "left")
    rows = rows.where(F.col("g_ek").isNull() | (F.get("g_performance_ids", F.lit(0)) == F.col("id")))
    title = F.when(F.col("g_ek").isNotNull() & F.col("program_title").isNotNull(), F.col("program_title")).otherwise(piece_title(F.col("title"), F.col("program_title")))
    new = {
        "title": title,
        "tags": F.coalesce("g_tags", "tags"),
        "editorial": F.coalesce("g_editorial", "editorial"),
        "ticket_url": F.coalesce("g_ticket_url", "ticket_url"),
        "image_url": F.when(F.col("g_ek").isNotNull(), F.coalesce("g_any_image", "image_url")).otherwise(F.col("image_url")),
        "description": F.when(F.col("g_ek").isNotNull(), F.coalesce("g_any_description", "description")).otherwise(F.col("description")),
        "cancelled": F.coalesce("g_cancelled", "cancelled"),
        "choreographer_ids": F.coalesce("g_choreographer_ids", "choreographer_ids"),
        "search_text": F.concat_ws(" ", "search_text", "g_more_text"),
    }
    kept = [new[c].alias(c) if c in new else F.col(c) for c in listing.columns]
    return rows.select(*kept, F.coalesce(F.size("g_piece_ids"), F.lit(1)).alias("piece_count"), F.coalesce("g_performance_ids", F.array("id")).alias("performance_ids"), F.coalesce("g_n_rows", F.lit(1)).alias("n_rows"))


def same_piece_twice(rows: DataFrame) -> DataFrame:
    """Ids of one piece given twice in a bill, in order of creation; the first stays: ``(program_id, ids)``."""
    from ..functions.text import slugify

    keyed = rows.withColumn("slug", slugify(F.col("title"))).withColumn("minute", minute_of(F.col("starts_at")))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("created_at", "id"))), lambda x: x["id"])
    return keyed.groupBy("program_id", "theater_id", "minute", "slug", "choreographer_id").agg(ids.alias("ids")).where(F.size("ids") > 1).select("program_id", "ids")
