"""Dimensions of staging rows: found by name, or made anew in one batch as a run over the rows in order would make them.

All rules are sets: new names are brought to one key, the row with the least id makes the entry, and an entry's id is a
digest of its key, so a second run finds what the first has made. Ids are texts in all results.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, holds, overlap, slugify, trigrams
from .graph import cut_lineage
from .link import resolve_dimension, resolve_work
from .survive import is_venue_source

DIMENSIONS = ("theater_id", "company_id", "choreographer_id", "work_id", "program_id")


@dataclass(frozen=True)
class Resolved:
    """``rows``: staging with all dimension ids and ``notes``; new entries of each dimension; new names of known venues."""

    rows: DataFrame
    theaters: DataFrame
    companies: DataFrame
    choreographers: DataFrame
    works: DataFrame
    programs: DataFrame
    aliases: DataFrame


def new_id(kind: str, *key: Column) -> Column:
    """An id made from a key; null parts of the key count as such."""
    return F.concat(F.lit(f"{kind}-"), F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), k), F.lit("-")) for k in key])))


def _key(name: Column) -> Column:
    """A name's slug; names without a letter or digit are told apart by their text."""
    slug = slugify(name)
    return F.when(slug != "", slug).otherwise(F.concat(F.lit("="), F.lower(F.trim(name))))


def _place(city: str = "city", country: str = "country") -> Column:
    return F.coalesce(F.nullif(F.concat_ws(", ", city, country), F.lit("")), F.lit("Unknown"))


def _made_before(rows: DataFrame, dimension: DataFrame, found: str, own: Column) -> DataFrame:
    """``found`` also where an entry has the id that the key would get: names without a letter are found again by it."""
    same = dimension.select(F.col("id").cast("string").alias("_same"))
    return rows.withColumn("_own", own).join(same, F.col("_own") == F.col("_same"), "left").withColumn(found, F.coalesce(F.col(found).cast("string"), "_same")).drop("_own", "_same")


def leaders(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(key, leads)``: which nodes a pass in order would make leaders, a node next to an earlier leader being none.

    nodes: key, free (false: never a leader); edges: early, late, keys of neighbours in order. Each round settles every
    node whose earlier neighbours are settled enough; rounds grow with the longest chain of neighbours, not with the rows.
    """
    state = cut_lineage(nodes.select("key", F.when(~F.col("free"), F.lit(False)).alias("leads")), "leaders")
    while not state.where("leads is null").isEmpty():
        told = edges.join(state.withColumnsRenamed({"key": "early"}), "early").groupBy(F.col("late").alias("key"))
        told = told.agg(F.coalesce(F.max("leads"), F.lit(False)).alias("led"), F.max(F.col("leads").isNull()).alias("waits"))
        settled = F.when(F.coalesce("led", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        state = cut_lineage(state.join(told, "key", "left").select("key", F.coalesce("leads", settled).alias("leads")), "leaders")
    return state


def resolve_venues(rows: DataFrame, theaters: DataFrame, least: float = 0.6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(id, theater_id, note)`` of rows(id, venue, city, country, timezone) with a venue, new theaters, and new aliases.

    A slug of a name or alias decides; else the first row with the venue's slug decides for all: the closest name in its
    city (similar by ``least``, or one holds the other), known or made by an earlier row, takes the venue as an alias;
    else the row makes a theater.
    """
    rows = rows.where(filled(F.col("venue")).isNotNull())
    exact = resolve_dimension(rows, theaters, "venue", "_exact").withColumn("key", _key(F.col("venue")))
    exact = cut_lineage(_made_before(exact, theaters, "_exact", new_id("venue", F.col("key"))), "venues")
    opened = exact.where("_exact is null")
    first = opened.groupBy("key").agg(F.min_by(F.struct("id", "venue", "city", "country", "timezone"), "id").alias("f")).select("key", "f.*")
    first = cut_lineage(first.withColumn("near", F.lower("city")).withColumn("slug", slugify(F.col("venue"))).withColumn("grams", trigrams(F.col("slug"))), "first")
    score = overlap(F.col("a_grams"), F.col("grams"))
    close = (score >= least) | holds(F.col("a_slug"), F.col("slug")) | holds(F.col("slug"), F.col("a_slug"))
    known = theaters.select(F.col("id").cast("string").alias("a_key"), slugify(F.col("name")).alias("a_slug"), F.lower("city").alias("near")).where("a_slug <> ''").withColumn("a_grams", trigrams(F.col("a_slug")))
    likes = lambda earlier, cond: first.where("slug <> ''").join(earlier, "near").where(close & cond).select("key", "a_key", score.alias("score"))
    to_known = cut_lineage(likes(known, F.lit(True)), "close")
    made = first.where("slug <> ''").select(F.col("key").alias("a_key"), F.col("slug").alias("a_slug"), "near", F.col("grams").alias("a_grams"), F.col("id").alias("a_id"))
    to_made = cut_lineage(likes(made, F.col("a_id") < F.col("id")), "close")
    free = first.join(to_known.select("key").distinct().withColumn("taken", F.lit(True)), "key", "left").select("key", F.col("taken").isNull().alias("free"))
    led = leaders(free, to_made.select(F.col("a_key").alias("early"), F.col("key").alias("late")))
    own = new_id("venue", F.col("key"))
    from_made = to_made.join(led.where("leads").select(F.col("key").alias("a_key")), "a_key").select("key", new_id("venue", F.col("a_key")).alias("a_key"), "score")
    best = to_known.unionByName(from_made).groupBy("key").agg(F.max_by("a_key", F.struct("score", "a_key")).alias("to"))
    chosen = first.join(led, "key").join(best, "key", "left").select("key", F.col("id").alias("first_id"), "venue", "city", "country", "timezone", "leads", F.when(F.col("leads"), own).otherwise(F.col("to")).alias("to"))
    chosen = cut_lineage(chosen, "chosen")
    told = exact.select("id", "venue", "_exact", "key").join(chosen.select("key", "first_id", "leads", "to"), "key", "left")
    note = F.when(F.col("id") == F.col("first_id"), F.concat(F.when(F.col("leads"), "new venue: ").otherwise("venue matched by close name: "), F.col("venue")))
    found = told.select("id", F.coalesce(F.col("_exact").cast("string"), "to").alias("theater_id"), F.when(F.col("_exact").isNull(), note).alias("note"))
    new = chosen.where("leads").select(F.col("to").alias("id"), F.trim("venue").alias("name"), _place().alias("location"), "city", "country", "timezone")
    return found, new, chosen.where("not leads").select(F.col("to").alias("theater_id"), F.trim("venue").alias("alias"))


def resolve_names(rows: DataFrame, dimension: DataFrame, column: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(id, found, note)`` of rows with ``column``, and ``(new id, maker)`` of new names: the row that makes each."""
    rows = rows.where(filled(F.col(column)).isNotNull())
    exact = resolve_dimension(rows.select("id", column), dimension, column, "_exact").withColumn("key", _key(F.col(column)))
    exact = cut_lineage(_made_before(exact, dimension, "_exact", new_id(kind, F.col("key"))), kind)
    makers = exact.where("_exact is null").groupBy("key").agg(F.min("id").alias("maker"))
    told = exact.join(makers, "key", "left")
    own = F.when(F.col("_exact").isNull(), new_id(kind, F.col("key")))
    note = F.when(F.col("id") == F.col("maker"), F.concat(F.lit(f"new {kind}: "), column))
    return told.select("id", F.coalesce(F.col("_exact").cast("string"), own).alias("found"), F.when(F.col("_exact").isNull(), note).alias("note")), makers.select(new_id(kind, F.col("key")).alias("new_id"), "maker")


def resolve_works(rows: DataFrame, works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for works of rows(id, work, work_is_story, choreographer_id): known ones as ``resolve_work`` finds them.

    A work without choreographer fits every row of its title, one with a choreographer that choreographer's rows and rows
    without one. So for each title it matters when the first work without choreographer is made (by a story, or by the
    title's first row if it has none): earlier rows make one work a choreographer, later ones take what is there.
    """
    rows = rows.where(filled(F.col("work")).isNotNull()).withColumn("story", F.coalesce("work_is_story", F.lit(False)))
    known = resolve_work(rows, works, "_known").withColumn("key", _key(F.col("work"))).withColumn("who", F.when(~F.col("story"), F.col("choreographer_id")))
    known = cut_lineage(_made_before(known, works, "_known", new_id("work", F.col("key"), F.col("who"))), "works")
    opened = known.where("_known is null")
    titles = opened.groupBy("key").agg(F.min_by(F.struct("id", "who"), "id").alias("f"), F.min(F.when(F.col("story"), F.col("id"))).alias("t_story"))
    free = F.when(F.col("f.who").isNull(), F.col("f.id"))  # the first row has no choreographer, a story or not
    titles = titles.select("key", F.col("f.who").alias("first_who"), F.least("t_story", free).alias("t_free"))
    own = opened.where("who is not null").groupBy("key", "who").agg(F.min("id").alias("maker"))
    own = own.join(titles, "key").where("t_free is null or maker < t_free").select("key", "who", "maker")
    made = cut_lineage(own.unionByName(titles.where("t_free is not null").select("key", F.lit(None).cast("string").alias("who"), F.col("t_free").alias("maker"))), "made")
    of_who = made.where("who is not null").select("key", "who", F.col("maker").alias("own_maker"))
    told = known.join(titles, "key", "left").join(of_who, ["key", "who"], "left")
    # a row without choreographer that is no story takes the title's oldest work
    whose = F.when(F.col("story"), F.lit(None)).when(F.col("who").isNull(), F.col("first_who")).when(F.col("own_maker").isNotNull(), F.col("who"))
    told = told.withColumn("whose", whose).withColumn("new", F.when(F.col("_known").isNull(), new_id("work", F.col("key"), F.col("whose"))))
    makes = F.when(F.col("whose").isNull(), F.col("id") == F.col("t_free")).otherwise(F.col("id") == F.col("own_maker"))
    found = told.select("id", F.coalesce(F.col("_known").cast("string"), "new").alias("found"), F.when(F.col("new").isNotNull() & makes, F.concat(F.lit("new work: "), "work")).alias("note"))
    return found, made.select(new_id("work", F.col("key"), F.col("who")).alias("new_id"), "maker", "who")


def resolve_programs(rows: DataFrame, programs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for programmes of rows(id, program, company_id): a company's own, or any for a row without company."""
    rows = rows.where(filled(F.col("program")).isNotNull()).withColumn("key", _key(F.col("program")))
    p = programs.select(F.col("id").cast("string").alias("_p"), _key(F.col("title")).alias("key"), F.col("company_id").cast("string").alias("_c"), F.col("created_at").alias("_at"))
    fits = F.col("company_id").isNull() | F.col("company_id").eqNullSafe(F.col("_c"))
    best = rows.select("id", "key", "company_id").join(p, "key").where(fits).groupBy("id").agg(F.min_by("_p", F.struct("_at", "_p")).alias("_known"))
    known = cut_lineage(rows.join(best, "id", "left"), "programs")
    opened = known.where("_known is null")
    first = opened.groupBy("key").agg(F.min_by(F.struct("id", "company_id"), "id").alias("f"))
    first = first.select("key", F.col("f.id").alias("first_id"), F.col("f.company_id").alias("first_company"))
    own = opened.where("company_id is not null").groupBy("key", F.col("company_id").alias("whose")).agg(F.min("id").alias("maker"))
    made = cut_lineage(own.unionByName(first.where("first_company is null").select("key", F.col("first_company").alias("whose"), F.col("first_id").alias("maker"))), "made")
    told = known.join(first, "key", "left").withColumn("whose", F.coalesce("company_id", "first_company"))
    told = told.join(made.withColumnsRenamed({"key": "_k", "whose": "_w"}), (F.col("key") == F.col("_k")) & F.col("whose").eqNullSafe(F.col("_w")), "left")
    new = F.when(F.col("_known").isNull(), new_id("program", F.col("key"), F.col("whose")))
    note = F.when(F.col("_known").isNull() & (F.col("id") == F.col("maker")), F.concat(F.lit("new program: "), "program"))
    return told.select("id", F.coalesce("_known", new).alias("found"), note.alias("note")), made.select(new_id("program", F.col("key"), F.col("whose")).alias("new_id"), "maker", F.col("whose").alias("who"))


def resolve_dimensions(staging: DataFrame, theaters: DataFrame, companies: DataFrame, choreographers: DataFrame, works: DataFrame, programs: DataFrame, sources: DataFrame, as_of: dt.datetime) -> Resolved:
    """All dimensions of a batch of staging rows, in the order in which they depend on each other.

    staging: id, source_id, venue, city, country, timezone, company, choreographer, choreographer_nationality, work,
    work_is_story, program, tags, genre, and any dimension ids that are known (they win). A row without a venue takes that
    of a source that is a venue, one without a company its source's. sources: id, kind, theater_id, company_id.
    """
    text = lambda c: (F.col(c) if c in staging.columns else F.lit(None)).cast("string")
    s = sources.select(F.col("id").alias("_s"), F.when(is_venue_source(F.col("kind")), F.col("theater_id").cast("string")).alias("_theater"), F.col("company_id").cast("string").alias("_company"))
    rows = staging.withColumns({c: text(c) for c in DIMENSIONS}).join(s, F.col("source_id") == F.col("_s"), "left")
    rows = rows.withColumn("theater_id", F.coalesce("theater_id", F.when(filled(F.col("venue")).isNull(), F.col("_theater")))).withColumn("company_id", F.coalesce("company_id", F.when(filled(F.col("company")).isNull(), F.col("_company")))).drop("_s", "_theater", "_company")
    rows = cut_lineage(rows.withColumn("notes", F.array().cast("array<string>")), "staged")

    def add(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
        told = found.toDF("_id", "_found", "_note")
        out = rows.join(told, F.col("id") == F.col("_id"), "left").withColumn(column, F.coalesce(column, "_found"))
        return cut_lineage(out.withColumn("notes", F.concat("notes", F.array_compact(F.array("_note")))).drop("_id", "_found", "_note"), "staged")

    makers = lambda new, *columns: new.join(staging.select(F.col("id").alias("maker"), *columns), "maker")
    found, new_theaters, aliases = resolve_venues(rows.where("theater_id is null").select("id", "venue", "city", "country", "timezone"), theaters)
    rows = add(rows, found, "theater_id")
    found, made = resolve_names(rows.where("company_id is null"), companies, "company", "company")
    rows = add(rows, found, "company_id")
    new_companies = makers(made, "company", "city", "country").select(F.col("new_id").alias("id"), F.trim("company").alias("name"), _place().alias("location"), "city", "country")
    found, made = resolve_names(rows.where("choreographer_id is null"), choreographers, "choreographer", "choreographer")
    rows = add(rows, found, "choreographer_id")
    new_people = makers(made, "choreographer", "choreographer_nationality").select(F.col("new_id").alias("id"), F.trim("choreographer").alias("name"), F.coalesce(filled(F.col("choreographer_nationality")), F.lit("Unknown")).alias("nationality"))
    known_works = works.select(F.col("id").cast("string").alias("id"), "title", F.col("choreographer_id").cast("string").alias("choreographer_id"), "created_at")
    found, made = resolve_works(rows.where("work_id is null").select("id", "work", "work_is_story", "choreographer_id"), known_works)
    rows = add(rows, found, "work_id")
    genre = F.when(F.col("genre").isNotNull(), F.array("genre"))
    new_works = makers(made, "work", "tags", "genre").select(F.col("new_id").alias("id"), F.trim("work").alias("title"), F.col("who").alias("choreographer_id"), F.coalesce("tags", genre).alias("tags"))
    found, made = resolve_programs(rows.where("program_id is null").select("id", "program", "company_id"), programs)
    rows = add(rows, found, "program_id")
    new_programs = makers(made, "program").select(F.col("new_id").alias("id"), F.trim("program").alias("title"), F.col("who").alias("company_id"))
    stamp = lambda df: df.withColumn("created_at", F.lit(as_of))
    return Resolved(rows, *map(stamp, (new_theaters, new_companies, new_people, new_works, new_programs)), aliases)
