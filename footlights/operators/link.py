"""Linking staged rows to published ones: dimensions, the match ladder, publishing in two passes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import filled, holds, overlap, similarity, slugify, title_close, trigrams, without_bracket
from ..functions.times import DEFAULT_ZONE, local_date, minute_of, start_instant, time_known
from .graph import cluster, cut_lineage


def reject_incomplete(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split staging into (usable, rejected with ``reason``): a row needs a title or a work, and a date."""
    bad = F.coalesce(filled(F.col("title")), filled(F.col("work"))).isNull() | F.col("performance_date").isNull()
    return staging.where(~bad), staging.where(bad).withColumn("reason", F.lit("missing title/work or date"))


def same_run_copies(staging: DataFrame, within_seconds: int = 86_400) -> DataFrame:
    """Rows without venue that the same source also gives with one: same date and title, scraped within a day, and this
    row untimed or the time equal. A semi join on source, date and slug."""
    named = staging.withColumn("_slug", slugify(F.coalesce(filled(F.col("title")), F.col("work"))))
    bare = named.where(filled(F.col("venue")).isNull())
    with_venue = named.where(filled(F.col("venue")).isNotNull()).select(
        F.col("id").alias("_id"), F.col("source_id").alias("_source"), F.col("performance_date").alias("_date"), F.col("_slug").alias("_s"), F.col("scraped_at").alias("_at"), F.col("performance_time").alias("_time")
    )
    untimed = F.coalesce(F.col("time_tbc"), F.lit(False)) | ~time_known(F.col("performance_time"))
    on = (
        (F.col("source_id") == F.col("_source")) & (F.col("performance_date") == F.col("_date")) & (F.col("_slug") == F.col("_s")) & (F.col("id") != F.col("_id"))
        & (F.abs(F.unix_seconds("scraped_at") - F.unix_seconds("_at")) < within_seconds) & (untimed | (F.col("performance_time") == F.col("_time")))
    )
    return bare.join(with_venue, on, "left_semi").drop("_slug")


def apply_suppressions(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows that no rule removes. rules: title_slug, local_date, source_id, theater_id, local_time; a null matches anything.

    Date and slug are the equi keys of the anti join; an untimed row fits any time.
    """
    r = rules.select(*[F.col(c).alias(f"_{c}") for c in ("title_slug", "local_date", "source_id", "theater_id", "local_time")])
    any_or = lambda c: F.col(f"_{c}").isNull() | F.coalesce(F.col(f"_{c}") == F.col(c), F.lit(False))
    on = (F.col("title_slug") == F.col("_title_slug")) & (F.col("local_date") == F.col("_local_date")) & any_or("source_id") & any_or("theater_id")
    return rows.join(r, on & (F.col("local_time").isNull() | any_or("local_time")), "left_anti")


def suppress(performances: DataFrame, listings: DataFrame, reason: str) -> DataFrame:
    """Rules that keep removed shows away: a slug for each listing's source and the own slug for any source.

    performances: id, title, local_date, local_time (null if untimed), theater_id; listings: performance_id, source_id, listed_title.
    """
    base = performances.select(F.col("id").alias("_id"), "local_date", "local_time", "theater_id")
    by_site = listings.join(base, F.col("performance_id") == F.col("_id")).select("source_id", slugify(F.col("listed_title")).alias("title_slug"), "local_date", "local_time", "theater_id")
    own = performances.select(F.lit(None).cast(by_site.schema["source_id"].dataType).alias("source_id"), slugify(F.col("title")).alias("title_slug"), "local_date", "local_time", "theater_id")
    return by_site.unionByName(own).where(F.col("title_slug") != "").distinct().withColumn("reason", F.lit(reason))


def name_keys(dimension: DataFrame, name: str = "name") -> DataFrame:
    """``(slug, id)``: for each slug of a name or alias the id created first (then the least id)."""
    names = F.array_union(F.array(F.col(name)), F.coalesce("aliases", F.array().cast("array<string>")))
    keys = dimension.select("id", "created_at", F.explode(names).alias("n")).select("id", "created_at", slugify(F.col("n")).alias("slug")).where(F.col("slug") != "")
    return keys.groupBy("slug").agg(F.min(F.struct(F.coalesce("created_at", F.lit(dt.datetime(9999, 1, 1))).alias("c"), "id")).alias("m")).select("slug", F.col("m.id").alias("id"))


def resolve_dimension(rows: DataFrame, dimension: DataFrame, column: str, out: str, name: str = "name") -> DataFrame:
    """Add ``out``: the id whose name or alias has the slug of ``column``; null where none fits."""
    keys = name_keys(dimension, name).withColumnsRenamed({"slug": "_slug", "id": out})
    slug = slugify(F.col(column))
    return rows.join(keys, (slug == F.col("_slug")) & (slug != ""), "left").drop("_slug")


def resolve_work(rows: DataFrame, works: DataFrame, out: str = "work_id") -> DataFrame:
    """Add ``out`` by ``work``, ``work_is_story`` and ``choreographer_id``: a story has no choreographer; else the same one
    first, then none; an unknown choreographer fits any. works: id, title, choreographer_id, created_at. Rows need an ``id``."""
    w = works.select(F.col("id").alias("_w"), slugify(F.col("title")).alias("_slug"), F.col("choreographer_id").alias("_c"), F.col("created_at").alias("_at")).where(F.col("_slug") != "")
    # the best work of each title and choreographer (or none) and of each title: a row looks up these, not all of its title
    of_who = w.groupBy("_slug", "_c").agg(F.min(F.struct("_at", "_w")).alias("_best"))
    of_title = of_who.groupBy(F.col("_slug").alias("_t")).agg(F.min("_best").alias("_any"), F.min(F.when(F.col("_c").isNull(), F.col("_best"))).alias("_free"))
    found = rows.withColumn("_s", slugify(F.col("work")))
    found = found.join(of_title, F.col("_s") == F.col("_t"), "left").join(of_who.where("_c is not null"), (F.col("_s") == F.col("_slug")) & (F.col("choreographer_id") == F.col("_c")), "left")
    best = F.when(F.coalesce("work_is_story", F.lit(False)), F.col("_free")).when(F.col("choreographer_id").isNull(), F.col("_any")).otherwise(F.coalesce("_best", "_free"))
    return found.select(*rows.columns, best["_w"].alias(out))


def match_theater(rows: DataFrame, theaters: DataFrame, least: float = 0.6) -> DataFrame:
    """Add ``theater_id`` and ``how`` ('name', 'close name' or null) for ``venue``, ``city``, ``country``.

    An equal slug of name or alias decides first; else the most similar name of the same city (blocked by it), at least
    ``least`` or held in the other. Rows need an ``id``. This behaviour is our own: only the interface is given.
    """
    exact = resolve_dimension(rows, theaters, "venue", "_exact")
    t = theaters.select(F.col("id").alias("_t"), slugify(F.col("name")).alias("_name"), F.lower("city").alias("_city")).where("_name <> ''").withColumn("_grams", trigrams(F.col("_name")))
    open_rows = exact.where(F.col("_exact").isNull() & filled(F.col("venue")).isNotNull()).select(F.col("id").alias("_id"), slugify(F.col("venue")).alias("_venue"), F.lower("city").alias("_at")).withColumn("_own", trigrams(F.col("_venue")))
    score = overlap(F.col("_grams"), F.col("_own"))
    close = open_rows.join(t, F.col("_at") == F.col("_city")).withColumn("_score", score)
    close = close.where((F.col("_score") >= least) | holds(F.col("_name"), F.col("_venue")) | holds(F.col("_venue"), F.col("_name")))
    best = close.groupBy("_id").agg(F.max_by("_t", F.struct("_score", "_t")).alias("_close"))
    out = exact.join(best, F.col("id") == F.col("_id"), "left")
    how = F.when(F.col("_exact").isNotNull(), "name").when(F.col("_close").isNotNull(), "close name")
    return out.withColumn("theater_id", F.coalesce("_exact", "_close")).withColumn("how", how).select(*rows.columns, "theater_id", "how")


def prepare(staging: DataFrame, theaters: DataFrame) -> DataFrame:
    """Columns that the ladder compares: start, local day, minute, city, built title and slugs.

    staging has its dimension ids (theater_id, company_id, work_id); theaters: id, timezone, city. A staging row may know
    its instant (``starts_at``): date and time alone mean the earlier of two in the hour that a clock repeats.
    """
    t = theaters.select(F.col("id").alias("_t"), F.col("timezone").alias("_zone"), F.col("city").alias("_city"))
    rows = staging.join(t, F.col("theater_id") == F.col("_t"), "left")
    zone = F.coalesce("_zone", "timezone", F.lit(DEFAULT_ZONE))
    tbc = F.coalesce("time_tbc", F.lit(False)) | ~time_known(F.col("performance_time"))
    base = F.coalesce(filled(F.col("title")), F.trim("work"))
    suffix = F.concat(F.lit(" ("), F.trim("program"), F.lit(")"))
    built = F.when(F.col("program").isNotNull() & ~F.endswith(base, suffix), F.concat(base, suffix)).otherwise(base)
    start = start_instant(F.col("performance_date"), F.when(~tbc, F.col("performance_time")), zone, F.col("program_position"), F.col("program").isNotNull())
    if "starts_at" in staging.columns:
        start = F.coalesce(F.when(~tbc, F.col("starts_at")), start)
    rows = rows.select(
        "id", "source_id", "theater_id", "company_id", "work_id", "skip_fuzzy" if "skip_fuzzy" in staging.columns else F.lit(False).alias("skip_fuzzy"),
        F.coalesce("_city", filled(F.col("city"))).alias("city"), zone.alias("zone"), tbc.alias("tbc"), built.alias("title"), start.alias("starts_at"),
        F.col("performance_date").alias("day"), slugify(F.col("title")).alias("raw_slug"),
    )
    return _with_keys(rows)


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slug", slugify(F.col("title"))).withColumn("minute", minute_of(F.col("starts_at")))


def published_side(performances: DataFrame, theaters: DataFrame) -> DataFrame:
    """Published rows in the form the ladder joins: performances(id, title, theater_id, company_id, work_id, performance_date, timezone, tags, city)."""
    t = theaters.select(F.col("id").alias("_t"), F.col("timezone").alias("_zone"), F.col("city").alias("_city"))
    rows = performances.join(t, F.col("theater_id") == F.col("_t"), "left")
    zone = F.coalesce("_zone", "timezone", F.lit(DEFAULT_ZONE))
    rows = rows.select(
        "id", F.lit(None).cast("string").alias("source_id"), "theater_id", "company_id", "work_id", F.lit(False).alias("skip_fuzzy"), F.coalesce("_city", "city").alias("city"), zone.alias("zone"),
        F.coalesce(F.array_contains("tags", "Time TBC"), F.lit(False)).alias("tbc"), "title", F.col("performance_date").alias("starts_at"), local_date(F.col("performance_date"), zone).alias("day"), slugify(F.col("title")).alias("raw_slug"),
    )
    return _with_keys(rows)


def link_staging(staging: DataFrame, published: DataFrame, earlier_only: bool = False) -> DataFrame:
    """The match ladder: ``(id, step, action, performance_id, candidates)`` for every staging row, the first rule that hits.

    Both sides come from ``prepare`` / ``published_side``. Every rule is an equi join (venue and minute, venue and day,
    company and minute, city and day with company, work or title) with the rest as a residual, tagged with its step; one
    aggregation picks the step. Titles are compared once a city and day, not once a pair of rows.
    Step 5 may hold a row: ``candidates`` then lists them, strong ones first, then by similarity. Ties within a step go
    to the higher similarity, then the least id. ``earlier_only``: the published side is staging too and only rows with
    a lower id count. No hit: insert. Either side is written once, since each rule reads it.
    """
    own = cut_lineage(staging, "staged")
    staging, published = own, own if published is staging else cut_lineage(published, "published")
    s, p = staging.alias("s"), published.alias("p")
    S, P = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"p.{c}"))
    same = lambda c: F.coalesce(S(c) == P(c), F.lit(False))
    sim = similarity(S("slug"), P("slug"))
    order = P("id") < S("id") if earlier_only else F.lit(True)
    titled = same("work_id") | (S("slug") == P("slug"))
    raw_in, pub_in = holds(P("slug"), S("raw_slug")), holds(S("slug"), P("slug"))
    found = lambda df, step, score: df.select(S("id").alias("id"), step.alias("step"), (-score).alias("minus"), P("id").alias("performance_id"), P("minute").alias("pm")).where("step is not null")
    stage_minute = s.join(p, (S("theater_id") == P("theater_id")) & (S("minute") == P("minute")) & order)
    stage_day = s.join(p, (S("theater_id") == P("theater_id")) & (S("day") == P("day")) & order & titled & (S("tbc") != P("tbc")))
    company_minute = s.join(p, (S("company_id") == P("company_id")) & (S("minute") == P("minute")) & (S("theater_id").isNull() != P("theater_id").isNull()) & order)
    hits = [
        found(stage_minute, F.when(titled, 1).when((same("company_id") & (sim >= 0.3)) | (sim >= 0.6) | raw_in | pub_in, 3), F.when(titled, F.lit(0.0)).otherwise(sim)),
        found(stage_day, F.when(P("tbc"), 2).otherwise(6), F.lit(0.0)),
        found(company_minute, F.when((sim >= 0.3) | raw_in | pub_in | same("work_id"), 4), sim),
    ]
    fuzzy = _city_day(staging, published, order).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct((~F.col("strong")).alias("weak"), (-F.col("sim")).alias("minus"), "performance_id", "pm"))).alias("c"),
        F.count(F.when(F.col("strong"), 1)).alias("n_strong"),
    )
    certain = F.col("n_strong") == 1  # the only candidate, or the only strong one
    fuzzy = fuzzy.select("id", F.lit(5).alias("step"), F.lit(0.0).alias("minus"), F.get("c", F.lit(0))["performance_id"].alias("performance_id"), F.get("c", F.lit(0))["pm"].alias("pm"), F.when(~certain, F.transform("c", lambda x: x["performance_id"])).alias("held"))
    id_type = published.schema["id"].dataType.simpleString()
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    every = every.withColumn("held", F.lit(None).cast(f"array<{id_type}>")).unionByName(fuzzy)
    best = every.groupBy("id").agg(F.min_by(F.struct("step", "performance_id", "pm", "held"), F.struct("step", "minus", "performance_id")).alias("b"))
    out = staging.select("id", "minute", "tbc").join(best, "id", "left")
    action = F.when(F.col("b").isNull(), "insert").when(F.col("b.held").isNotNull(), "hold").when((F.col("b.pm") != F.col("minute")) & ~F.col("tbc"), "retime").otherwise("update")
    return out.select("id", F.coalesce("b.step", F.lit(7)).alias("step"), action.alias("action"), F.when(F.col("b.held").isNull(), F.col("b.performance_id")).alias("performance_id"), F.col("b.held").alias("candidates"))


def _city_day(staging: DataFrame, published: DataFrame, order: Column) -> DataFrame:
    """Pairs that the ladder's fifth step compares: ``(id, performance_id, pm, strong, sim)``, each once.

    They share city and day, and company, work or alike titles. Pairs of one company come from a join by it, those of one
    work from another, and the rest by title: a city's and day's distinct titles are compared with each other first.
    """
    S, P = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"p.{c}"))
    same = lambda c: F.coalesce(S(c) == P(c), F.lit(False))
    facts = ["id", "theater_id", "company_id", "work_id", "tbc", "starts_at", "day", "title", "raw_slug"]
    rows = staging.where(~F.col("skip_fuzzy")).select(*facts, F.lower("city").alias("town"))
    other = published.select(*facts[:-1], "minute", F.lower("city").alias("town"))
    s, p = rows.alias("s"), other.alias("p")
    gap = F.abs(F.unix_seconds(S("starts_at")) - F.unix_seconds(P("starts_at")))
    one_tbc = S("tbc") | P("tbc")
    block = (S("town") == P("town")) & (S("day") == P("day")) & order & (gap <= 86_400) & ~(S("theater_id").eqNullSafe(P("theater_id")) & ~S("tbc") & ~P("tbc")) & (one_tbc | (gap <= 5400))
    told = lambda df, near, bare: df.select(S("id").alias("id"), P("id").alias("performance_id"), P("minute").alias("pm"), ((same("company_id") | same("work_id")) & (near | same("work_id")) & (one_tbc | (gap <= 900))).alias("strong"), bare.alias("sim"))
    bare = lambda c: trigrams(slugify(without_bracket(c)))
    near, likeness = title_close(P("title"), S("title")), overlap(bare(S("title")), bare(P("title")))
    by_company = told(s.join(p, block & (S("company_id") == P("company_id"))), near, likeness)
    by_work = told(s.join(p, block & (S("work_id") == P("work_id")) & ~same("company_id")), near, likeness)
    # titles of a city and day, each once, with what is compared
    keyed = lambda df, side, *more: df.select("town", "day", F.col("title").alias(f"{side}_title"), *more).where(F.col(f"{side}_title").isNotNull()).distinct().withColumn(f"{side}_slug", slugify(F.col(f"{side}_title"))).withColumn(f"{side}_grams", trigrams(F.col(f"{side}_slug"))).withColumn(f"{side}_bare", bare(F.col(f"{side}_title")))
    titles = keyed(rows, "s", F.col("raw_slug").alias("s_raw")).join(keyed(other, "p"), ["town", "day"])
    titles = titles.where((overlap(F.col("s_grams"), F.col("p_grams")) >= 0.5) | holds(F.col("p_slug"), F.col("s_raw"))).select("town", "day", "s_title", "s_raw", "p_title", overlap(F.col("s_bare"), F.col("p_bare")).alias("alike"))
    t = titles.alias("t")
    T = lambda c: F.col(f"t.{c}")
    likely = s.join(t, (S("town") == T("town")) & (S("day") == T("day")) & (S("title") == T("s_title")) & (S("raw_slug") == T("s_raw")))
    by_title = told(likely.join(p, block & (T("p_title") == P("title")) & ~same("company_id") & ~same("work_id")), F.lit(False), T("alike"))
    return by_company.unionByName(by_work).unionByName(by_title)


@dataclass(frozen=True)
class Published:
    """Result of ``publish``: an action row for each staging row, and the staging rows to insert, list, hold and reject."""

    actions: DataFrame
    inserts: DataFrame
    listings: DataFrame
    held: DataFrame
    rejected: DataFrame


def publish(staging: DataFrame, performances: DataFrame, theaters: DataFrame, suppressions: DataFrame | None = None) -> Published:
    """Publish staging rows as a set, in two passes; nothing is written, so this is a dry run as well.

    Rejects incomplete rows, copies of the same run and suppressed shows; links the rest to published rows; then links the
    rows left over among themselves with the same ladder (a lower id plays the published side), takes the clusters of
    those links, inserts the first row of each and lists the others on it. A cluster may join rows that a one-by-one run
    would keep apart only where a chain of links is longer than one; ``step`` 8 marks the rows listed in the second pass.

    staging: F4 columns with dimension ids resolved (string ids); performances: as for ``published_side``.
    """
    usable, bad = reject_incomplete(staging)
    copies = same_run_copies(usable).select("id")
    rows = usable.join(copies, "id", "left_anti")
    prepared = cut_lineage(prepare(rows, theaters), "prepared")
    if suppressions is not None:
        facts = prepared.join(staging.select("id", F.when(time_known(F.col("performance_time")), F.trim("performance_time")).alias("local_time")), "id")
        facts = facts.withColumn("title_slug", F.col("slug")).withColumn("local_date", F.col("day"))
        kept = apply_suppressions(facts, suppressions).select("id")
    else:
        kept = prepared.select("id")
    live = prepared.join(kept, "id", "left_semi")
    first = cut_lineage(link_staging(live, published_side(performances, theaters)), "linked")
    new = live.join(first.where("action = 'insert'").select("id"), "id", "left_semi")
    among = cut_lineage(link_staging(new, new, earlier_only=True), "among")
    held_again = among.where("action = 'hold'")
    pairs = among.where("action in ('update', 'retime')").select(F.col("id").cast("string").alias("a_id"), F.col("performance_id").cast("string").alias("b_id"))
    heads = cluster(pairs)
    placed = new.select("id").join(heads.withColumnRenamed("id", "_id"), F.col("id").cast("string") == F.col("_id"), "left")
    head = Window.partitionBy("cluster_id").orderBy("id")
    member = placed.where("cluster_id is not null").withColumn("head", F.first("id").over(head)).select("id", "head")
    member = member.join(held_again.select("id"), "id", "left_anti")
    text = lambda c: F.col(c).cast("string")
    old = first.where("action <> 'insert'").select("id", "step", "action", text("performance_id").alias("performance_id"), F.transform("candidates", lambda c: c.cast("string")).alias("candidates"))
    no_list = F.lit(None).cast("array<string>").alias("candidates")
    listed = member.where("id <> head").select("id", F.lit(8).alias("step"), F.lit("update").alias("action"), F.concat(F.lit("new:"), text("head")).alias("performance_id"), no_list)
    again = held_again.select("id", F.lit(8).alias("step"), F.lit("hold").alias("action"), F.lit(None).cast("string").alias("performance_id"), F.transform("candidates", lambda c: F.concat(F.lit("new:"), c.cast("string"))).alias("candidates"))
    rest = new.select("id").join(listed.select("id").unionByName(again.select("id")), "id", "left_anti")
    fresh = rest.select("id", F.lit(7).alias("step"), F.lit("insert").alias("action"), F.concat(F.lit("new:"), text("id")).alias("performance_id"), no_list)
    none = F.lit(None).cast("string").alias("performance_id")
    rejects = bad.select("id", "reason").unionByName(copies.select("id", F.lit("same-run copy without venue").alias("reason")))
    rejects = rejects.unionByName(prepared.select("id").join(kept, "id", "left_anti").select("id", F.lit("suppressed").alias("reason")))
    refused = rejects.select("id", F.lit(0).alias("step"), F.lit("reject").alias("action"), none, no_list)
    actions = old.unionByName(listed).unionByName(again).unionByName(fresh).unionByName(refused)
    pick = lambda a: staging.join(actions.where(F.col("action").isin(*a)).select("id", "performance_id"), "id")
    return Published(actions, pick(["insert"]), pick(["insert", "update", "retime"]), staging.join(actions.where("action = 'hold'").select("id", "candidates"), "id"), staging.join(rejects, "id"))


def resolve_held(held: DataFrame, verdicts: DataFrame, performances: DataFrame, theaters: DataFrame) -> tuple[DataFrame, Published]:
    """Settle held rows by verdicts ``(id, call, keep)``: ``(listings on chosen rows, the rest published)``.

    ``same`` with a keep among the row's candidates lists it there; ``different`` publishes it without the fuzzy step;
    everything else stays held and is in neither result. held: staging columns and ``candidates`` (text ids).
    """
    rows = held.join(verdicts.select(F.col("id").alias("_v"), "call", "keep"), F.col("id") == F.col("_v")).drop("_v")
    same = rows.where((F.col("call") == "same") & F.array_contains("candidates", F.col("keep"))).withColumn("performance_id", F.col("keep"))
    different = rows.where("call = 'different'").drop("call", "keep", "candidates").withColumn("skip_fuzzy", F.lit(True))
    return same.drop("call", "keep", "candidates"), publish(different, performances, theaters)


def suppressions_from_snapshots(snapshots: DataFrame, performances: DataFrame, as_of: dt.date) -> DataFrame:
    """Rules for rows that were dropped and are gone: ``(title_slug, local_date, theater_id, source_id, local_time)``.

    snapshots: id, snapshot struct<title, local_date (text), theater_id>; only upcoming ones whose row no longer exists.
    """
    gone = snapshots.join(performances.select("id"), "id", "left_anti")
    day = F.try_to_date("snapshot.local_date")
    rules = gone.select(slugify(F.col("snapshot.title")).alias("title_slug"), day.alias("local_date"), F.col("snapshot.theater_id").alias("theater_id"), F.lit(None).cast("string").alias("source_id"), F.lit(None).cast("string").alias("local_time"))
    return rules.where((F.col("local_date") >= F.lit(as_of)) & (F.col("title_slug") != "")).distinct()


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def mark_collected(sources: DataFrame, promoted: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Sources with rows promoted in this run: last collected now, ``todo`` becomes ``ok``."""
    s = promoted.select(F.col("source_id").alias("_s")).distinct().withColumn("_hit", F.lit(True))
    out = sources.join(s, F.col("id") == F.col("_s"), "left")
    hit = F.coalesce("_hit", F.lit(False))
    return out.withColumn("last_collected_at", F.when(hit, F.lit(as_of)).otherwise(F.col("last_collected_at"))).withColumn("status", F.when(hit & (F.col("status") == "todo"), "ok").otherwise(F.col("status"))).drop("_s", "_hit")
