"""Scheduling: due queue, dealing, samples, what is read again, run completeness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..functions.text import fold_digits
from ..functions.times import announcement_days, recheck_days
from .fold import fold_sorted


def due_queue(sources: DataFrame, as_of: dt.datetime, statuses: tuple[str, ...] = ("ok", "todo", "partial"), priority: int | None = None, name: str | None = None, limit: int | None = None) -> DataFrame:
    """Sources due or never checked, active: by priority, longest not collected first (never first), name, id."""
    due = sources.where(F.col("status").isin(*statuses) & (F.col("next_check_at").isNull() | (F.col("next_check_at") <= F.lit(as_of))))
    if priority is not None:
        due = due.where(F.col("priority") == priority)
    if name:
        due = due.where(F.col("name").ilike(f"%{name}%"))
    due = due.orderBy(F.col("priority").asc_nulls_last(), F.col("last_collected_at").asc_nulls_first(), "name", "id")
    return due if limit is None else due.limit(limit)


def deal(sources: DataFrame, shards: int, id_col: str = "id", priority: str = "priority") -> DataFrame:
    """Add ``shard``: sources in order of tier (none: 9) and id are dealt round like cards.

    The order is total over all sources, a control table of thousands of rows; tiers below are counted apart, so each
    window holds one tier.
    """
    tier = F.coalesce(priority, F.lit(9))
    rows = sources.withColumn("_tier", tier)
    sizes = rows.groupBy("_tier").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_tier").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_tier", "_before")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_tier").orderBy(id_col)) - 1
    return rows.join(before, "_tier").withColumn("shard", (place % shards).cast("int")).drop("_tier", "_before")


def hash_shard(sources: DataFrame, shards: int, id_col: str = "id") -> DataFrame:
    """Add ``shard``: md5 of the id as a 128-bit number modulo ``shards``; no row needs another."""
    return sources.withColumn("shard", fold_digits(F.md5(F.col(id_col).cast("string")), shards))


def with_recent(due: DataFrame, recent: DataFrame, id_col: str = "id") -> DataFrame:
    """The deck: due rows and recently checked ones, a due row before its recent form."""
    both = due.withColumn("_o", F.lit(0)).unionByName(recent.withColumn("_o", F.lit(1)))
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(id_col).orderBy("_o"))).where("_r = 1").drop("_o", "_r")


def stratified_sample(sources: DataFrame, n: int, shares: dict[int, float], per_country: int = 2) -> DataFrame:
    """A repeatable sample of ``n``: in each tier, in md5 order of the id, at most ``per_country`` of a country and at most
    max(1, round(n * share)) (half to even); then the first ``n`` by tier and order."""
    rows = sources.withColumn("_h", F.md5(F.col("id").cast("string")))
    want = F.lit(None).cast("int")
    for tier, share in shares.items():
        want = F.when(F.col("tier") == tier, F.greatest(F.lit(1), F.bround(F.lit(n * share), 0).cast("int"))).otherwise(want)
    rows = rows.withColumn("_c", F.row_number().over(Window.partitionBy("tier", "country").orderBy("_h", "id"))).where(F.col("_c") <= per_country)
    rows = rows.withColumn("_t", F.row_number().over(Window.partitionBy("tier").orderBy("_h", "id"))).where(F.col("_t") <= want)
    return rows.orderBy("tier", "_t").limit(n).drop("_h", "_c", "_t")


def reusable(age_days: Column, dates: Column, has_open_runs: Column, short: Column, as_of: dt.date, refresh: int = 30, none_days: int = 14, soon: int = 28) -> Column:
    """Whether a page read before needs no new reading: young, no run with missing dates, not short of what was expected;
    without a future date young enough, else the next date far enough."""
    future = F.filter(dates, lambda d: d >= F.lit(as_of))
    rest = F.when(F.size(future) == 0, age_days < none_days).otherwise(F.array_min(future) > F.lit(as_of + dt.timedelta(days=soon)))
    return F.when((age_days >= refresh) | has_open_runs | short, F.lit(False)).otherwise(rest)


#: Words in a reading's own doubts that mean it left something out (fixed values).
GAVE_UP = (
    r"(?i)(not (all|fully|every)|could not|couldn't|the rest|next call|placeholder|only the first|recorded only|partly|partially|"
    r"truncat|cut off|incomplete|not included|more (dates|productions|entries))"
)


def second_look(rows: DataFrame, drop_least: int = 3, drop: float = 0.5) -> DataFrame:
    """Add ``why``: the first reason to read a page again, or null.

    rows: no_answer, truncated, complete, page_status, n_items, unsure, range_text, n_upcoming, n_before.
    """
    gave_up = F.col("unsure").rlike(GAVE_UP)
    unfinished = (F.col("complete") == F.lit(False)) & ((F.col("page_status") == "has_performances") | (F.col("n_items") > 0))
    why = (
        F.when(F.col("no_answer"), "no answer in the form")
        .when(F.col("truncated"), "answer cut off")
        .when(unfinished, "the reading says it left shows out")
        .when(gave_up, F.concat(F.lit("unsure: "), F.substring("unsure", 1, 100)))
        .when(F.col("range_text").isNotNull(), F.concat(F.lit("dates of a range written out one by one ("), F.col("range_text"), F.lit(")")))
        .when((F.col("n_before") >= drop_least) & (F.col("n_upcoming") < F.col("n_before") * drop), F.concat(F.lit("found "), F.col("n_upcoming").cast("string"), F.lit(" shows, "), F.col("n_before").cast("string"), F.lit(" at the last reading")))
    )
    return rows.withColumn("why", why)


def second_failed(second_items: Column, second_answered: Column, second_status: Column, first_items: Column) -> Column:
    """Why a second reading must not replace a first one that had shows, or null."""
    why = F.when(~second_answered, "gave no answer").when((second_items == 0) & (second_status == "has_performances"), "said the page has performances but listed none")
    return F.when(first_items > 0, why)


def capped_looks(rows: DataFrame, share: float = 0.2, least: int = 3) -> DataFrame:
    """Add ``granted``: of the wanted second looks of each job, in order, one is granted while those before are fewer
    than max(least, share * answered). rows: job, seq, wanted. A fold that carries two counts a job."""

    def step(state: list[int], seq: int, wanted: bool | None) -> tuple:
        state[0] += 1
        ok = bool(wanted) and state[1] < max(float(least), state[0] * share)
        state[1] += ok
        return seq, ok

    shape = StructType([rows.schema["job"], StructField("seq", LongType()), StructField("granted", BooleanType())])
    return fold_sorted(rows.withColumn("seq", F.col("seq").cast("long")), "job", ["seq"], ["wanted"], lambda: [0, 0], step, shape)


def settle_runs(runs: DataFrame, items: DataFrame) -> DataFrame:
    """Completeness of runs with missing dates: ``(run columns, found, status)``.

    runs: run_id, source_id, title, work, venue, start, end, expected; items: source_id, title, work, venue, date, time,
    date_source. An item counts if the source and the title or work are equal, the places agree (one holds the other or
    is empty) and the date lies inside. The two equi joins are united, so no pair is compared beyond its key.
    """
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    r = runs.select("run_id", F.col("source_id").alias("_s"), low(F.col("title")).alias("_t"), low(F.col("work")).alias("_w"), F.trim(low(F.col("venue"))).alias("_v"), F.col("start").alias("_a"), F.col("end").alias("_b"))
    i = items.select("source_id", low(F.col("title")).alias("t"), low(F.col("work")).alias("w"), F.trim(low(F.col("venue"))).alias("v"), "date", "time", "date_source")
    place = (F.col("v") == "") | (F.col("_v") == "") | F.contains("v", "_v") | F.contains("_v", "v")
    inside = (F.col("_a").isNull() | (F.col("date") >= F.col("_a"))) & (F.col("_b").isNull() | (F.col("date") <= F.col("_b")))
    by_title = r.join(i, (F.col("_s") == F.col("source_id")) & (F.col("_t") == F.col("t"))).where(place).withColumn("titled", F.lit(True))
    by_work = r.join(i, (F.col("_s") == F.col("source_id")) & (F.col("_w") == F.col("w")) & (F.col("_w") != "")).where(place).withColumn("titled", F.lit(False))
    hits = by_title.unionByName(by_work)
    hunted = F.max(F.col("titled") & F.col("date_source").isin("booking", "venue_site"))
    found = hits.groupBy("run_id").agg(F.count_distinct(F.when(inside, F.struct("date", F.coalesce("time", F.lit("")).alias("time")))).alias("found"), F.coalesce(hunted, F.lit(False)).alias("hunted"))
    out = runs.join(found, "run_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    known = F.coalesce(F.col("expected") > 0, F.lit(False))
    status = (
        F.when(known & (F.col("found") >= F.col("expected")), "complete").when(F.col("found") <= 1, "range_only")
        .when(~known & F.coalesce("hunted", F.lit(False)), "complete").otherwise("partial")
    )
    return out.withColumn("status", status).drop("hunted")


def coverage_checks(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Add ``month_only`` and ``short_season``: signs that part of a programme was not reached.

    rows: dates (of the schedule), paged, n_details, core, kind, last_date."""
    span = F.date_diff(F.array_max("dates"), F.array_min("dates"))
    house = F.coalesce(F.col("kind").rlike("(?i)(opera|ballet|theatre|theater)"), F.lit(False))
    return rows.withColumn("month_only", (F.size("dates") >= 3) & ~F.col("paged") & (F.col("n_details") == 0) & (span <= 35)).withColumn(
        "short_season", F.coalesce(F.col("core") & house & (F.col("last_date") < F.lit(as_of + dt.timedelta(days=75))), F.lit(False))
    )


def redundant_pages(pages: DataFrame) -> DataFrame:
    """Add ``redundant``: pages that need not be opened, as the schedule gave it all.

    pages: source_id, title, seq, kind, n_dated, n_timed, has_open_run, credits_known. Complete dates without an open run
    make a page redundant; if only the credits are missing, the first page of each title is read for them. Never for
    companies. A window of a source's title.
    """
    complete = (F.col("n_dated") > 0) & (F.col("n_timed") == F.col("n_dated")) & ~F.col("has_open_run")
    company = F.coalesce(F.col("kind").rlike("(?i)company"), F.lit(False))
    turn = F.row_number().over(Window.partitionBy("source_id", F.lower("title"), complete & ~F.col("credits_known")).orderBy("seq"))
    return pages.withColumn("redundant", ~company & complete & (F.col("credits_known") | (turn > 1)))


def queue_details(links: DataFrame, caps: dict[int, int]) -> DataFrame:
    """New detail pages of each source: one for a page key, in order, up to the tier's cap (skipped ones do not count).

    links: source_id, tier, seq, key, skipped."""
    cap = F.lit(max(caps.values()))
    for tier, most in caps.items():
        cap = F.when(F.col("tier") == tier, F.lit(most)).otherwise(cap)
    first = links.withColumn("_r", F.row_number().over(Window.partitionBy("source_id", "key").orderBy("seq"))).where("_r = 1").drop("_r")
    counted = F.sum(F.when(F.col("skipped"), 0).otherwise(1)).over(Window.partitionBy("source_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return first.withColumn("_n", counted).where(~F.col("skipped") & (F.col("_n") <= cap)).drop("_n")


def hunt_targets(runs: DataFrame, seen: DataFrame, most: int = 10) -> DataFrame:
    """Pages to hunt the dates of open runs of core sources: dates page, then venue page; no sellers, not seen, distinct.

    runs: source_id, tier, seq, status, dates_page_url, venue_event_url; seen: source_id, url."""
    from ..functions.urls import is_ticket_seller

    two = F.array(F.struct(F.lit(0).alias("o"), F.col("dates_page_url").alias("url")), F.struct(F.lit(1).alias("o"), F.col("venue_event_url").alias("url")))
    rows = runs.where(F.col("tier").isin(0, 1) & (F.col("status") != "complete")).select("source_id", "seq", F.explode(two).alias("x")).select("source_id", "seq", "x.o", "x.url")
    rows = rows.where(F.col("url").isNotNull() & ~is_ticket_seller(F.col("url"))).join(seen.select("source_id", "url"), ["source_id", "url"], "left_anti")
    rows = rows.groupBy("source_id", "url").agg(F.min(F.struct("seq", "o")).alias("at"))
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("source_id").orderBy("at", "url"))).where(F.col("_r") <= most).select("source_id", "url", F.col("_r").alias("place"))


def months_to_read(months: DataFrame, ahead: int = 3) -> DataFrame:
    """Calendar months read before the first gap: ``(source_id, month)``.

    months: source_id, month (0 upwards), has_shows. Reading begins with the first ``ahead + 1`` months; a read month with
    shows extends it to ``ahead`` months past itself, so it stops at the first longer gap.
    """
    w = Window.partitionBy("source_id").orderBy("month")
    shows = F.when(F.col("has_shows"), F.col("month"))
    last = F.coalesce(F.max(shows).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    broken = F.max((F.col("month") > F.col("_last") + ahead + 1).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = months.withColumn("_last", last).withColumn("_broken", broken)
    return rows.where((F.col("_broken") == 0) & ((F.col("month") <= F.col("_last") + ahead) | (F.col("month") <= ahead))).select("source_id", "month")


def finalize_sources(rows: DataFrame) -> DataFrame:
    """Add ``status`` and ``check`` of a source's run.

    rows: n_items, n_details, detail_cap, out_of_time, n_blocked, readable, unanswered, left_open, page_statuses, upcoming.
    Status: ok or partial with items; else partial, blocked, waiting, no_dance or failed. ``check``: fewer than half of what
    is upcoming already; a no_dance then counts as failed.
    """
    short = (F.col("n_details") > F.col("detail_cap")) | F.col("out_of_time") | (F.col("n_blocked") > 0) | F.col("unanswered") | (F.col("left_open") > 0)
    none = (F.size("page_statuses") > 0) & F.forall("page_statuses", lambda s: s.isin("no_dance_programme", "not_a_schedule"))
    status = (
        F.when(F.col("n_items") > 0, F.when(short, "partial").otherwise("ok")).when(F.col("left_open") > 0, "partial")
        .when((F.col("n_blocked") > 0) & (F.col("readable") == 0), "blocked").when(F.array_contains("page_statuses", "not_published_yet"), "waiting")
        .when(none, "no_dance").otherwise("failed")
    )
    check = F.coalesce((F.col("upcoming") > 0) & (F.col("n_items") < 0.5 * F.col("upcoming")), F.lit(False))
    return rows.withColumn("check", check).withColumn("status", F.when(check & (status == "no_dance"), "failed").otherwise(status))


def save_notes(notes: Column, summary: Column, marker: str = "last run:") -> Column:
    """Notes with the tail from the marker on replaced by this run's summary."""
    head = F.rtrim(F.regexp_replace(F.coalesce(notes, F.lit("")), rf"(?s)\s*\|\|\s*{marker}.*$", ""))
    return F.concat(F.when(head == "", "").otherwise(F.concat(head, F.lit(" "))), F.lit(f"|| {marker} "), summary)


def save_source(sources: DataFrame, results: DataFrame, as_of: dt.date, most_pages: int = 6) -> DataFrame:
    """Sources after a run: status, next check, notes, announcement, schedule page and learned start pages.

    sources: id, priority, kind, notes, status, next_check_at, announcement_at, announcement_note, schedule_url,
    extra_schedule_urls; results: source_id, found, status, opens_soon, again (look again at once: unanswered or open
    requests, or a retry), announced (date), announced_what, announced_quote, summary, schedule_url, start_pages. An
    announcement that was found is kept; an earlier one whose day has passed goes if the page could be read. A schedule page
    is only set where there is none. Sources without a result stay as they are.
    """
    names = ("found", "status", "opens_soon", "again", "announced", "announced_what", "announced_quote", "summary", "schedule_url", "start_pages")
    rows = sources.join(results.select(F.col("source_id").alias("_s"), *[F.col(c).alias(f"_{c}") for c in names]), F.col("id") == F.col("_s"), "left")
    days = F.when(F.coalesce("_again", F.lit(False)), F.lit(0)).otherwise(recheck_days(F.col("priority"), F.col("kind"), F.col("_found"), F.col("_opens_soon")))
    days = announcement_days(days, F.col("_found"), F.col("_announced"), as_of, F.col("priority"))
    told = F.substring(F.concat(F.col("_announced_what"), F.lit(": "), F.col("_announced").cast("string"), F.lit(' ("'), F.col("_announced_quote"), F.lit('")')), 1, 300)
    passed = (F.col("announcement_at") < F.lit(as_of)) & F.col("_status").isin("ok", "partial", "waiting", "no_dance")
    none = F.array().cast("array<string>")
    pages = F.coalesce("extra_schedule_urls", none)
    learned = F.array_except(F.coalesce("_start_pages", none), pages)
    new = {
        "status": F.col("_status"),
        "next_check_at": F.date_add(F.lit(as_of), days.cast("int")),
        "notes": save_notes(F.col("notes"), F.col("_summary")),
        "announcement_at": F.when(F.col("_announced").isNotNull(), F.col("_announced")).when(F.coalesce(passed, F.lit(False)), F.lit(None)).otherwise(F.col("announcement_at")),
        "announcement_note": F.when(F.col("_announced").isNotNull(), told).otherwise(F.col("announcement_note")),
        "schedule_url": F.coalesce(F.nullif("schedule_url", F.lit("")), "_schedule_url"),
        "extra_schedule_urls": F.when(F.size(learned) > 0, F.slice(F.concat(pages, learned), 1, most_pages)).otherwise(F.col("extra_schedule_urls")),
    }
    return rows.select(*[F.when(F.col("_s").isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in sources.columns])


def announcements(rows: DataFrame) -> DataFrame:
    """Announcements of each source, one per date and subject in any case, the earliest marked: ``(source_id, date, what, is_next)``."""
    distinct = rows.where("date is not null").groupBy("source_id", "date", F.lower("what").alias("_what")).agg(F.min("what").alias("what")).select("source_id", "date", "what")
    first = Window.partitionBy("source_id").orderBy("date", "what")
    return distinct.withColumn("is_next", F.row_number().over(first) == 1)
