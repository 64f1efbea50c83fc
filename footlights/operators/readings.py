"""Nested readings of pages: parsing, flattening, cleaning, merging, comparing."""

from __future__ import annotations

import datetime as dt
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cut_at_word, filled, key_of, once
from ..functions.times import choose_timezone, minutes
from ..functions.urls import host, ticket_link
from .survive import is_venue_source

GENRE_TAGS = ("Classical", "Neoclassical", "Contemporary")

PERFORMANCE = "struct<date:string,time:string,venue:string,city:string,country:string,ticket_url:string,cancelled:boolean,timezone:string,date_basis:string>"
RUN = "struct<venue:string,city:string,country:string,start:string,`end`:string,expected_performances:int,dates_page_url:string,venue_event_url:string>"
PRODUCTION = (
    "struct<title:string,original_title:string,work:string,work_is_story:boolean,choreographer:string,company:string,tags:array<string>,program:string,"
    f"program_position:int,image_url:string,description:string,detail_url:string,performances:array<{PERFORMANCE}>,runs:array<{RUN}>>"
)
READING = (
    "struct<page_status:string,complete:boolean,unsure:string,notes:string,expected_performances:int,detail_links:array<string>,listing_links:array<string>,"
    f"next_page_url:string,announcement:struct<what:string,date:string,month:string,quote:string>,productions:array<{PRODUCTION}>,"
    f"performances:array<{PERFORMANCE}>,title:string,company:string>"
)


def as_list(text: Column, element: str) -> Column:
    """A list given as JSON text: an array, an object as a list of one; anything else is empty."""
    trimmed = F.trim(text)
    one = F.array(F.from_json(trimmed, element))
    return F.when(trimmed.startswith("["), F.from_json(trimmed, f"array<{element}>")).when(trimmed.startswith("{"), one).otherwise(F.array().cast(f"array<{element}>"))


def parse_reading(text: Column) -> Column:
    """A reading from its JSON text; fields that do not fit are null. Productions written as text are read as well.

    The text is parsed once, and its productions a second time only where they did not fit.
    """
    productions = lambda plain: F.coalesce(plain["productions"], once(F.get_json_object(text, "$.productions"), lambda raw: as_list(raw, PRODUCTION)))
    return once(F.from_json(text, READING, {"mode": "PERMISSIVE"}), lambda plain: F.when(plain.isNotNull(), plain.withField("productions", productions(plain))))


def lift_root(reading: Column) -> Column:
    """A reading whose one production was written at its root, moved into ``productions``."""
    empty = F.lit(None)

    def lifted(r: Column) -> Column:
        one = F.struct(
            r["title"].alias("title"), *[empty.cast(t).alias(n) for n, t in (("original_title", "string"), ("work", "string"), ("work_is_story", "boolean"), ("choreographer", "string"))],
            r["company"].alias("company"), *[empty.cast(t).alias(n) for n, t in (("tags", "array<string>"), ("program", "string"), ("program_position", "int"), ("image_url", "string"), ("description", "string"), ("detail_url", "string"))],
            r["performances"].alias("performances"), empty.cast(f"array<{RUN}>").alias("runs"),
        ).cast(PRODUCTION)
        none, some = F.coalesce(F.size(r["productions"]) <= 0, F.lit(True)), F.coalesce(F.size(r["performances"]) > 0, F.lit(False))
        return F.when(none & some, r.withField("productions", F.array(one))).otherwise(r)

    return once(reading, lifted)


def flatten_reading(readings: DataFrame, reading: str = "result") -> DataFrame:
    """One row for each performance of each production, in order: other columns, ``pos``, then the fields, a performance's own first."""
    keep = [c for c in readings.columns if c != reading]
    rows = readings.select(*keep, F.posexplode(F.col(f"{reading}.productions")).alias("prod_pos", "p"))
    rows = rows.select(*keep, "prod_pos", "p", F.posexplode("p.performances").alias("perf_pos", "q"))
    own = ("title", "original_title", "work", "work_is_story", "choreographer", "company", "tags", "program", "program_position", "image_url", "description", "detail_url")
    return rows.select(*keep, (F.col("prod_pos") * 100_000 + F.col("perf_pos")).alias("pos"), *[F.col(f"p.{c}") for c in own], *[F.col(f"q.{c}") for c in ("date", "time", "venue", "city", "country", "ticket_url", "cancelled", "timezone", "date_basis")])


def runs_of(readings: DataFrame, reading: str = "result") -> DataFrame:
    """One row for each run of a titled production; dates that are none are null."""
    keep = [c for c in readings.columns if c != reading]
    rows = readings.select(*keep, F.explode(F.col(f"{reading}.productions")).alias("p")).where(filled(F.col("p.title")).isNotNull()).select(*keep, "p", F.explode("p.runs").alias("r"))
    day = lambda c: F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c)
    return rows.select(
        *keep, F.trim("p.title").alias("title"), *[F.col(f"p.{c}") for c in ("work", "company", "choreographer", "image_url", "description", "detail_url")],
        *[filled(F.col(f"r.{c}")).alias(c) for c in ("venue", "city", "country")], day(F.col("r.start")).alias("start"), day(F.col("r.end")).alias("end"),
        F.col("r.expected_performances").alias("expected"), F.nullif(F.col("r.dates_page_url"), F.lit("")).alias("dates_page_url"), F.nullif(F.col("r.venue_event_url"), F.lit("")).alias("venue_event_url"),
    )


def valid_zone(name: Column) -> Column:
    """The trimmed name of a known zone of the form Area/Place; else null."""
    known = [z for z in sorted(available_timezones()) if "/" in z]
    return F.when(F.trim(name).isin(*known), F.trim(name))


def clean_performances(items: DataFrame, as_of: dt.date) -> DataFrame:
    """Usable items only, cleaned: a title, a valid date not past, HH:MM or no time, a genre tag, short description."""
    date = F.trim("date")
    day = F.try_to_date(F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), date))
    tags = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.coalesce(F.trim(t) != "", F.lit(False)))
    genre = F.exists(tags, lambda t: t.isin(*GENRE_TAGS))
    new = {c: filled(F.col(c)) for c in ("original_title", "work", "choreographer", "company", "venue", "city", "country", "program", "ticket_url", "image_url", "detail_url")}
    new |= {
        "title": F.trim("title"),
        "date": date,
        "time": F.when(F.trim("time").rlike(r"^([01]\d|2[0-3]):[0-5]\d$"), F.trim("time")),
        "tags": F.array_distinct(F.when(genre, tags).otherwise(F.concat(F.array(F.lit("Contemporary")), tags))),
        "work_is_story": F.coalesce("work_is_story", F.lit(False)),
        "cancelled": F.coalesce("cancelled", F.lit(False)),
        "program_position": F.when(F.col("program_position") > 0, F.col("program_position")),
        "description": cut_at_word(filled(F.col("description")), 600),
        "timezone": valid_zone(F.col("timezone")),
    }
    rows = items.where(filled(F.col("title")).isNotNull() & (day >= F.lit(as_of)))
    out = rows.select(*[(new[c] if c in new else F.col(c)).alias(c) for c in items.columns if c != "date_basis"], *([F.when(F.col("date_basis") == "pattern", "pattern").otherwise("listed").alias("date_source")] if "date_basis" in items.columns else []))
    return out


def merge_items(items: DataFrame, seen: str | None = None) -> DataFrame:
    """One item for each piece, venue, date and time of a source.

    items: source_id, seq, title, venue, date, time, program_position and any others. With a timed item the distinct
    times stay (the first of each), else the first untimed. Items without venue go where the same piece and date has one.
    ``seen`` (a boolean column: the time is written on the page) removes of two times 60 or 120 minutes apart the unseen.
    """
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    key = ["source_id", "_t", "_v", "date", "_p"]
    rows = items.withColumn("_t", low(F.col("title"))).withColumn("_v", low(F.col("venue"))).withColumn("_p", F.coalesce("program_position", F.lit(0)))
    timed = F.max(F.col("time").isNotNull()).over(Window.partitionBy(*key))
    place = F.max(F.col("_v") != "").over(Window.partitionBy("source_id", "_t", "date", "_p"))
    first = F.row_number().over(Window.partitionBy(*key, "time").orderBy("seq"))
    rows = rows.withColumn("_timed", timed).withColumn("_place", place).withColumn("_first", first)
    rows = rows.where((F.col("_first") == 1) & (F.col("time").isNotNull() | ~F.col("_timed")) & ((F.col("_v") != "") | ~F.col("_place")))
    if seen:
        twin = rows.where(F.col(seen) & F.col("time").isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], minutes(F.col("time")).alias("_m"))
        on = ~F.coalesce(F.col(seen), F.lit(False)) & F.abs(minutes(F.col("time")) - F.col("_m")).isin(60, 120)
        for i, k in enumerate(key):
            on = on & (F.col(k) == F.col(f"_k{i}"))
        rows = rows.join(twin, on, "left_anti")
    return rows.select(*items.columns)


def fill_from_siblings(items: DataFrame, fields: tuple[str, ...] = ("choreographer", "description", "image_url")) -> DataFrame:
    """Empty credits, descriptions and images taken from the first item of the same production that has them.

    items: source_id, seq, title, company, venue and the fields. One aggregation by production, joined back.
    """
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    rows = items.withColumn("_t", low(F.col("title"))).withColumn("_c", low(F.col("company"))).withColumn("_v", low(F.col("venue")))
    key = ["source_id", "_t", "_c", "_v"]
    best = rows.groupBy(*key).agg(*[F.min_by(F.col(f), F.when(filled(F.col(f)).isNotNull(), F.col("seq"))).alias(f"_{f}") for f in fields])
    out = rows.join(best, key, "left")
    return out.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")).alias(c) if c in fields else F.col(c) for c in items.columns])


def to_staging(items: DataFrame, sources: DataFrame, run_date: str) -> DataFrame:
    """Items as staging rows: home city and country for venue sources only, zone and ticket rules, dedupe key.

    sources: id, website, kind, city, country, timezone, a control table that is joined by id."""
    s = sources.select(F.col("id").alias("_id"), host(F.col("website")).alias("source"), is_venue_source(F.col("kind")).alias("_venue"), F.col("city").alias("_city"), F.col("country").alias("_country"), F.col("timezone").alias("_zone"))
    rows = items.join(s, F.col("source_id") == F.col("_id"))
    home = F.col("_venue") & (F.col("venue").isNull() | F.col("country").isNull())
    zone = choose_timezone(F.col("timezone"), F.col("country"), F.to_date("date"), F.col("_zone"), F.col("_country"), dt.date.fromisoformat(run_date[:10]))
    return rows.select(
        "source_id", "source", "title", "original_title", "work", "work_is_story", "choreographer", "company", "venue",
        F.coalesce("city", F.when(home, F.col("_city"))).alias("city"), F.coalesce("country", F.when(F.col("_venue") | F.col("city").isNull(), F.col("_country"))).alias("country"), zone.alias("timezone"),
        F.to_date("date").alias("performance_date"), F.col("time").alias("performance_time"), F.col("time").isNull().alias("time_tbc"), "tags", F.get("tags", F.lit(0)).alias("genre"), "program", "program_position",
        ticket_link(F.col("ticket_url"), F.col("detail_url")).alias("tickets_url"), "image_url", "description", "cancelled", "date_source",
        key_of(F.col("source"), F.col("title"), F.col("venue"), F.col("date"), F.col("time"), F.lit(run_date)).alias("dedupe_key"), F.lit("pending").alias("status"),
    )


def run_rows(runs: DataFrame) -> DataFrame:
    """Runs with their key: md5 of source, title, venue and start."""
    return runs.withColumn("run_key", key_of(F.col("source_id"), F.lower("title"), F.lower(F.coalesce("venue", F.lit(""))), F.col("start")))


def merge_runs(runs: DataFrame, fields: tuple[str, ...] = ("work", "company", "expected", "dates_page_url", "venue_event_url")) -> DataFrame:
    """One row for each run key: the first known value of each field in order, and the distinct lenses in order.

    runs: run_key, seq, lens and the fields."""
    pick = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f) for f in fields]
    lenses = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("seq", "lens"))), lambda x: x["lens"]))
    return runs.groupBy("run_key").agg(*pick, lenses.alias("lenses"))


def expanded_ranges(items: DataFrame, least: int = 3) -> DataFrame:
    """Productions whose days, ``least`` or more, all follow each other and have no time: ``(source_id, production, first, last)``.

    items: source_id, production, date (a date), time."""
    g = items.groupBy("source_id", "production").agg(F.count_distinct("date").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.when(filled(F.col("time")).isNotNull(), 1)).alias("timed"))
    return g.where((F.col("timed") == 0) & (F.col("n") >= least) & (F.date_diff("last", "first") + 1 == F.col("n"))).select("source_id", "production", "first", "last")


def count_upcoming(dates: Column, as_of: dt.date) -> Column:
    """Dates (ISO text) from a day on."""
    return F.size(F.filter(dates, lambda d: F.coalesce(d >= as_of.isoformat(), F.lit(False))))


def keep_english_titles(new: DataFrame, last: DataFrame) -> DataFrame:
    """Titles of a new reading replaced by the last reading's where it names the same original.

    Both: url, role, title, original_title (last may have several rows of a title; the least title wins). A join on page
    and original; a production is known by its original title, else by its title in the site's language.
    """
    known = last.where((F.trim("title") != "") & (F.trim("original_title") != "") & (F.lower(F.trim("title")) != F.lower(F.trim("original_title"))))
    known = known.groupBy("url", "role", F.lower(F.trim("original_title")).alias("_k")).agg(F.min(F.struct(F.trim("title").alias("t"), F.trim("original_title").alias("o"))).alias("_x"))
    own, orig = F.lower(F.trim("title")), F.lower(F.trim(F.coalesce("original_title", F.lit(""))))
    by = lambda p: known.select(F.col("url").alias(f"{p}u"), F.col("role").alias(f"{p}r"), F.col("_k").alias(f"{p}k"), F.col("_x").alias(f"{p}x"))
    rows = new.join(by("_a"), (F.col("url") == F.col("_au")) & (F.col("role") == F.col("_ar")) & (orig == F.col("_ak")), "left")
    rows = rows.join(by("_b"), (F.col("url") == F.col("_bu")) & (F.col("role") == F.col("_br")) & (own == F.col("_bk")), "left")
    use = F.when(F.col("_ax").isNotNull(), F.col("_ax")).when((orig == "") | (orig == own), F.col("_bx"))
    swap = use.isNotNull() & (F.trim("title") != use["t"])
    new_value = {"title": F.when(swap, use["t"]).otherwise(F.col("title")), "original_title": F.when(swap, use["o"]).otherwise(F.col("original_title"))}
    return rows.select(*[new_value[c].alias(c) if c in new_value else F.col(c) for c in new.columns], swap.alias("changed"))


def latest_reading(readings: DataFrame) -> DataFrame:
    """The last reading of each (url, role)."""
    w = Window.partitionBy("url", "role").orderBy(F.desc("updated_at"), F.desc("text_hash"))
    return readings.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def cache_state(pages: DataFrame, readings: DataFrame, as_of: dt.datetime, most_days: int = 28) -> DataFrame:
    """Add ``state`` to pages (url, role, text_hash): reuse, changed, expired or new."""
    last = latest_reading(readings).select(F.col("url").alias("_u"), F.col("role").alias("_r"), F.col("text_hash").alias("_h"), F.col("updated_at").alias("_at"))
    rows = pages.join(last, (F.col("url") == F.col("_u")) & (F.col("role") == F.col("_r")), "left")
    age = F.unix_seconds(F.lit(as_of)) - F.unix_seconds("_at")
    state = F.when(F.col("_u").isNull(), "new").when(F.col("_h") != F.col("text_hash"), "changed").when(age > most_days * 86_400, "expired").otherwise("reuse")
    return rows.select(*pages.columns, state.alias("state"))


def reconcile_pending(pending: DataFrame, answers: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Requests still open against late answers: ``(batch_id, custom_id, outcome, refund)``.

    Outcomes: store, refund (failed), wait, expired (older than ``days``), unknown (an answer without a request)."""
    p = pending.select(F.col("batch_id").alias("pb"), F.col("custom_id").alias("pc"), "estimate", "updated_at")
    rows = p.join(answers, (F.col("pb") == F.col("batch_id")) & (F.col("pc") == F.col("custom_id")), "full_outer")
    old = F.unix_seconds(F.lit(as_of)) - F.unix_seconds("updated_at") > days * 86_400
    outcome = F.when(F.col("pb").isNull(), "unknown").when(F.col("result") == "succeeded", "store").when(F.col("result").isNotNull(), "refund").when(old, "expired").otherwise("wait")
    return rows.select(F.coalesce("pb", "batch_id").alias("batch_id"), F.coalesce("pc", "custom_id").alias("custom_id"), outcome.alias("outcome"), F.when(outcome.isin("refund", "expired"), F.col("estimate")).alias("refund"))


def compare_readings(pairs: DataFrame) -> DataFrame:
    """Shows of two readings of a page: ``n_first, n_ref, n_same, missed, extra, same_dates`` (missed and extra in order).

    pairs: any columns, first and ref (array<struct<title, date>>)."""
    dates = lambda c: F.array_sort(F.array_distinct(F.transform(F.col(c), lambda x: x["date"])))
    a, b = F.array_distinct("first"), F.array_distinct("ref")
    keep = [c for c in pairs.columns if c not in ("first", "ref")]
    return pairs.select(
        *keep, F.size(a).alias("n_first"), F.size(b).alias("n_ref"), F.size(F.array_intersect(a, b)).alias("n_same"), F.array_sort(F.array_except(b, a)).alias("missed"), F.array_sort(F.array_except(a, b)).alias("extra"), (dates("first") == dates("ref")).alias("same_dates"),
    )


def choose_reference(rows: DataFrame, fresh_left: int, models: tuple[str, ...]) -> DataFrame:
    """Which reading serves as the reference: cache (same hash, a reference model), second look, fresh while the allowance lasts, none.

    rows: seq (each once, not null), text_hash, cached_hash, cached_model, has_second. Adds ``reference``. The allowance goes
    to the first by ``seq`` among the rows that need it: each task gives its first few, and only those are joined back."""
    cached = F.coalesce((F.col("cached_hash") == F.col("text_hash")) & F.col("cached_model").isin(*models), F.lit(False))
    kind = F.when(cached, "cache").when(F.col("has_second"), "second look")
    lucky = rows.where(kind.isNull()).select(F.col("seq").alias("_seq")).orderBy("_seq").limit(fresh_left)
    out = rows.join(lucky, F.col("seq") == F.col("_seq"), "left")
    return out.select(*rows.columns, F.coalesce(kind, F.when(F.col("_seq").isNotNull(), "fresh").otherwise("none")).alias("reference"))
