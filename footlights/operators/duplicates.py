"""Duplicate search among published rows, review queue and verdicts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import holds, overlap, trigrams
from .survive import source_rank


def sessions(rows: DataFrame, least: int = 3) -> DataFrame:
    """``(theater, day, title)`` given ``least`` times or more on one day at one venue: sessions, not duplicates."""
    return rows.where(F.col("theater").isNotNull()).groupBy("theater", "day", "title").count().where(F.col("count") >= least).drop("count")


def find_duplicate_candidates(rows: DataFrame, decided: DataFrame | None = None, least_similarity: float = 0.55) -> DataFrame:
    """Pairs of rows of one day and city that look like one show: ``(a_id, b_id, reason)``.

    ``rows``: id, day, minute (null or any if tbc), tbc, city, theater, company, work, program, title (a slug without
    bracket). The day and city are the blocks. Pairs of one company come from a join by it, those of one work from another,
    and the rest by title: a block's distinct titles are compared with each other first, so no pair of rows is made for
    titles that differ. Pairs in ``decided`` (drop_id, keep_id), either way round, are left out.
    """
    marked = rows.join(sessions(rows).withColumn("session", F.lit(True)), ["theater", "day", "title"], "left")
    marked = marked.select("id", "day", "city", "minute", "tbc", "theater", "company", "work", "program", "title", F.coalesce("session", F.lit(False)).alias("session"))
    a, b = marked.alias("a"), marked.drop("session").alias("b")
    A, B = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    eq = lambda c: F.coalesce(A(c) == B(c), F.lit(False))
    gap = F.abs(A("minute") - B("minute"))
    one_tbc = A("tbc") | B("tbc")
    near = one_tbc | (gap <= 90) | (eq("theater") & gap.isin(60, 120))
    # a session's rows are no duplicates of each other at one venue and with times
    fits = (A("day") == B("day")) & (A("city") == B("city")) & (A("id") < B("id")) & ~eq("program") & F.coalesce(near, F.lit(False)) & ~(eq("theater") & ~one_tbc & A("session"))
    told = lambda df: df.select(A("id").alias("a_id"), B("id").alias("b_id"), eq("theater").alias("same_venue"), F.when(~F.coalesce(one_tbc, F.lit(False)), gap).alias("gap"))
    by_company = told(a.join(b, fits & (A("company") == B("company"))))
    by_work = told(a.join(b, fits & (A("work") == B("work")) & ~eq("company")))
    titles = rows.select("day", "city", "title").where(F.col("title").isNotNull()).distinct().withColumn("grams", trigrams(F.col("title")))
    x, y = titles.alias("x"), titles.alias("y")
    alike = (
        (F.col("x.title") == F.col("y.title")) | (overlap(F.col("x.grams"), F.col("y.grams")) > least_similarity)
        | holds(F.col("y.title"), F.col("x.title")) | holds(F.col("x.title"), F.col("y.title"))
    )
    t = x.join(y, (F.col("x.day") == F.col("y.day")) & (F.col("x.city") == F.col("y.city"))).where(alike).select("x.day", "x.city", F.col("x.title").alias("of"), F.col("y.title").alias("like")).alias("t")
    T = lambda c: F.col(f"t.{c}")
    likely = a.join(t, (A("day") == T("day")) & (A("city") == T("city")) & (A("title") == T("of")))
    by_title = told(likely.join(b, fits & (T("like") == B("title")) & ~eq("company") & ~eq("work")))
    found = by_company.unionByName(by_work).unionByName(by_title)
    if decided is not None:
        both = decided.select(F.least("drop_id", "keep_id").alias("a_id"), F.greatest("drop_id", "keep_id").alias("b_id")).distinct()
        found = found.join(both, ["a_id", "b_id"], "left_anti")
    gap_text = F.col("gap").cast("string")
    reason = (
        F.when(F.col("gap").isNull(), "same day, one without time")
        .when(~F.col("same_venue"), F.concat(F.lit("same day, different or missing venue, start "), gap_text, F.lit(" min apart")))
        .when(F.col("gap").isin(60, 120), F.concat(F.lit("same venue, starts exactly "), gap_text, F.lit(" min apart (time zone copy?)")))
        .otherwise(F.concat(F.lit("same venue, start "), gap_text, F.lit(" min apart")))
    )
    return found.select("a_id", "b_id", reason.alias("reason"))


def upcoming_pairs(pairs: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Pairs of which a side is in ``upcoming(id)``: two semi joins, united."""
    ids = upcoming.select(F.col("id").alias("_id"))
    left = pairs.join(ids, F.col("a_id") == F.col("_id"), "left_semi")
    return left.unionByName(pairs.join(ids, F.col("b_id") == F.col("_id"), "left_semi")).distinct()


def unsure_recently(note: Column, as_of: dt.date | Column, days: int = 14) -> Column:
    """Whether a reviewer's note says unsure with a date within the last ``days``."""
    when = F.try_to_date(F.regexp_extract(F.coalesce(note, F.lit("")), r"^unsure (\d{4}-\d{2}-\d{2})", 1))
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.coalesce(when > F.date_sub(today, days), F.lit(False))


def evidence(performances: DataFrame, listings: DataFrame) -> DataFrame:
    """Each performance with its listings (not ignored, in order of id) as ``listed_by``; null if it has none."""
    facts = [c for c in listings.columns if c not in ("performance_id", "id", "ignored")]
    by = listings.where(~F.col("ignored")).groupBy("performance_id").agg(F.array_sort(F.collect_list(F.struct("id", *facts))).alias("listed_by"))
    return performances.join(by, performances["id"] == by["performance_id"], "left").drop("performance_id")


def review_queue(held: DataFrame, pairs: DataFrame, conflicts: DataFrame, as_of: dt.date, limit: int = 200) -> DataFrame:
    """What waits for a verdict: ``(kind, id, reason)``, each kind up to ``limit`` in its order, recent unsure ones skipped.

    held: id, day, reason, note; pairs and conflicts: id, reason, note.
    """
    waiting = lambda df: df.where(~unsure_recently(F.col("note"), as_of))
    one = waiting(held).orderBy("day", "id").limit(limit).select(F.lit("held").alias("kind"), F.col("id").cast("string").alias("id"), "reason")
    two = waiting(pairs).orderBy("id").limit(limit).select(F.lit("pair").alias("kind"), F.col("id").cast("string").alias("id"), "reason")
    three = waiting(conflicts).orderBy("id").limit(limit).select(F.lit("conflict").alias("kind"), F.col("id").cast("string").alias("id"), "reason")
    return one.unionByName(two).unionByName(three)


def queue_with_evidence(queue: DataFrame, mentions: DataFrame, performances: DataFrame, listings: DataFrame, sources: DataFrame, source_venues: DataFrame) -> DataFrame:
    """Add ``evidence`` to a review queue: what is known of the performances that each case names, in their order.

    mentions: kind, id (as in the queue), place, performance_id; performances: id, title, company_id; listings: id,
    performance_id, source_id, theater_id, company_id, ignored, title, time_tbc. ``evidence`` is an array of
    ``struct<place, id, title, listed_by>``, ``listed_by`` of ``struct<listing_id, source, rank, title, time_tbc>`` by
    listing id, ranked here, null for a performance without listings; performances that are gone are left out, and a pair
    stays in the queue only with both. Only performances that the queue names are looked up.
    """
    named = queue.select("kind", "id").join(mentions, ["kind", "id"])
    wanted = named.select(F.col("performance_id").alias("id")).distinct()
    shown = performances.select("id", "title", F.col("company_id").alias("_company")).join(wanted, "id", "left_semi")
    rows = listings.where(~F.col("ignored")).withColumnRenamed("id", "listing_id").join(shown.select(F.col("id").alias("_p"), "_company"), F.col("performance_id") == F.col("_p"))
    rows = source_rank(rows.withColumn("company_id", F.coalesce("company_id", "_company")).drop("_company"), sources, source_venues)
    facts = F.struct("listing_id", F.col("source_id").alias("source"), "rank", "title", "time_tbc")
    listed = rows.groupBy(F.col("_p").alias("id")).agg(F.array_sort(F.collect_list(facts)).alias("listed_by"))
    known = shown.select(F.col("id").alias("performance_id"), "title").join(listed.withColumnRenamed("id", "performance_id"), "performance_id", "left")
    told = F.struct("place", F.col("performance_id").alias("id"), "title", "listed_by")
    by_case = named.join(known, "performance_id").groupBy("kind", "id").agg(F.array_sort(F.collect_list(told)).alias("evidence"))
    out = queue.join(by_case, ["kind", "id"], "left")
    return out.where((F.col("kind") != "pair") | (F.coalesce(F.size("evidence"), F.lit(0)) == 2))


def to_call(verdicts: DataFrame, least_confidence: float = 0.85) -> DataFrame:
    """Check verdicts ``(kind, verdict, keep, ignore array, confidence, valid_ids array, valid_listings array)``.

    A verdict must fit its kind with enough confidence; ``same`` needs a keep among the valid ids, ``ignore_listings`` a
    non-empty strict subset of the valid listings. Everything else becomes ``unsure``. Adds ``call``.
    """
    fits = F.when(F.col("kind") == "conflict", F.col("verdict").isin("ignore_listings", "dismiss")).otherwise(F.col("verdict").isin("same", "different"))
    sure = F.coalesce(F.col("confidence") >= least_confidence, F.lit(False))
    keep = (F.col("verdict") != "same") | F.coalesce(F.array_contains("valid_ids", F.col("keep")), F.lit(False))
    named = F.array_distinct(F.coalesce("ignore", F.array().cast("array<long>")))
    inside = (F.size(named) > 0) & (F.size(F.array_except(named, F.col("valid_listings"))) == 0) & (F.size(named) < F.size("valid_listings"))
    ignore = (F.col("verdict") != "ignore_listings") | F.coalesce(inside, F.lit(False))
    return verdicts.withColumn("call", F.when(F.coalesce(fits, F.lit(False)) & sure & keep & ignore, F.col("verdict")).otherwise(F.lit("unsure")))


def apply_reviews(cases: DataFrame, verdicts: DataFrame, as_of: dt.date) -> DataFrame:
    """Outcome of verdicts on open cases: ``(kind, id, new_status, note, message)``.

    cases: kind, id, status (open), keep_id, drop_id, candidates; verdicts: kind, id, call, keep, ignore, note. Unknown or
    closed cases answer ``not open``; an unsure call writes a dated note and leaves the case open.
    """
    v = verdicts.withColumnRenamed("note", "said")
    rows = v.join(cases, ["kind", "id"], "left")
    kind, call = F.col("kind"), F.col("call")
    open_ = F.coalesce(F.col("status") == "open", F.lit(False))
    listed = F.coalesce(F.array_contains("candidates", F.col("keep")), F.lit(False))
    in_pair = F.coalesce(F.col("keep").isin(F.col("keep_id"), F.col("drop_id")), F.lit(False))
    n_ignored = F.coalesce(F.size("ignore"), F.lit(0))
    message = (
        F.when(call == "unsure", "left for a person")
        .when(~open_, "not open")
        .when((kind == "held") & (call == "same"), F.when(listed, F.concat(F.lit("listed on "), F.col("keep"))).otherwise("keep is not a candidate"))
        .when((kind == "held") & (call == "different"), "published")
        .when((kind == "pair") & (call == "same"), F.when(in_pair, F.concat(F.lit("merged into "), F.col("keep"))).otherwise("keep is not one of the pair"))
        .when((kind == "pair") & (call == "different"), "kept both")
        .when((kind == "conflict") & (call == "ignore_listings"), F.when(n_ignored > 0, F.concat(F.lit("ignored "), n_ignored.cast("string"), F.lit(" listing(s)"))).otherwise("no listing named"))
        .when((kind == "conflict") & (call == "dismiss"), "dismissed")
        .otherwise("unknown verdict")
    )
    status = (
        F.when(message.rlike("^(listed on|published|merged into|kept both)"), "applied")
        .when(message.startswith("ignored"), "resolved").when(message == "dismissed", "dismissed").otherwise(F.col("status"))
    )
    note = F.when(call == "unsure", F.concat(F.lit(f"unsure {as_of.isoformat()}: "), F.substring(F.coalesce("said", F.lit("")), 1, 2000))).otherwise(F.substring("said", 1, 2000))
    return rows.select("kind", "id", status.alias("new_status"), note.alias("note"), message.alias("message"))


def housekeeping(held: DataFrame, pairs: DataFrame, conflicts: DataFrame, performances: DataFrame, as_of: dt.date) -> DataFrame:
    """What a clean-up closes: ``(kind, id, new_status)``; held rows of past days, pairs whose rows are gone or both past,
    conflicts of past shows. held: id, day; pairs: id, a_id, b_id; conflicts: id, performance_id; performances: id, day."""
    day = F.lit(as_of)
    one = held.where(F.col("day") < day).select(F.lit("held").alias("kind"), F.col("id").cast("string").alias("id"), F.lit("expired").alias("new_status"))
    alive = performances.select(F.col("id").alias("_id"), F.col("day").alias("_day"))
    p = pairs.join(alive.withColumnsRenamed({"_id": "_a", "_day": "a_day"}), F.col("a_id") == F.col("_a"), "left").join(alive.withColumnsRenamed({"_id": "_b", "_day": "b_day"}), F.col("b_id") == F.col("_b"), "left")
    gone = F.col("_a").isNull() | F.col("_b").isNull() | (F.greatest("a_day", "b_day") < day)
    two = p.where(gone).select(F.lit("pair").alias("kind"), F.col("id").cast("string").alias("id"), F.lit("rejected").alias("new_status"))
    c = conflicts.join(alive, F.col("performance_id") == F.col("_id")).where(F.col("_day") < day)
    three = c.select(F.lit("conflict").alias("kind"), F.col("id").cast("string").alias("id"), F.lit("dismissed").alias("new_status"))
    return one.unionByName(two).unionByName(three)


def housekeeping_counts(closed: DataFrame) -> DataFrame:
    """How many rows each rule of ``housekeeping`` closed: one row ``(held_expired, pairs_closed, conflicts_past)``, zeros too."""
    names = {"held": "held_expired", "pair": "pairs_closed", "conflict": "conflicts_past"}
    return closed.agg(*[F.count_if(F.col("kind") == kind).alias(name) for kind, name in names.items()])


def richer(a: Column, b: Column) -> Column:
    """The richer of two struct columns ``(sites, timed, filled, best_rank, id)``; a tie keeps the first."""
    order = lambda s: F.struct(s["sites"], s["timed"], s["filled"], (-s["best_rank"]).alias("r"))
    return F.when(order(b) > order(a), b["id"]).otherwise(a["id"])


def keep_id(answer: Column, rows: Column, held: Column | None = None, rich: Column | None = None) -> Column:
    """The row a reviewer's answer names, among ``rows`` (``array<struct<id string, listings array<long>>>``); else null.

    ``held``: the rows are candidates of a held listing; else they are the two of a pair. Understood, in this order: an id
    or its beginning of 6 characters or more (of a pair also "a", "row b", "row_b"); of candidates their number ("c1",
    "candidate 2", "row 1", "#2", "2"); a number of 3 digits or more of one row's listings, anywhere but inside an id that is
    written out; the first 8 characters of an id, anywhere. Without a usable answer a pair keeps ``rich`` (the richer row's id), a held listing its
    only candidate.
    """
    held = F.lit(False) if held is None else held
    said = F.lower(F.trim(F.coalesce(answer, F.lit(""))))
    only = lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))["id"])
    fits = lambda r: (said != "") & ((F.lower(r["id"]) == said) | ((F.length(said) >= 6) & F.startswith(F.lower(r["id"]), said)))
    named = F.filter(rows, fits)
    label = F.regexp_extract(said, r"^(?:row[ _])?([ab])$", 1)
    in_pair = F.coalesce(F.when(label == "a", F.get(rows, F.lit(0))["id"]).when(label == "b", F.get(rows, F.lit(1))["id"]), F.get(named, F.lit(0))["id"])
    place = F.regexp_extract(said, r"^(?:c|candidate|row|#)?\s*(\d{1,2})$", 1).try_cast("int")
    in_list = F.coalesce(only(named), F.when(place.between(1, F.size(rows)), F.get(rows, place - 1)["id"]))
    written = lambda r: F.concat(F.lit(r"\Q"), F.substring(F.lower(r["id"]), 1, 8), F.lit(r"\E[0-9a-z-]*"))
    without_ids = F.aggregate(rows, said, lambda t, r: F.when(F.length(r["id"]) >= 8, F.regexp_replace(t, written(r), F.lit(" "))).otherwise(t))
    numbers = F.regexp_extract_all(without_ids, F.lit(r"\d{3,}"), F.lit(0))
    by_listing = F.filter(rows, lambda r: F.coalesce(F.arrays_overlap(F.transform(r["listings"], lambda x: x.cast("string")), numbers), F.lit(False)))
    inside = F.filter(rows, lambda r: (said != "") & F.contains(said, F.substring(F.lower(r["id"]), 1, 8)))
    named_in_pair = in_pair if rich is None else F.coalesce(in_pair, only(by_listing), only(inside), rich)
    return F.when(held, F.coalesce(in_list, only(by_listing), only(inside), only(rows))).otherwise(F.coalesce(named_in_pair, only(by_listing), only(inside)))


def case_urls(links: Column, most: int = 4) -> Column:
    """Addresses of a case by rank then order: ``array<struct<rank, url>>`` to distinct urls without documents and images."""
    ranked = F.array_sort(F.filter(links, lambda x: x["url"].isNotNull() & ~x["url"].rlike(r"(?i)\.(pdf|jpe?g|png|gif|webp|svg)([?#]|$)")))
    return F.slice(F.array_distinct(F.transform(ranked, lambda x: x["url"])), 1, most)
