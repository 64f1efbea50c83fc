"""Operators on small literal tables: rules, ties, nulls, empty inputs."""

import datetime as dt

from pyspark.sql import functions as F

from footlights.operators import credits, duplicates, groups, ledger, link, pages, readings, schedule, survive
from footlights.operators.graph import cluster
from footlights.sources import tables

DAY = dt.date(2026, 9, 24)


def out(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_cluster_chains_and_empty(spark):
    pairs = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (1, 1), (None, 2)], "a_id long, b_id long")
    assert out(cluster(pairs), "id", "cluster_id") == [(1, 1), (3, 3), (4, 3), (5, 3), (8, 8), (9, 8)]
    assert cluster(pairs.limit(0)).count() == 0


def test_source_rank_ladder(spark):
    sources = spark.createDataFrame([(1, "Editor", None, None), (2, "Opera", 0, None), (3, "Opera", 1, None), (4, "Festival", 1, None), (5, "Ballet company", 1, 7), (6, "Opera", 0, None)], "id int, kind string, priority int, company_id int")
    venues = spark.createDataFrame([(2, 10), (3, 10), (2, 10)], "source_id int, theater_id int")
    rows = spark.createDataFrame([(1, 10, None), (2, 10, None), (3, 10, None), (4, 10, None), (5, 10, None), (6, 10, None), (99, 10, None), (None, None, None)], "source_id int, theater_id int, company_id int")
    got = survive.source_rank(rows, sources, venues)
    assert {r.source_id: r["rank"] for r in got.collect()} == {1: 0, 2: 1, 3: 4, 4: 2, 5: 3, 6: 5, 99: 6, None: 6}


def test_upsert_policy_and_patch(spark):
    old = spark.createDataFrame([(1, None, "a", "x"), (2, 5, "b", "y")], "p int, s int, title string, image string")
    new = spark.createDataFrame([(1, None, "A", None), (3, None, "c", "z")], "p int, s int, title string, image string")
    got = survive.upsert_by_policy(old, new, ["p", "s"], {"image": "keep_if_null"})
    assert out(got, "p", "title", "image") == [(1, "A", "x"), (2, "b", "y"), (3, "c", "z")]
    patch = spark.createDataFrame([(2, None, ["image"])], "p int, image string, set array<string>")
    assert out(survive.patch_by_key(old, patch, "p"), "p", "title", "image") == [(1, "a", "x"), (2, "b", None)]


def test_move_listings_keeps_one_per_source(spark):
    rows = spark.createDataFrame([(1, 10, 1), (2, 20, 1), (3, 20, None), (4, 30, 2), (5, 30, None)], "id int, performance_id int, source_id int")
    mapping = spark.createDataFrame([(20, 10), (30, 10)], "drop_id int, keep_id int")
    assert out(survive.move_listings(rows, mapping), "id", "performance_id") == [(1, 10), (3, 10), (4, 10)]


def test_flatten_clean_and_lift(spark):
    text = '{"productions": "[{\\"title\\": \\"Giselle\\", \\"tags\\": [\\"Premiere\\"], \\"performances\\": [{\\"date\\": \\"2026-10-01\\", \\"time\\": \\"7.30pm\\"}, {\\"date\\": \\"01/10/2026\\"}, {\\"date\\": \\"2020-01-01\\"}]}]"}'
    root = '{"title": "Solo", "performances": [{"date": "2026-10-02", "time": "19:30"}], "productions": []}'
    df = spark.createDataFrame([("s", text), ("s", root), ("s", "not json"), ("s", None)], "source_id string, raw string")
    parsed = df.select("source_id", readings.lift_root(readings.parse_reading(F.col("raw"))).alias("result"))
    got = readings.clean_performances(readings.flatten_reading(parsed), DAY)
    assert out(got, "title", "date", "time", "tags") == [("Giselle", "2026-10-01", None, ["Contemporary", "Premiere"]), ("Solo", "2026-10-02", "19:30", ["Contemporary"])]


def test_merge_items_rules(spark):
    rows = [(1, "A", "V", None), (2, "A", "V", "19:30"), (3, "A", "V", "14:00"), (4, "a", "v", "19:30"), (5, "A", None, "19:30"), (6, "B", None, None), (7, "C", "V", "19:00"), (8, "C", "V", "17:00"), (9, "C", "V", "20:30")]
    df = spark.createDataFrame([(*r, r[0] in (7, 9)) for r in rows], "seq int, title string, venue string, time string, seen boolean")
    df = df.select("*", F.lit("s").alias("source_id"), F.lit("2026-10-01").alias("date"), F.lit(None).cast("int").alias("program_position"))
    assert out(readings.merge_items(df), "seq") == [(2,), (3,), (6,), (7,), (8,), (9,)]
    assert out(readings.merge_items(df, seen="seen"), "seq") == [(2,), (3,), (6,), (7,), (9,)]
    assert readings.merge_items(df.limit(0)).count() == 0


def ladder_model(staged, published):
    """The ladder of one row against published ones, in plain Python (steps 1, 2 and 6 only)."""
    s = staged
    for step, ok in ((1, lambda p: p["minute"] == s["minute"]), (2, lambda p: not s["tbc"] and p["tbc"] and p["day"] == s["day"]), (6, lambda p: s["tbc"] and not p["tbc"] and p["day"] == s["day"])):
        hits = [p["id"] for p in published if p["theater"] is not None and p["theater"] == s["theater"] and p["title"] == s["title"] and ok(p)]
        if hits:
            return step, min(hits)
    return 7, None


def test_ladder_against_a_sequential_model(spark):
    import random

    rnd = random.Random(3)
    make = lambda i: {"id": f"{i:03d}", "theater": rnd.choice([None, "t1", "t2"]), "title": rnd.choice(["Alpha", "Omega Zulu"]), "day": dt.date(2026, 10, rnd.choice([1, 2])), "hour": rnd.choice([14, 19]), "tbc": rnd.random() < 0.4}
    rows = [make(i) for i in range(60)]
    for r in rows:
        r["minute"] = (r["day"], 0 if r["tbc"] else r["hour"])
    staged, published = rows[:30], rows[30:]
    s = spark.createDataFrame([(r["id"], "s", r["theater"], r["title"], r["day"], None if r["tbc"] else f"{r['hour']}:00") for r in staged], "id string, source_id string, theater_id string, title string, performance_date date, performance_time string")
    s = s.select("*", *[F.lit(None).cast("string").alias(c) for c in ("company_id", "work_id", "work", "program", "city")], F.lit("UTC").alias("timezone"), F.lit(None).cast("int").alias("program_position"), F.lit(None).cast("boolean").alias("time_tbc"))
    p = spark.createDataFrame([(r["id"], r["theater"], r["title"], dt.datetime.combine(r["day"], dt.time(0 if r["tbc"] else r["hour"])), ["Time TBC"] if r["tbc"] else []) for r in published], "id string, theater_id string, title string, performance_date timestamp, tags array<string>")
    p = p.select("*", *[F.lit(None).cast("string").alias(c) for c in ("company_id", "work_id", "city")], F.lit("UTC").alias("timezone"))
    none = spark.createDataFrame([], "id string, timezone string, city string")
    got = {r.id: (r.step, r.performance_id) for r in link.link_staging(link.prepare(s, none), link.published_side(p, none)).collect()}
    assert got == {r["id"]: ladder_model(r, published) for r in staged}


def test_publish_inserts_once_and_rejects(spark):
    rows = [("1", "t", "Swan Lake", "19:30", "Hall"), ("2", "t", "Swan Lake", "19:30", "Hall"), ("3", "t", None, "19:30", "Hall"), ("4", None, "Swan Lake", "19:30", None)]
    s = spark.createDataFrame(rows, "id string, theater_id string, title string, performance_time string, venue string")
    s = s.select("*", F.lit("s").alias("source_id"), F.lit(DAY).alias("performance_date"), F.lit(dt.datetime(2026, 9, 1)).alias("scraped_at"), *[F.lit(None).cast("string").alias(c) for c in ("company_id", "work_id", "work", "program", "city")], F.lit("UTC").alias("timezone"), F.lit(None).cast("int").alias("program_position"), F.lit(False).alias("time_tbc"))
    p = spark.createDataFrame([], "id string, theater_id string, title string, performance_date timestamp, tags array<string>, company_id string, work_id string, city string, timezone string")
    done = link.publish(s, p, spark.createDataFrame([], "id string, timezone string, city string"))
    assert out(done.actions, "id", "action", "performance_id") == [("1", "insert", "new:1"), ("2", "update", "new:1"), ("3", "reject", None), ("4", "reject", None)]


def test_credits_resolution(spark):
    people = spark.createDataFrame([(1, "Anna Berg", None), (2, "Lars Holm", ["L. Holm"])], "id int, name string, aliases array<string>").withColumn("created_at", F.timestamp_seconds("id"))
    firms = spark.createDataFrame([(9, "Club Guy & Roni", None)], "id int, name string, aliases array<string>").withColumn("created_at", F.timestamp_seconds("id"))
    lines = spark.createDataFrame([(50, "Berg, L. Holm"), (51, "Club Guy & Roni"), (52, "Mia & Paul Li"), (53, "Sole Person"), (54, "Zed / Anna Berg")], "id int, name string")
    parts, built = credits.rebuild_credits(lines, people, firms)
    assert out(built.where("line_id in (50, 51, 53)"), "line_id", "kind", "member_ids", "company_ids") == [(50, "credit_line", ["1", "2"], []), (51, "credit_line", [], ["9"]), (53, "person", ["53"], [])]
    assert out(parts.where("line_id = 52"), "part", "status", "member_id") == [("Mia", "new person", "new:mia-li"), ("Paul Li", "new person", "new:paul-li")]
    assert out(parts.where("line_id = 54"), "part", "status") == [("Anna Berg", "person"), ("Zed", "unresolved")]


def test_verdicts_and_keep_ids(spark):
    v = spark.createDataFrame([("pair", "same", "a", None, 0.9), ("pair", "same", "zz", None, 0.9), ("pair", "same", "a", None, 0.5), ("conflict", "ignore_listings", None, [1], 0.9), ("conflict", "ignore_listings", None, [1, 2], 0.9), ("held", "dismiss", None, None, 0.9)], "kind string, verdict string, keep string, ignore array<long>, confidence double")
    v = v.select("*", F.array(F.lit("a"), F.lit("b")).alias("valid_ids"), F.array(F.lit(1).cast("long"), F.lit(2).cast("long")).alias("valid_listings"))
    assert [r.call for r in duplicates.to_call(v).collect()] == ["same", "unsure", "unsure", "ignore_listings", "unsure", "unsure"]
    rows = F.array(F.struct(F.lit("abcdef12-1").alias("id"), F.array(F.lit(7).cast("long")).alias("listings")), F.struct(F.lit("bbbbbb34-2").alias("id"), F.array(F.lit(8).cast("long")).alias("listings")))
    said = spark.createDataFrame([("a",), ("row b",), ("candidate 2",), ("bbbbbb",), ("8",), ("it is abcdef12-1 surely",), ("what",), (None,)], "x string")
    one, two = "abcdef12-1", "bbbbbb34-2"
    assert [r[0] for r in said.select(duplicates.keep_id(F.col("x"), rows)).collect()] == [one, two, None, two, None, one, None, None]
    assert [r[0] for r in said.select(duplicates.keep_id(F.col("x"), rows, rich=F.lit(two))).collect()] == [one, two, two, two, two, one, two, two]
    more = spark.createDataFrame([("c1",), ("#2",), ("candidate 2",), ("1",), ("listing 708",), ("x",), ("row_a",)], "x string")
    listed = F.transform(rows, lambda r: F.struct(r["id"].alias("id"), F.transform(r["listings"], lambda n: n + 700).alias("listings")))
    assert [r[0] for r in more.select(duplicates.keep_id(F.col("x"), listed, F.lit(True))).collect()] == [one, two, two, one, two, None, None]
    assert {r[0] for r in more.select(duplicates.keep_id(F.col("x"), F.slice(listed, 1, 1), F.lit(True))).collect()} == {one}


def test_ledger_blocks(spark):
    spends = spark.createDataFrame([("j", i, 5) for i in range(12)], "job string, seq int, amount long")
    got = ledger.budget_blocks(spends, cap=60, block=25)
    assert [(r.seq, r.paid, r.reserved) for r in got.orderBy("seq").collect() if r.reserved or not r.paid] == [(0, True, 25), (5, True, 25), (10, False, 0), (11, False, 0)]


def test_schedule_small_rules(spark):
    src = spark.createDataFrame([(f"{i:03d}", 0) for i in range(45)] + [(f"z{i}", 1) for i in range(24)], "id string, priority int")
    sizes = sorted(r["count"] for r in schedule.deal(src, 12).groupBy("shard").count().collect())
    assert sizes == [5] * 3 + [6] * 9
    looks = spark.createDataFrame([("j", i, True) for i in range(30)], "job string, seq long, wanted boolean")
    assert schedule.capped_looks(looks).where("granted").count() == 6
    runs = spark.createDataFrame([(1, "s", "T", None, "Hall", None, None, 2), (2, "s", "U", None, None, None, None, None)], "run_id int, source_id string, title string, work string, venue string, start string, end string, expected int")
    items = spark.createDataFrame([("s", "t", None, "Main Hall", "2026-10-01", "19:30", "listed"), ("s", "T", None, None, "2026-10-02", None, "listed")], "source_id string, title string, work string, venue string, date string, time string, date_source string")
    assert out(schedule.settle_runs(runs, items), "run_id", "found", "status") == [(1, 2, "complete"), (2, 0, "range_only")]
    assert out(schedule.save_notes and spark.createDataFrame([("a || last run: x",), (None,)], "n string").select(schedule.save_notes(F.col("n"), F.lit("y")).alias("n")), "n") == [("a || last run: y",), ("|| last run: y",)]


def test_pages_events_and_walls(spark):
    html = '<script type="application/ld+json">{"@graph": [{"@type": "TheaterEvent", "name": "A", "subEvent": {"@type": ["Event"], "name": "B"}}, {"@type": "Person"}]}</script>'
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    got = pages.extract_events(df)
    assert sorted(r.event for r in got.collect() if '"A"' not in r.event) == ['{"@type":["Event"],"name":"B"}'] and got.count() == 2
    block = lambda status, title, text, doc: spark.createDataFrame([(status, title, text, doc)], "s int, t string, x string, h string").select(pages.detect_block(F.col("s"), F.col("t"), F.col("x"), F.col("h"))).first()[0]
    assert block(200, "Just a moment...", "", "cf-chl") == "cloudflare"
    assert block(403, "x", "short", "") == "HTTP 403"
    assert block(200, "x", "y" * 3000, "captcha") == ""
    assert block(200, "Shows", "t" * 400, "g-recaptcha") == ""


def test_tables_and_groups_edges(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], None)], "id int, tags array<string>, note string")
    assert tables.csv_rows(rows, ["id", "tags", "note", "more"]).first().asDict() == {"id": "1", "tags": "a, b", "note": "", "more": ""}
    keys = spark.createDataFrame([("p", 1, 7, dt.datetime(2026, 1, 1, 19, 30, 1)), ("p", 2, 7, dt.datetime(2026, 1, 1, 19, 30, 2)), (None, 3, 7, dt.datetime(2026, 1, 1, 19, 30))], "g string, id int, t int, at timestamp")
    got = [r[0] for r in keys.select(groups.evening_key(F.col("g"), F.col("id"), F.col("t"), F.col("at"))).collect()]
    assert got[0] == got[1] != got[2]
    text = "BEGIN:VEVENT\r\nSUMMARY:One\\, two\r\nDTSTART:20261001T173000Z\r\nLOCATION:Long\r\n  Hall\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:No date\r\nEND:VEVENT\r\n"
    ics = pages.read_ics(spark.createDataFrame([(text,)], "value string"))
    assert out(ics, "name", "start", "location") == [("One, two", "2026-10-01T17:30:00+00:00", "Long Hall")]


def test_save_source_and_snapshots(spark):
    old = dt.date(2026, 9, 1)
    src = spark.createDataFrame([(1, 0, "Opera", "n || last run: old", "todo", None, old, "said", None, ["a"]), (2, 1, "Festival", None, "ok", None, old, "said", "u", None)], "id int, priority int, kind string, notes string, status string, next_check_at date, announcement_at date, announcement_note string, schedule_url string, extra_schedule_urls array<string>")
    res = spark.createDataFrame([(1, 5, "ok", True, False, None, None, None, "5 shows", "s", ["b", "a"])], "source_id int, found int, status string, opens_soon boolean, again boolean, announced date, announced_what string, announced_quote string, summary string, schedule_url string, start_pages array<string>")
    got = schedule.save_source(src, res, DAY).orderBy("id").collect()
    assert (got[0].notes, got[0].extra_schedule_urls, got[0].next_check_at) == ("n || last run: 5 shows", ["a", "b"], dt.date(2026, 10, 1)) and got[1].next_check_at is None
    assert (got[0].status, got[0].announcement_at, got[0].schedule_url) == ("ok", None, "s") and (got[1].announcement_at, got[1].schedule_url) == (old, "u")
    again = schedule.save_source(src, res.withColumn("again", F.lit(True)), DAY).orderBy("id").first()
    assert again.next_check_at == DAY
    snap = spark.createDataFrame([(1, ("Swan Lake", "2026-10-01", "t")), (2, ("Old", "2020-01-01", "t")), (3, ("Here", "2026-10-01", "t"))], "id int, snapshot struct<title string, local_date string, theater_id string>")
    assert out(link.suppressions_from_snapshots(snap, spark.createDataFrame([(3,)], "id int"), DAY), "title_slug", "theater_id") == [("swan-lake", "t")]
