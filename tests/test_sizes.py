"""Work that must not grow with the square of a group, and rows that must not move more often than they need to."""

import datetime as dt

from pyspark.sql import functions as F

from footlights.operators import changes, credits, duplicates, graph, link, saved_groups, serve, survive
from footlights.operators.groups import group_evenings, header_flags
from tests.test_saved_groups import evening_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def most_rows(df) -> int:
    """The most rows that a step of the plan gave, after it has run."""
    df.collect()
    node, most = [df._jdf.queryExecution().executedPlan()], 0
    while node:
        n = node.pop()
        if n.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            n = n.executedPlan()
        if n.getClass().getSimpleName().endswith("QueryStageExec"):
            n = n.plan()
        made = n.metrics().get("numOutputRows")
        most = max(most, made.get().value() if made.isDefined() else 0)
        node += [n.children().apply(i) for i in range(n.children().size())]
    return most


def test_evenings_that_are_dealt_do_not_move_again(spark, tmp_path):
    rows = saved_groups.deal(evening_rows(spark, [(str(i), f"e{i // 2}") for i in range(40)]), buckets=8)
    assert plan(group_evenings(header_flags(rows))).count("Exchange") == 1
    saved_groups.save_groups(rows, str(tmp_path / "groups"), buckets=8, dealt=True)
    files = list((tmp_path / "groups").rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) > 1


def test_shows_of_a_stage_are_counted_not_paired(spark):
    """400 sources of one stage with 4,000 shows are 1.6 million pairs; no step may make them."""
    s = spark.range(400).select("id", F.col("id").alias("company_id"))
    p = spark.range(4000).select("id", F.lit("t").alias("theater_id"), (F.col("id") % 500).alias("company_id"), (F.col("id") % 400).alias("source_id"))
    listed = spark.range(400).select(F.col("id").alias("source_id"), (F.col("id") * 7).alias("performance_id"))
    out = serve.source_coverage(s, p, listed, s.select(F.col("id").alias("source_id"), F.lit("t").alias("theater_id")))
    assert {tuple(r[1:]) for r in out.collect()} == {(1, 4000, 8, 4000, 3990)}
    assert most_rows(out) <= 100_000


def test_works_of_one_title_are_looked_up_once(spark):
    """2,000 rows and 2,000 works of one title are 4 million pairs; no step may make them."""
    who = F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string"))
    rows = spark.range(2000).select("id", F.lit("Swan").alias("work"), (F.col("id") % 5 == 0).alias("work_is_story"), who.alias("choreographer_id"))
    works = spark.range(2000).select("id", F.lit("swan").alias("title"), F.when(F.col("id") % 2 == 0, who).alias("choreographer_id"), F.timestamp_seconds(9000 - F.col("id")).alias("created_at"))
    out = link.resolve_work(rows, works)
    got = {(r.work_is_story, r.choreographer_id, r.work_id) for r in out.collect()}
    assert got == {(True, None, 1999), (True, "1", 1999), (True, "2", 1999), (False, None, 1999), (False, "1", 1996), (False, "2", 1994)}
    assert most_rows(out) <= 100_000


def test_digits_inside_an_id_are_no_listing(spark):
    a, b = "11aa22bb-4000-4000-8000-000000000000", "706a7aee-7799-4f90-8d89-4d7c219048f0"
    rows = F.array(*[F.struct(F.lit(i).alias("id"), F.array(F.lit(n).cast("long")).alias("listings")) for i, n in ((a, 706), (b, 716))])
    said = spark.createDataFrame([(f"it is {b}",), ("it is 706a7aee",), ("listing 706",), ("L716, I think",), (f"{a} or {b}",)], "x string")
    for held in (False, True):
        assert [r[0] for r in said.select(duplicates.keep_id(F.col("x"), rows, F.lit(held))).collect()] == [b, b, a, b, None]


def test_known_instant_in_a_repeated_hour(spark):
    """02:30 of 27 October 1996 came twice in Paris; a row that knows its instant is not taken for the first."""
    none = lambda t: F.lit(None).cast(t)
    at = F.to_timestamp(F.lit("1996-10-27 01:30:00"))
    row = spark.range(1).select(
        "id", *[none("string").alias(c) for c in ("source_id", "theater_id", "company_id", "work_id", "work", "program", "city")], F.lit("Swan").alias("title"), none("int").alias("program_position"),
        F.lit("Europe/Paris").alias("timezone"), F.lit(dt.date(1996, 10, 27)).alias("performance_date"), F.lit("02:30").alias("performance_time"), F.lit(False).alias("time_tbc"), at.alias("starts_at"),
    )
    theaters = spark.createDataFrame([], "id string, timezone string, city string")
    minute = lambda df: link.prepare(df, theaters).select(F.date_format("minute", "HH:mm")).first()[0]
    assert (minute(row), minute(row.withColumn("starts_at", none("timestamp"))), minute(row.drop("starts_at"))) == ("01:30", "00:30", "00:30")


def test_titles_of_a_day_are_compared_once(spark):
    """1,500 staged and 1,500 published rows of one day are 2.25 million pairs; only those of alike titles may be made."""
    none, at = (lambda t: F.lit(None).cast(t)), F.to_timestamp(F.lit("1996-05-02 18:00:00"))
    title = F.concat(F.lit("show "), F.repeat(F.char(97 + F.col("id") % 20), 9))
    rows = spark.range(1500).select((F.col("id") * 2).alias("id"), title.alias("title"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("theater_id"), none("string").alias("company_id"), none("string").alias("work_id"), F.lit("UTC").alias("timezone"), F.lit("Town").alias("city"))
    staged = rows.select("*", none("string").alias("source_id"), none("string").alias("work"), none("string").alias("program"), none("int").alias("program_position"), F.lit(dt.date(1996, 5, 2)).alias("performance_date"), F.lit("18:00").alias("performance_time"), F.lit(False).alias("time_tbc"))
    theaters = spark.createDataFrame([], "id string, timezone string, city string")
    shown = rows.withColumn("id", F.col("id") + 1).withColumn("theater_id", F.concat("theater_id", F.lit("x"))).withColumn("performance_date", at).withColumn("tags", F.array().cast("array<string>"))
    out = link.link_staging(link.prepare(staged, theaters), link.published_side(shown, theaters))
    assert {(r.step, r.action, len(r.candidates)) for r in out.collect()} == {(5, "hold", 75)}
    assert most_rows(out) <= 200_000


def test_rows_of_a_day_are_no_pairs_unless_alike(spark):
    """3,000 rows of one day and city are 4.5 million pairs; only those of alike titles, companies or works may be made."""
    n, none = F.col("id"), F.lit(None).cast("string")
    title = F.concat(F.lit("show-"), F.repeat(F.char(97 + n % 20), 9), F.lit("-x"), F.repeat(F.char(97 + F.floor(n / 20).cast("int") % 20), 9))
    rows = spark.range(3000).select("id", F.lit(1).alias("day"), F.lit("x").alias("city"), F.lit(0).alias("minute"), F.lit(False).alias("tbc"), none.alias("theater"), F.when(n % 1000 == 0, "firm").alias("company"), none.alias("work"), none.alias("program"), title.alias("title"))
    out = duplicates.find_duplicate_candidates(rows, least_similarity=0.9)
    assert out.count() == 200 * (8 * 7 // 2) + 200 * (7 * 6 // 2) + sum(1 for a in range(3) for b in range(a) if (a - b) * 1000 % 400)
    assert most_rows(out) <= 300_000


def test_a_clique_is_thinned_before_rounds(spark):
    a, b = spark.range(600).select(F.col("id").alias("a_id")), spark.range(600).select(F.col("id").alias("b_id"))
    pairs = a.crossJoin(b).where("a_id < b_id and a_id % 3 = b_id % 3").unionByName(spark.createDataFrame([(7000, 7000)], "a_id long, b_id long")).coalesce(1)
    few = pairs.toDF("x", "y").mapInPandas(graph.thinner(5000), "x long, y long")
    assert few.count() == 598
    assert {(r.id, r.cluster_id) for r in graph.cluster(pairs).collect()} == {(i, i % 3) for i in range(600)} | {(7000, 7000)}


def test_protected_names_are_found_without_comparing_all(spark):
    """2,000 performances and 500 core names are a million comparisons; names are looked up instead."""
    n = F.col("id")
    p = spark.range(2000).select("id", F.lit(None).cast("string").alias("choreographer_id"), F.array().cast("array<string>").alias("member_ids"), n.alias("company_id"), F.concat(F.lit("The FIRM"), F.lpad(n.cast("string"), 5, "0"), F.lit(" of X")).alias("company_name"))
    s = spark.range(500).select(F.lit(0).alias("priority"), F.lit("Dance company").alias("kind"), F.lit(None).cast("long").alias("company_id"), F.concat(F.lit("Firm"), F.lpad((n * 2).cast("string"), 5, "0")).alias("name"))
    out = credits.protected_ids(p, spark.createDataFrame([("a", True)], "id string, protected boolean"), s)
    assert {r.id for r in out.collect()} == set(range(0, 1000, 2))
    assert "Contains(" not in plan(out)


def test_verdict_changes_join_no_images(spark):
    """A change's images come from one row: the table before and the table after are not joined."""
    frame = spark.createDataFrame
    p, lists = frame([("a", None), ("b", "x")], "id string, editorial string"), frame([("1", "a", "s", False), ("2", "b", "s", False), ("3", "b", None, False)], "id string, performance_id string, source_id string, ignored boolean")
    v = changes.verdict_changes(p, lists, frame([(9, "b")], "id long, performance_id string"), frame([(1, "b", "a")], "seq long, drop_id string, keep_id string"), frame([("b", "3")], "performance_id string, listing_id string"))
    assert all("FullOuter" not in plan(t) for t in (v.performances, v.listings, v.staging))
    told = [(r.table_name, r.key, r.op) for t in (v.performances, v.listings, v.staging) for r in t.collect()]
    assert sorted(told) == [("listings", "2", "delete"), ("listings", "3", "update"), ("performances", "a", "update"), ("performances", "b", "delete"), ("staging", "9", "update")]


def test_listings_are_ranked_by_one_move(spark):
    frame, size = spark.createDataFrame, "spark.sql.autoBroadcastJoinThreshold"
    lists = frame([("1", 1, "t", 1), ("2", 1, None, 1), ("3", 9, "t", 1)], "id string, source_id int, theater_id string, company_id int")
    before = spark.conf.get(size)
    spark.conf.set(size, "-1")
    try:
        out = survive.source_rank(lists, frame([(1, "Opera house", 0, 5)], "id int, kind string, priority int, company_id int"), frame([(1, "t"), (1, "u"), (1, "t")], "source_id int, theater_id string"))
        assert {(r.id, r.rank) for r in out.collect()} == {("1", 1), ("2", 5), ("3", 6)}
        assert plan(out.select("id", "rank")).split("Initial Plan")[0].count("Exchange hashpartitioning") <= 3
    finally:
        spark.conf.set(size, before)
