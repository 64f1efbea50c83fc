"""Kept evening groups against groups made from scratch."""

import datetime as dt

from pyspark.sql import functions as F

from footlights.operators.groups import group_evenings, header_flags
from footlights.operators.saved_groups import refresh_saved, save_groups, saved_groups

TEXT = ("ptitle", "program_title", "work_id", "choreographer_id", "choreographer_kind", "ticket_url", "image_url", "description", "company_id", "credit_line", "member_names", "work_title")


def evening_rows(spark, pairs):
    at = F.lit(dt.datetime(2026, 1, 1))
    rows = spark.createDataFrame(pairs, "id string, ek string")
    none = F.array().cast("array<string>")
    return rows.select("*", *[F.lit(None).cast("string").alias(c) for c in TEXT], F.lit(None).cast("int").alias("program_position"), none.alias("member_ids"), at.alias("starts_at"), at.alias("created_at"), F.lit(False).alias("cancelled"), none.alias("tags"), none.alias("editorial"))


def told(df):
    return sorted((r.ek, r.n_rows, tuple(r.performance_ids)) for r in df.collect() if r.n_rows > 1)


def stamps(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_batches_equal_a_fresh_start(spark, tmp_path):
    path = tmp_path / "groups"
    before = [(str(i), f"e{i // 2}") for i in range(40)]
    after = [(i, "e0" if int(i) % 7 == 0 else ek) for i, ek in before if i != "9"]
    save_groups(evening_rows(spark, before), str(path), buckets=8)
    first = stamps(path)
    changed = {(ek,) for _, ek in set(before) ^ set(after)} | {(None,)}
    keys = spark.createDataFrame(sorted(changed, key=str) * 2, "ek string")
    n = refresh_saved(str(path), evening_rows(spark, after), keys, buckets=8)
    assert told(saved_groups(spark, str(path))) == told(group_evenings(header_flags(evening_rows(spark, after))))
    singles = {r.ek for r in saved_groups(spark, str(path)).where("n_rows = 1").collect()}
    assert "e4" in singles and n <= 8
    second = stamps(path)
    refresh_saved(str(path), evening_rows(spark, after), keys, buckets=8)
    assert told(saved_groups(spark, str(path))) == told(group_evenings(header_flags(evening_rows(spark, after))))
    assert first != second


def test_other_partitions_are_not_written(spark, tmp_path):
    path = tmp_path / "groups"
    rows = evening_rows(spark, [(str(i), f"e{i // 2}") for i in range(60)])
    save_groups(rows, str(path), buckets=8)
    before = stamps(path)
    assert refresh_saved(str(path), rows, spark.createDataFrame([("e3",)], "ek string"), buckets=8) == 1
    after = stamps(path)
    assert len({f.parent for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}) == 1
    assert refresh_saved(str(path), rows, spark.createDataFrame([(None,)], "ek string"), buckets=8) == 0
    assert stamps(path) == after
    new = evening_rows(spark, [("a", "fresh"), ("b", "fresh")])
    refresh_saved(str(path), new, spark.createDataFrame([("fresh",)], "ek string"), buckets=8)
    assert ("fresh", 2, ("a", "b")) in told(saved_groups(spark, str(path)))
