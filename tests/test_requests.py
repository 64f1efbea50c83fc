"""Requests trimmed step by step, reference readings, counts of a clean-up."""

import math

import pytest
from pyspark.sql import functions as F

from footlights.operators import duplicates, readings, requests

SCHEMA = "head string, events string, feeds string, text string, venues array<string>, same array<string>, other array<string>, sitemap array<string>, fixed_tokens int"


def plain(row, limit):
    """The request as a person would write it down."""
    parts = [("Venues", "\n".join((row["venues"] or [])[: limit["venues"]])), ("Event data", (row["events"] or "")[: limit["events"]]), ("Background data", row["feeds"] or "" if limit["feeds"] else ""), ("Sitemap", "\n".join((row["sitemap"] or [])[: limit["sitemap"]]))]
    parts += [("Links", "\n".join((row["same"] or [])[: limit["same"]])), ("Links elsewhere", "\n".join((row["other"] or [])[: limit["other"]])), ("Text", (row["text"] or "")[: limit["text"]])]
    return (row["head"] or "") + "\n\n" + "".join(f"{n}:\n{b}\n\n" for n, b in parts if b)


def tokens(text):
    other = sum(ord(c) > 0x24F for c in text)
    return math.floor((len(text) - other) / 3.0 + other / 1.6) + 1


@pytest.mark.parametrize("most", [1, 5_000, 12_000, 20_000, 30_000, 85_000])
def test_first_limits_that_fit(spark, most):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    many = [f"https://example.com/{i}" for i in range(400)]
    rows = [
        ("h", "e" * 30_000, "f" * 24_000, "t" * 90_000, many, many, many, many, 2000),
        ("h", "e" * 30_000, None, "т" * 90_000, many[:3], many[:80], [], None, None),
        (None, None, None, None, None, None, None, None, None),
        ("", "", "", "", [], [], [], [], 0),
        ("h", "e", "f", "t" * 100, ["a", None], ["b"], ["c"], ["d"], 90_000),
    ]
    got = requests.trim_requests(spark.createDataFrame(rows, SCHEMA), most).collect()
    assert len(got) == len(rows)
    for r in got:
        row = {**r.asDict(), "venues": [v for v in r.venues or [] if v is not None]}
        tried = [plain(row, limit) for limit in requests.LIMITS]
        sizes = [(r.fixed_tokens or 0) + tokens(t) for t in tried]
        k = next((i for i, n in enumerate(sizes) if n <= most), len(sizes) - 1)
        assert (r.request, r.tokens, r.step) == (tried[k], sizes[k], k + 1), names


def test_reference_allowance_goes_by_order(spark):
    rows = [(5, "h", "h", "large", False), (4, "h", "h", "small", True), (3, "h", None, None, None), (1, "h", "x", "large", False), (2, None, None, "large", False), (9, "h", "h", None, None)]
    df = spark.createDataFrame(rows, "seq int, text_hash string, cached_hash string, cached_model string, has_second boolean")
    got = {r.seq: r.reference for r in readings.choose_reference(df, 2, ("large",)).collect()}
    assert got == {5: "cache", 4: "second look", 1: "fresh", 2: "fresh", 3: "none", 9: "none"}
    assert {r.reference for r in readings.choose_reference(df, 0, ("large",)).collect()} == {"cache", "second look", "none"}
    assert readings.choose_reference(df.limit(0), 2, ("large",)).count() == 0


def test_counts_of_no_rows(spark):
    none = spark.createDataFrame([], "kind string, id string, new_status string")
    assert duplicates.housekeeping_counts(none).first() == (0, 0, 0)
    one = none.unionByName(spark.range(2).select(F.lit("pair").alias("kind"), F.col("id").cast("string"), F.lit("rejected").alias("new_status")))
    assert duplicates.housekeeping_counts(one).first() == (0, 2, 0)
