"""Data checks and scoped removals. The rules of ``data_checks`` are our own reading of what such checks report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import slugify
from .link import suppress


def data_checks(listing: DataFrame, companies: DataFrame) -> DataFrame:
    """Doubtful rows: ``(check, id)``. Checks: ``odd hour`` (a known start from 1 to 8), ``no venue``, ``title is company``,
    ``two cities`` (a company's shows at one start in different cities).

    listing: id, title, company_id, theater_id, city, local_hour, time_tbc, performance_date; companies: id, name.
    """
    named = listing.join(companies.select(F.col("id").alias("_c"), slugify(F.col("name")).alias("_n")), F.col("company_id") == F.col("_c"), "left")
    tests = {
        "odd hour": ~F.col("time_tbc") & F.col("local_hour").between(1, 8),
        "no venue": F.col("theater_id").isNull(),
        "title is company": F.coalesce(slugify(F.col("title")) == F.col("_n"), F.lit(False)),
    }
    told = F.array_compact(F.array(*[F.when(cond, name) for name, cond in tests.items()]))
    single = named.select(F.explode(told).alias("check"), "id")
    away = listing.where("company_id is not null and city is not null and not time_tbc").groupBy("company_id", "performance_date").agg(F.count_distinct("city").alias("n")).where("n > 1")
    both = listing.where("city is not null and not time_tbc").join(away, ["company_id", "performance_date"], "left_semi").select(F.lit("two cities").alias("check"), "id")
    return single.unionByName(both)


def suggested_sources(listing: DataFrame, sources: DataFrame, least: int = 5) -> DataFrame:
    """Theaters with ``least`` or more shows that no source speaks for: ``(theater_id, n)``. sources: theater_id."""
    n = listing.where("theater_id is not null").groupBy("theater_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return n.join(sources.select("theater_id"), "theater_id", "left_anti")


def runs_without_dates(runs: DataFrame, as_of: str) -> DataFrame:
    """Runs that are not over and have no or one date only. runs: run_id, end, found."""
    return runs.where((F.col("end") >= as_of) & (F.col("found") <= 1)).select("run_id", "found")


def scope_removals(candidates: DataFrame, protected: DataFrame, performances: DataFrame, listings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Carry out approved removals: ``(remaining performances, new suppressions, counts by verdict)``.

    candidates: drop_id, verdict; protected: id. Protected rows stay and are counted as ``protected``; the others are
    suppressed for every site that lists them and taken out by an anti join.
    """
    kept = candidates.join(protected.select(F.col("id").alias("drop_id")), "drop_id", "left_semi")
    gone = candidates.join(protected.select(F.col("id").alias("drop_id")), "drop_id", "left_anti")
    rows = performances.join(gone.select(F.col("drop_id").alias("id")).distinct(), "id", "left_semi")
    rules = suppress(rows, listings, "out of scope")
    counts = gone.select("verdict").unionByName(kept.select(F.lit("protected").alias("verdict"))).groupBy("verdict").agg(F.count("*").alias("n"))
    return performances.join(rows.select("id"), "id", "left_anti"), rules, counts
