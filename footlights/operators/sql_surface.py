"""What SQL text can call: scalar functions made from the builders, and the public pages as a table function."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions import sql, text, times, urls
from .duplicates import unsure_recently
from .groups import evening_key
from .survive import is_venue_source, rank_of

#: Name to (arguments, returned type, builder).
SCALAR = {
    "unaccent": ("t string", "string", text.unaccent),
    "slugify": ("t string", "string", text.slugify),
    "title_similarity": ("a string, b string", "double", lambda a, b: text.similarity(text.slugify(a), text.slugify(b))),
    "title_close": ("a string, b string", "boolean", text.title_close),
    "without_bracket": ("t string", "string", text.without_bracket),
    "piece_title": ("title string, program string", "string", text.piece_title),
    "is_generic_title": ("title string, company string", "boolean", text.is_generic_title),
    "split_credit_line": ("line string", "array<string>", text.split_credit_line),
    "is_venue_source": ("kind string", "boolean", is_venue_source),
    "source_rank": ("known boolean, kind string, tier int, speaks boolean, own boolean", "int", rank_of),
    "evening_key": ("program string, own string, theater string, starts_at timestamp", "string", evening_key),
    "unsure_recently": ("note string, as_of date", "boolean", unsure_recently),
    "minutes_of_day": ("t string", "int", times.minutes),
    "page_key": ("url string", "string", urls.page_key),
    "site_family": ("url string", "string", urls.site_family),
}


def create_scalar_functions(spark: SparkSession) -> None:
    """All scalar functions, as temporary functions of the session."""
    sql.create_functions(spark, SCALAR)


def create_sitemap_function(spark: SparkSession) -> None:
    """``sitemap_entries(as_of)`` as a table function over the session's views performances, choreographers, companies,
    theaters and programs, whose columns are those of ``serve.sitemap_entries``."""
    parts = ["select 'performance' as kind, x.slug, x.lastmod from (select min_by(struct(slug, coalesce(updated_at, created_at) as lastmod), struct(coalesce(program_position, 2147483647) as p, performance_date, created_at, id)) as x from performances where slug is not null and performance_date >= as_of group by evening_key)"]
    parts.append("select 'choreographer', slug, coalesce(updated_at, created_at) from choreographers c left semi join (select explode(member_ids) as m from performances where performance_date >= as_of) u on c.id = u.m where slug is not null")
    for kind, view in (("company", "companies"), ("theater", "theaters"), ("program", "programs")):
        parts.append(f"select '{kind}', slug, coalesce(updated_at, created_at) from {view} t left semi join (select {kind}_id as m from performances where performance_date >= as_of) u on t.id = u.m where slug is not null")
    spark.sql(f"create or replace temporary function sitemap_entries(as_of timestamp) returns table (kind string, slug string, lastmod timestamp) return {' union all '.join(parts)}")
