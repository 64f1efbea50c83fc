"""What is sent to a reader for a page, trimmed until it fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import estimate_tokens, once

#: What a request may hold at each step (fixed values): numbers of venues, links, links elsewhere and addresses of the
#: sitemap, characters of event data and of page text, and whether background data goes along.
LIMITS = (
    {"venues": 300, "same": 300, "other": 80, "sitemap": 200, "events": 20_000, "text": 60_000, "feeds": True},
    {"venues": 150, "same": 300, "other": 20, "sitemap": 60, "events": 20_000, "text": 60_000, "feeds": True},
    {"venues": 150, "same": 120, "other": 20, "sitemap": 60, "events": 8_000, "text": 60_000, "feeds": False},
    {"venues": 150, "same": 120, "other": 20, "sitemap": 60, "events": 8_000, "text": 30_000, "feeds": False},
    {"venues": 150, "same": 60, "other": 20, "sitemap": 60, "events": 3_000, "text": 15_000, "feeds": False},
)
MOST_TOKENS = 85_000


#: The parts of a page that a request is made of.
PARTS = ("head", "events", "feeds", "text", "venues", "same", "other", "sitemap", "fixed_tokens")


def request_text(page: Column, limit: Column) -> Column:
    """A page's request under one set of limits; parts that are null or empty are left out."""

    def part(label: str, body: Column) -> Column:
        return F.when(F.length(body) > 0, F.concat(F.lit(f"{label}:\n"), body, F.lit("\n\n"))).otherwise("")

    lines = lambda c: F.array_join(F.slice(page[c], F.lit(1), limit[c]), "\n")
    cut = lambda c: F.substr(page[c], F.lit(1), limit[c])
    parts = [part("Venues", lines("venues")), part("Event data", cut("events")), part("Background data", F.when(limit["feeds"], page["feeds"])), part("Sitemap", lines("sitemap"))]
    parts += [part("Links", lines("same")), part("Links elsewhere", lines("other")), part("Text", cut("text"))]
    return F.concat(F.coalesce(page["head"], F.lit("")), F.lit("\n\n"), *parts)


def trim_requests(pages: DataFrame, most: int = MOST_TOKENS) -> DataFrame:
    """Add ``request, tokens, step`` (from 1): the first set of limits under which the estimate fits, else the last.

    pages: head, events, feeds, text (strings), venues, same, other, sitemap (arrays of strings), fixed_tokens (null: 0).
    A fold over the sets within a row, whose parts are computed once; a text is only built anew where the one before was too
    long.
    """
    sets = F.array(*[F.struct(F.lit(k + 1).alias("step"), *[F.lit(v).alias(n) for n, v in limit.items()]) for k, limit in enumerate(LIMITS)])
    fixed = lambda page: F.coalesce(page["fixed_tokens"].cast("long"), F.lit(0).cast("long"))
    state = lambda request, tokens, step: F.struct(request.alias("request"), tokens.cast("long").alias("tokens"), step.cast("int").alias("step"))
    none = state(F.lit(None).cast("string"), F.lit(None), F.lit(0))
    fits = lambda page, acc, limit: F.when(acc["tokens"] <= most, acc).otherwise(once(request_text(page, limit), lambda t: state(t, fixed(page) + estimate_tokens(t), limit["step"])))
    tried = once(F.struct(*PARTS), lambda page: F.aggregate(sets, none, lambda acc, limit: fits(page, acc, limit)))
    return pages.withColumn("_t", tried).select(*pages.columns, "_t.request", "_t.tokens", "_t.step")
