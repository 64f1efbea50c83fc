"""Pages: verdicts, walls, metrics, embedded events, calendar files, sitemaps, feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut_lineage

#: Word and date patterns of pages (fixed values).
DANCE = (
    r"\b(ballet|ballett|balett|balet|baletu|balé|dance|dancers?|danse|danseurs?|tanz|tanztheater|dans|dansen|danza|dança|taniec|tance|tanec|"
    r"tánc|tanssi|choreograph\w*|chorégraph\w*|choreograf\w*|coreograf\w*)\b"
)
MONTHS = (
    "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|januar|februar|märz|maerz|mai|juni|juli|okt|dez|"
    "janvier|février|fevrier|mars|avril|juin|juillet|août|aout|septembre|octobre|novembre|décembre|decembre|"
    "januari|februari|maart|mei|augustus|gennaio|febbraio|marzo|aprile|maggio|giugno|luglio|agosto|settembre|"
    "ottobre|dicembre|enero|febrero|abril|mayo|junio|julio|septiembre|octubre|noviembre|diciembre|"
    "styczni|lutego|marca|kwietnia|maja|czerwca|lipca|sierpnia|wrze|październik|listopada|grudnia|"
    "ledna|února|března|dubna|května|června|července|srpna|září|října|listopadu|prosince|"
    "tammi|helmi|maalis|huhti|touko|kesä|heinä|elo|syys|loka|marras|joulu)"
)
DATES = rf"(\b\d{{1,2}}[./-]\d{{1,2}}(?:[./-]\d{{2,4}})?\b|\b\d{{1,2}}\.?\s+{MONTHS}|{MONTHS}\w*\.?\s+\d{{1,2}}\b|\b20\d\d-\d\d-\d\d\b)"
FEED_DATE = r"(20\d\d-[01]\d-[0-3]\d|[0-3]?\d[./][01]?\d[./]20\d\d)"
EVENT_TYPES = ("Event", "TheaterEvent", "DanceEvent", "MusicEvent", "Festival", "ScreeningEvent", "EventSeries")
#: Keys below which events lie (fixed values).
EVENT_KEYS = ("@graph", "subEvent", "event", "itemListElement", "item")
#: Marks of pages that keep robots out (fixed values).
BLOCK_TITLE = (
    r"(just a moment|attention required|access denied|403 forbidden|forbidden|you have been blocked|request rejected|pardon our interruption|"
    r"are you a robot|security check|ddos-guard|checking your browser|please wait\.\.\.|bot verification)"
)
BLOCK_MARKERS = (
    ("cloudflare", r"(challenges\.cloudflare\.com|cf-chl|cf_chl|checking your browser|verify you are human|enable javascript and cookies to continue|sorry, you have been blocked|ray id)"),
    ("imperva", r"(incapsula|_incapsula_resource|request unsuccessful|pardon our interruption)"),
    ("datadome", r"(captcha-delivery\.com|datadome)"),
    ("perimeterx", r"(px-captcha|perimeterx|press (?:and|&) hold)"),
    ("akamai", r"(errors\.edgesuite\.net|reference #\d+\.[0-9a-f]+)"),
    ("captcha", r"(g-recaptcha|h-captcha|hcaptcha\.com/1/api|are you a robot|i am not a robot|captcha)"),
    ("access denied", r"(access denied|access to this page has been denied|request blocked|not authorized)"),
)
THIN_CHARS = 1500


def page_metrics(text: Column) -> Column:
    """``struct<chars, dates, dance>``: length, number of dates and of dance words."""
    count = lambda p: F.regexp_count(text, F.lit(f"(?iu){p}"))
    return F.struct(F.length(text).alias("chars"), count(DATES).alias("dates"), count(DANCE).alias("dance"))


def page_verdict(error: Column, blocked: Column, status: Column, text: Column, n_events: Column) -> Column:
    """ROBOTS, ERROR, BLOCKED, EMPTY, NO DATES or OK, the first that holds."""
    none = F.coalesce(n_events, F.lit(0)) == 0
    return (
        F.when(F.startswith(error, F.lit("blocked by robots.txt")), "ROBOTS").when(error != "", "ERROR").when(blocked != "", "BLOCKED")
        .when(status >= 400, "ERROR").when((F.length(text) < 300) & none, "EMPTY").when(~text.rlike(f"(?iu){DATES}") & none, "NO DATES").otherwise("OK")
    )


def detect_block(status: Column, title: Column, text: Column, html: Column) -> Column:
    """Name of the wall on a page, or empty: thin pages are searched for marks, pages with much text never."""
    n = F.length(text)
    thin = n < THIN_CHARS
    marked = lambda p, doc: F.coalesce(doc.rlike(f"(?i){p}"), F.lit(False)) | F.coalesce(text.rlike(f"(?i){p}"), F.lit(False))
    by_title = F.lit("bot wall")
    for name, p in reversed(BLOCK_MARKERS):
        by_title = F.when(marked(p, html), name).otherwise(by_title)
    by_mark = F.lit("")
    for name, p in reversed(BLOCK_MARKERS):
        hit = marked(p, F.substring(html, 1, 300_000))
        hit = hit & ~((status < 400) & (n > 300)) if name == "captcha" else hit
        by_mark = F.when(hit, name).otherwise(by_mark)
    walled = F.coalesce(title.rlike(f"(?i){BLOCK_TITLE}"), F.lit(False))
    plain = F.when(by_mark != "", by_mark).when(status.isin(401, 403, 429, 503), F.concat(F.lit("HTTP "), status.cast("string"))).otherwise("")
    return F.when(n >= 2 * THIN_CHARS, "").when(~thin, "").when(walled, by_title).otherwise(plain)


def skip_reason(error: Column, blocked: Column, text: Column, n_events: Column, least: int = 300) -> Column:
    """Why a page is not read, or empty."""
    thin = (F.length(text) < least) & (F.coalesce(n_events, F.lit(0)) == 0)
    return F.when(error != "", error).when(blocked != "", F.concat(F.lit("blocked ("), blocked, F.lit(")"))).when(thin, F.concat(F.lit("empty page ("), F.length(text).cast("string"), F.lit(" characters)"))).otherwise("")


def extract_events(pages: DataFrame, html: str = "html", levels: int = 6) -> DataFrame:
    """Event objects in a page's ld+json blocks: ``(page columns without html, block, path, event json)``.

    Objects are searched through lists, @graph, subEvent, event, itemListElement and item, however deep they lie; ``block``
    and ``path`` tell where. The search goes down level by level over all pages at once. Every ``levels`` levels what is
    found and what is left are written to the shared folder, and it ends when nothing is left. Blocks that are no JSON and
    null pages give nothing.
    """
    keep = [c for c in pages.columns if c != html]
    found_blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    place = [*keep, "block", "path"]
    rest = pages.select(*keep, F.posexplode(found_blocks).alias("block", "_b")).select(*keep, "block", F.lit("$").alias("path"), F.try_parse_json("_b").alias("_v"), F.lit(False).alias("_seen")).where("_v is not null")
    done = None
    while True:
        for _ in range(levels):
            rest = rest.select(*place, F.explode(_with_children(F.col("_v"), F.col("path"), F.col("_seen"))).alias("_n")).select(*keep, "block", "_n.path", "_n._v", "_n._seen")
        rest = cut_lineage(rest, "blocks")
        here = rest.where("_seen").select(*place, F.to_json("_v").alias("event"))
        done = here if done is None else done.unionByName(here)
        rest = rest.where("not _seen")
        if rest.isEmpty():
            return done


def _with_children(v: Column, path: Column, seen: Column) -> Column:
    """A value's next level as ``array<struct<path, _v, _seen>>``; an event stays, marked as seen, beside its children."""
    node = lambda p, x, done: F.struct(p.alias("path"), x.alias("_v"), F.lit(done).alias("_seen"))
    items = F.try_variant_get(v, "$", "array<variant>")
    types = F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array(F.try_variant_get(v, "$['@type']", "string")))
    event = F.arrays_overlap(F.array_compact(types), F.array(*[F.lit(t) for t in EVENT_TYPES]))
    inner = F.array(*[node(F.concat(path, F.lit(f".{k}")), F.try_variant_get(v, f"$['{k}']", "variant"), False) for k in EVENT_KEYS])
    listed = F.transform(items, lambda x, i: node(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), x, False))
    own = F.when(event, F.array(node(path, v, True))).otherwise(F.array().cast("array<struct<path string, _v variant, _seen boolean>>"))
    below = F.filter(F.coalesce(listed, inner), lambda n: n["_v"].isNotNull())
    return F.when(seen, F.array(node(path, v, True))).otherwise(F.concat(own, below))


def read_ics(files: DataFrame, text: str = "value") -> DataFrame:
    """Events of calendar files: ``(file columns, name, start, location, url, description)``; events without a start go.

    ``start`` is a date, a UTC instant or a local time with its zone in brackets.
    """
    keep = [c for c in files.columns if c != text]
    unfolded = F.regexp_replace(F.regexp_replace(text, r"\r\n", "\n"), r"\n[ \t]", "")
    blocks = F.regexp_extract_all(unfolded, F.lit(r"(?s)(?:^|\n)BEGIN:VEVENT\n(.*?)(?:^|\n)END:VEVENT"), F.lit(1))
    rows = files.select(*keep, F.explode(blocks).alias("_b"))

    def value(name: str) -> Column:
        raw = F.regexp_extract("_b", rf"(?m)^{name}(?:;[^:\n]*)?:([^\n]*)$", 1)
        return F.replace(F.replace(F.replace(raw, F.lit("\\,"), F.lit(",")), F.lit("\\n"), F.lit(" ")), F.lit("\\;"), F.lit(";"))

    v = F.trim(value("DTSTART"))
    zone = F.regexp_extract("_b", r"(?m)^DTSTART;[^:\n]*TZID=([^;:\n]+)", 1)
    part = lambda a, n: F.substring(v, a, n)
    day = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    clock = F.concat_ws(":", part(10, 2), part(12, 2))
    valid = F.try_to_date(day).isNotNull()
    start = (
        F.when(valid & v.rlike(r"^\d{8}$"), day)
        .when(valid & v.rlike(r"^\d{8}T\d{6}Z$"), F.concat(day, F.lit("T"), clock, F.lit(":"), part(14, 2), F.lit("+00:00")))
        .when(valid & v.rlike(r"^\d{8}T\d{4,6}$"), F.concat(day, F.lit("T"), clock, F.lit(":00"), F.when(zone != "", F.concat(F.lit(" ("), zone, F.lit(")"))).otherwise("")))
    )
    text_of = lambda n: F.nullif(value(n), F.lit(""))
    return rows.select(*keep, text_of("SUMMARY").alias("name"), start.alias("start"), text_of("LOCATION").alias("location"), text_of("URL").alias("url"), F.substring(text_of("DESCRIPTION"), 1, 300).alias("description")).where("start is not null")


def read_sitemaps(files: DataFrame, text: str = "value") -> DataFrame:
    """Entries of sitemaps: ``(file columns, kind, loc, lastmod)``; kind page or sitemap."""
    keep = [c for c in files.columns if c != text]
    plain = lambda c: F.replace(c, F.lit("&amp;"), F.lit("&"))
    one = files.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))).alias("_b"))
    loc = F.regexp_extract("_b", r"(?i)<loc>\s*([^<\s]+)\s*</loc>", 1)
    pages = one.select(*keep, F.lit("page").alias("kind"), plain(loc).alias("loc"), F.substring(F.regexp_extract("_b", r"(?i)<lastmod>\s*([^<\s]+)\s*</lastmod>", 1), 1, 10).alias("lastmod")).where("loc <> ''")
    child = F.explode(F.regexp_extract_all(text, F.lit(r"(?i)<sitemap>\s*<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)))
    maps = files.select(*keep, child.alias("_c")).select(*keep, F.lit("sitemap").alias("kind"), plain(F.col("_c")).alias("loc"), F.lit("").alias("lastmod"))
    return pages.unionByName(maps)


def top_sitemap_pages(entries: DataFrame, site: str, most: int = 200) -> DataFrame:
    """The newest distinct pages of each site."""
    newest = entries.where("kind = 'page'").groupBy(site, "loc").agg(F.max("lastmod").alias("lastmod"))
    return newest.withColumn("_r", F.row_number().over(Window.partitionBy(site).orderBy(F.desc("lastmod"), "loc"))).where(F.col("_r") <= most).drop("_r")


def top_feeds(feeds: DataFrame, page: str = "page_id", most: int = 3, least_dates: int = 2, most_bytes: int = 3_000_000, cut: int = 8000) -> DataFrame:
    """The feeds of each page with most dates: ``(page, url, n_dates, text)``; white space is collapsed and the text cut."""
    rows = feeds.withColumn("n_dates", F.regexp_count("text", F.lit(FEED_DATE))).where((F.col("n_dates") >= least_dates) & (F.length("text") < most_bytes))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(page).orderBy(F.desc("n_dates"), "url"))).where(F.col("_r") <= most)
    return rows.select(page, "url", "n_dates", F.substring(F.regexp_replace("text", r"\s+", " "), 1, cut).alias("text"))


def report_counts(rows: DataFrame, status: str = "verdict") -> DataFrame:
    """Rows of each status and the problems among them."""
    return rows.groupBy(status).agg(F.count("*").alias("n")).withColumn("problem", F.col(status) != "OK")
