"""Value tables of the column builders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footlights.functions import countries, text, times, urls


def value(spark, build, *args):
    """The value of a column builder on literal arguments."""
    df = spark.createDataFrame([tuple(args)], ", ".join(f"a{i} {'int' if isinstance(a, int) and not isinstance(a, bool) else 'string'}" for i, a in enumerate(args)) or "x int")
    return df.select(build(*[F.col(f"a{i}") for i in range(len(args))])).first()[0]


@pytest.mark.parametrize("given, want", [("Œdipe à l'Élysée!", "oedipe-a-l-elysee"), ("  ", ""), (None, ""), ("Straße 7", "strasse-7")])
def test_slugify(spark, given, want):
    assert value(spark, text.slugify, given) == want


def test_similarity(spark):
    assert round(value(spark, text.similarity, "word", "two-words"), 6) == 0.363636
    assert value(spark, text.similarity, "", "") == 0
    assert value(spark, text.title_close, "Afanador", "Afanador - Ballet Nacional") is True


@pytest.mark.parametrize(
    "line, want",
    [
        ("Anna Berg / Lars Holm", ["Anna Berg", "Lars Holm"]),
        ("Pierre Lacotte after Joseph Mazilier", ["Pierre Lacotte"]),
        ("Club Guy & Roni (Kor'sia)", ["Club Guy", "Roni", "Kor'sia"]),
        ("Choreography: Mia Li and NDT", ["Mia Li"]),
        ("Xie Xin, the dancers", ["Xie Xin"]),
        (None, []),
    ],
)
def test_credit_line(spark, line, want):
    assert value(spark, text.split_credit_line, line) == want


@pytest.mark.parametrize(
    "given, want",
    [("Doors 19.30 pm", True), ("at 19h30", True), ("at 7:30 pm", True), ("119:30", False), ("", False)],
)
def test_time_seen(spark, given, want):
    assert value(spark, text.time_seen, "19:30", given) is want


def test_fingerprint_ignores_noise(spark):
    a = value(spark, text.page_fingerprint, "Giselle\n1 Oct\nToday")
    assert a == value(spark, text.page_fingerprint, "1 Oct Sold out\nGiselle\nfew tickets left")
    assert a != value(spark, text.page_fingerprint, "Giselle\n2 Oct")


def test_estimate_tokens(spark):
    assert [value(spark, text.estimate_tokens, t) for t in ("", "abc", "афиша", None)] == [0, 2, 4, 0]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://www.site.org/en/show/?utm_source=x&b=2&a=1#top", "site.org/show?a=1&b=2"),
        ("http://site.org/fr/show", "site.org/show"),
        ("https://site.org", "site.org/"),
    ],
)
def test_page_key(spark, url, want):
    assert value(spark, urls.page_key, url) == want


@pytest.mark.parametrize("url, want", [("https://a.b.co.uk/x", "b.co.uk"), ("https://www.opera.fr:443/", "opera.fr"), (None, ""), ("localhost", "")])
def test_site_family(spark, url, want):
    assert value(spark, urls.site_family, url) == want


@pytest.mark.parametrize(
    "url, first, n",
    [
        ("https://x.org/c?month=2026-11", "https://x.org/c?month=2026-12", 10),
        ("https://x.org/c/2026/9/", "https://x.org/c/2026/10/", 12),
        ("https://x.org/c?luna=11&anul=2026", "https://x.org/c?luna=12&anul=2026", 10),
        ("https://x.org/c/202611", "https://x.org/c/202612", 10),
        ("https://x.org/show", None, 0),
    ],
)
def test_month_series(spark, url, first, n):
    got = value(spark, lambda u: urls.month_series(u, dt.date(2026, 9, 24), 12), url)
    assert len(got) == n and (got[0] if got else None) == first


def test_widen_feed(spark):
    day = dt.date(2026, 9, 24)
    got = value(spark, lambda u: urls.widen_feed_url(u, day, 10), "https://x.org/api?from=2026-09-01&to=2026-09-08&v=1")
    assert got == "https://x.org/api?from=2026-09-24&to=2026-10-04&v=1"
    assert value(spark, lambda u: urls.widen_feed_url(u, day, 10), "https://x.org/api?q=1") is None


@pytest.mark.parametrize(
    "url, mod, want",
    [
        ("https://x.org/event/giselle", "", True),
        ("https://x.org/archive/event/giselle", "", False),
        ("https://x.org/season/2023-24/ballet", "", False),
        ("https://x.org/season/2026-27/ballet", "", True),
        ("https://x.org/event/old", "2024-01-01", False),
    ],
)
def test_event_like(spark, url, mod, want):
    assert value(spark, lambda u, m: urls.event_like(u, m, dt.date(2026, 9, 24)), url, mod) is want


def test_start_instant_and_zones(spark):
    df = spark.sql("select date'2026-03-29' d, '19:30' t, 'Europe/Paris' z, 2 p")
    got = df.select(F.date_format(times.start_instant(F.col("d"), F.col("t"), F.col("z"), F.col("p"), F.lit(True)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert got == "2026-03-29 17:30:01"
    zone = lambda *a: value(spark, lambda o, c, d, z, sc: times.choose_timezone(o, c, F.to_date(d), z, sc, dt.date(2026, 10, 1)), *a)
    assert zone("Europe/Lisbon", "Spain", "2026-10-01", "Europe/Lisbon", "Portugal") == "Europe/Madrid"
    assert zone(None, "Japan", "2026-10-01", "Europe/Paris", "France") == "Asia/Tokyo"
    assert zone(None, "", "2026-10-01", "Europe/Paris", "France") == "Europe/Paris"
    assert zone("Mars/Base", "Germany", "2026-10-01", "Europe/Paris", "France") == "Europe/Berlin"
    assert zone("Asia/Tokyo", "Germany", None, "Europe/Paris", "France") == "Europe/Berlin"


@pytest.mark.parametrize("days, found, when, want", [(30, 1, "2026-10-22", 7), (30, 0, "2026-11-01", 17), (30, 0, "2027-03-03", 60), (0, 0, "2026-11-01", 0), (7, 0, "2027-03-03", 30), (30, 0, "2026-09-01", 1)])
def test_announcement_days(spark, days, found, when, want):
    assert value(spark, lambda d, f, w: times.announcement_days(d, f, F.to_date(w), dt.date(2026, 10, 16), F.when(d == 7, 0).otherwise(2)), days, found, when) == want


def test_countries(spark):
    rows = spark.createDataFrame([("the Netherlands",), ("U.S.A.",), ("Lyon, FR",), ("Narnia",), (" ",)], "c string")
    assert [r.country_name for r in countries.normalize_country(rows, "c").collect()] == ["Netherlands", "United States", "France", "Narnia", None]


def test_excerpt(spark):
    body = "x" * 3000 + " Giselle " + "y" * 9000
    got = value(spark, lambda t: text.excerpt(t, F.array(F.lit("giselle"))), body)
    assert got == body[2401 : 3001 + 7 + 900] and len(got) == 1507
    assert "Giselle" in got and len(got) < 1600


def test_references_and_case_words(spark):
    assert value(spark, text.html_text, "<p>Caf&eacute; &#233;&#xe9; &lt;b&gt; &amp;amp; &nosuch; &hellip;&nbsp;x</p><script>no</script>") == "Café éé <b> &amp; &nosuch; … x"
    assert spark.sql("select array('The Swan', null, 'swan of X') as t").select(text.case_words(F.col("t"))).first()[0] == ["The", "Swan", "swan", "of", "X"]
