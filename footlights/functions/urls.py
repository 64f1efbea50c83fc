"""Address functions as column builders."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

#: Tokens in the host of third-party ticket sellers (fixed values).
TICKET_SELLERS = (
    "ticketmaster.", "eventim.", "seetickets.", "fnacspectacles.", "ticketone.", "entradas.com", "ticketcorner.",
    "reservix.", "ticketswap.", "viagogo.", "stubhub.", "ticketportal.", "billetto.", "eventbrite.", "songkick.",
    "bandsintown.", "todaytix.", "atgtickets.", "ticketline.", "giletjaune.", "digitick.", "billetreduc.",
    "ticketea.", "eticket.", "ticketsource.", "ticketweb.", "axs.com", "livenation.", "gigantic.",
    "skiddle.", "fever", "ticketpro.", "biletix.", "kupbilecik.", "ebilet.", "goout.", "ticketstream.",
    "oeticket.", "myticket.", "adticket.", "ticketonline.", "tix.", "ticket.fi", "lippu.fi", "tiketti.",
    "billetlugen.", "billettservice.", "ticnet.", "ticketmaster", "ticket-online.", "vivaticket.", "boxol.",
    "kartenhaus.", "tickets.com", "teaterbilletter.",
)
#: Tokens in the host of resellers and listing sites (fixed values).
AGGREGATORS = (
    "teaterbilletter.", "viagogo.", "stubhub.", "ticketswap.", "songkick.", "bandsintown.", "todaytix.", "billetreduc.", "fever",
    "gigsberg.", "seatgeek.", "ticketnetwork.",
)
#: Second-level labels under which sites register (fixed values).
SECOND_LEVEL = ("co", "com", "org", "gov", "ac", "net", "gob", "gouv", "edu")
#: Query keys that only track (fixed values).
TRACKING = r"^(?i)(utm_[a-z]+|fbclid|gclid|dclid|msclkid|mc_cid|mc_eid|_ga|_gl|igshid|ref|source)$"
#: Language segments at the beginning of a path (fixed values).
LANGUAGE_SEGMENT = (
    r"(?i)^/(en|fr|de|nl|it|es|pt|pl|cs|cz|hu|sv|se|da|dk|no|nb|fi|et|lv|lt|el|gr|ru|tr|ca|eu|sl|sk|hr|ro|bg|sr|uk|ua|is|ga|lb|mt)"
    r"(?:[-_][a-z]{2})?(?=/|$)"
)
#: Query keys of months, years and date windows (fixed values).
MONTH_KEYS = "month|monat|mois|mes|maand|mese|luna|miesiac|mesic|kuukausi|maaned|manad|m"
YEAR_KEYS = "year|jahr|annee|anno|ano|jaar|anul|rok|vuosi|ar|y"
FROM_KEYS = "from|start|startdate|start_date|datefrom|date_from|fromdate|from_date|begin|von|du|desde|da|van|od|after|since|mindate|min_date"
TO_KEYS = "to|end|enddate|end_date|dateto|date_to|todate|to_date|until|bis|au|hasta|a|tot|do|before|maxdate|max_date"
#: Words in the path of event pages, and of pages that are not (fixed values).
EVENT_PATH = (
    "event|evenement|veranstaltung|spielplan|production|produktion|spectacle|voorstelling|forestilling|"
    "f[oö]rest[aä]llning|programm|program|agenda|kalender|calendar|calendrier|show|performance|st[uü]ck|obra|"
    "espectaculo|espect[aá]culo|spettacolo|ballet|ballett|balet|danse|dance|tanz|dans|danza|dan[cç]a|taniec|"
    "tanec|tanssi|repertoire|repertoar|season|saison|seizoen|stagione|temporada|sezon|whats-on|what-s-on|"
    "afisha|afisa|afiša|afiche|plakat|spektakl|spektakli|predstav|vystav|vistav|repertuar|raspored|spored|izved|izrad|"
    "wydarzen|wystep|występ|udalost|události|akce|podujat|program|musor|műsor|eloadas|előadás|esity|ohjelmisto|"
    "tapahtum|renginiai|renginys|pasakum|pasākum|izrād|etendus|sundmus|sündmus|evenimen|spectacol|reprezentat|"
    "ekdilos|parastas|etkinlik|gosteri|gösteri|oyun|balett|baletas|balets|baletti|bale|"
    "афиш|спектакл|репертуар|представлен|вистав|події|подiї|балет|танц|събити|изведб|претстав|"
    "παράστασ|εκδήλωσ|μπαλέτο|χορ"
)
OTHER_PATH = "archiv|archive|news|nieuws|actualit|press|presse|blog|artist|kuenstler|people|team|job|vacature|education|workshop|kurs|class"


def host(url: Column) -> Column:
    """Host with port, lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)


def decoded(c: Column) -> Column:
    """Percent-decoded text; a plus sign stays, broken escapes leave the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def has_token(url: Column, tokens: tuple[str, ...]) -> Column:
    """Whether the host contains one of the tokens."""
    h = host(url)
    return F.exists(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(h, t))


def is_ticket_seller(url: Column) -> Column:
    return has_token(url, TICKET_SELLERS)


def is_aggregator(url: Column) -> Column:
    return has_token(url, AGGREGATORS)


def ticket_link(ticket: Column, detail: Column) -> Column:
    """The booking link; an aggregator's is replaced by the detail page unless that is one as well."""
    own = F.when(~is_aggregator(detail), F.nullif(detail, F.lit("")))
    return F.when(is_aggregator(ticket), own).otherwise(ticket)


def site_family(url: Column) -> Column:
    """Last two labels of the host, three under a shared second level."""
    labels = F.filter(F.split(F.regexp_extract(host(url), r"^[^:]*", 0), r"\."), lambda p: p != "")
    n = F.size(labels)
    take = F.when((n >= 3) & F.element_at(labels, F.greatest(n, F.lit(2)) - 1).isin(*SECOND_LEVEL), 3).otherwise(F.least(n, F.lit(2)))
    return F.array_join(F.when(n > 0, F.slice(labels, n - take + 1, take)).otherwise(F.array().cast("array<string>")), ".")


def query_pairs(url: Column) -> Column:
    """Query parameters in order: ``array<struct<k, v>>``, decoded."""
    parts = F.filter(F.split(query(url), "&"), lambda p: p != "")
    plain = lambda c: F.coalesce(F.try_url_decode(c), c)
    return F.transform(parts, lambda p: F.struct(plain(F.regexp_extract(p, "^[^=]*", 0)).alias("k"), plain(F.regexp_extract(p, "=(.*)$", 1)).alias("v")))


def page_key(url: Column) -> Column:
    """One key for the same page: no scheme, www, trailing slash, language segment or tracking; query sorted."""
    h = F.regexp_replace(host(F.trim(url)), r"^www\.", "")
    p = F.regexp_replace(decoded(path(F.trim(url))), "/+$", "")
    p = F.regexp_replace(F.when(p == "", "/").otherwise(p), LANGUAGE_SEGMENT, "")
    p = F.when(p == "", "/").otherwise(p)
    kept = F.array_sort(F.filter(query_pairs(F.trim(url)), lambda x: ~x["k"].rlike(TRACKING)))
    q = F.array_join(F.transform(kept, lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")
    return F.concat(h, F.lower(p), F.when(F.size(kept) > 0, F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def same_address_key(url: Column) -> Column:
    """One spelling of an address: path decoded, query normalised, no fragment."""
    bare = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    encode = lambda c: F.replace(F.replace(F.replace(F.url_encode(c), F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":")), F.lit("%2C"), F.lit(","))
    q = F.array_join(F.transform(query_pairs(url), lambda x: F.concat(encode(x["k"]), F.lit("="), encode(x["v"]))), "&")
    return F.concat(bare, decoded(path(url)), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


# ---- calendars by month -------------------------------------------------------------------------------------------

#: Forms of a month in one query value or in the path: pattern, group of the year, group of the month, new text
#: (fixed values; {y} and {m} are the new year and two-digit month).
MONTH_FORMS = (
    (r"([?&][^=&#]+=)(20\d\d)-(\d{2})-\d{2}(?=&|#|$)", 2, 3, "{1}{y}-{m}-01"),
    (r"([?&][^=&#]+=)\d{2}-(\d{2})-(20\d\d)(?=&|#|$)", 3, 2, "{1}01-{m}-{y}"),
    (r"([?&][^=&#]+=)\d{2}\.(\d{2})\.(20\d\d)(?=&|#|$)", 3, 2, "{1}01.{m}.{y}"),
    (r"([?&][^=&#]+=)(20\d\d)-(\d{2})(?=&|#|$)", 2, 3, "{1}{y}-{m}"),
    (r"([?&][^=&#]+=)(\d{2})-(20\d\d)(?=&|#|$)", 3, 2, "{1}{m}-{y}"),
    (r"([?&][^=&#]+=)(20\d\d)(\d{2})(?=&|#|$)", 2, 3, "{1}{y}{m}"),
    (r"(/)(20\d\d)/(\d{1,2})(?=/|$|\?|#)", 2, 3, "{1}{y}/{m}"),
    (r"(/)(20\d\d)-(\d{1,2})(?=/|$|\?|#)", 2, 3, "{1}{y}-{m}"),
    (r"(/)(20\d\d)(\d{2})(?=/|$|\?|#|\.html?$)", 2, 3, "{1}{y}{m}"),
)


_YEAR, _MONTH = "\x01", "\x02"  # places of the year and the month in a template


def _month_of(url: Column) -> Column:
    """``struct<year int, month int, template string, wide boolean>`` of the first fitting form, else null.

    The template is the address with places for year and month, so that other months need no regular expression;
    ``wide``: the month has two digits.
    """
    month_key, year_key = rf"(?i)([?&](?:{MONTH_KEYS})=)(\d{{1,2}})(?=&|#|$)", rf"(?i)([?&](?:{YEAR_KEYS})=)(20\d\d)(?=&|#|$)"
    m2, y2 = F.regexp_extract(url, month_key, 2), F.regexp_extract(url, year_key, 2)
    both = F.regexp_replace(F.regexp_replace(url, month_key, f"$1{_MONTH}"), year_key, f"$1{_YEAR}")
    told = lambda y, m, template, wide: F.struct(y.try_cast("int").alias("year"), m.try_cast("int").alias("month"), template.alias("template"), wide.alias("wide"))
    by_key = F.when((m2 != "") & (y2 != "") & m2.try_cast("int").between(1, 12), told(y2, m2, both, F.length(m2) == 2))

    def form(pattern: str, y: int, m: int, new: str) -> Column:
        # one expression gives what is before, the groups and what is after
        groups = re.compile(pattern).groups
        parts = F.split(F.regexp_replace(url, rf"(?s)^(.*?){pattern}(.*)$", "\x03".join(f"${k}" for k in range(1, groups + 3))), "\x03")

        def read(p: Column) -> Column:
            inside = [{"{1}": F.get(p, F.lit(1)), "{y}": F.lit(_YEAR), "{m}": F.lit(_MONTH)}.get(t, F.lit(t)) for t in _tokens(new)]
            month = F.get(p, F.lit(m))
            fits = (F.size(p) > 1) & month.try_cast("int").between(1, 12)
            return F.when(fits, told(F.get(p, F.lit(y)), month, F.concat(F.get(p, F.lit(0)), *inside, F.get(p, F.lit(groups + 1))), F.length(month) == 2))

        return once(parts, read)

    in_query, in_path = ([form(*f) for f in MONTH_FORMS if f[0].startswith("([?&]") == q] for q in (True, False))
    asked = F.contains(url, F.lit("?")) | F.contains(url, F.lit("&"))
    return F.when(F.contains(url, F.lit("20")), F.coalesce(F.when(asked, F.coalesce(by_key, *in_query)), *in_path))


def _month_address(own: Column, year: Column, month: Column) -> Column:
    """The same calendar's address for another month."""
    shown = F.when(own["wide"], F.lpad(month.cast("string"), 2, "0")).otherwise(month.cast("string"))
    return F.replace(F.replace(own["template"], F.lit(_YEAR), year.cast("string")), F.lit(_MONTH), shown)


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(r"(\{1\}|\{y\}|\{m\})", text) if t]


def month_series(url: Column, today: dt.date, months_ahead: int = 12) -> Column:
    """Addresses of the months after a calendar page's own, up to ``months_ahead`` from ``today`` (at most 24).

    An address that is no month of a calendar gives an empty array.
    """
    last = today.year * 12 + today.month - 1 + months_ahead

    def series(own: Column) -> Column:
        first = own["year"] * 12 + own["month"]  # months since year 0, the next month's number
        numbers = F.when(first <= last, F.sequence(first, F.least(F.lit(last), first + 23)))
        return F.transform(numbers, lambda k: _month_address(own, F.floor(k / 12).cast("int"), (k % 12 + 1).cast("int")))

    return F.coalesce(once(once(url, _month_of), series), F.array().cast("array<string>"))


def month_now(url: Column, today: dt.date) -> Column:
    """A calendar page of a month that has passed becomes this month's; other addresses stay."""

    def moved(own: Column) -> Column:
        past = own["year"] * 12 + own["month"] < today.year * 12 + today.month
        return F.when(past, _month_address(own, F.lit(today.year), F.lit(today.month)))

    return F.coalesce(once(once(url, _month_of), moved), url)


def widen_feed_url(url: Column, today: dt.date, days: int = 365) -> Column:
    """A feed asked for a window of dates (from, to) becomes the same feed from today on for ``days``.

    Null for addresses without both parameters in one of the seven known formats, or if the end is that already.
    """

    def moved(value: Column, day: dt.date) -> Column:
        seconds = str(int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()))
        return (
            F.when(value.rlike(r"^20\d\d-\d{2}-\d{2}$"), day.isoformat())
            .when(value.rlike(r"^20\d\d-\d{2}-\d{2}T[\d:.]+Z?$"), F.concat(F.lit(day.isoformat()), F.substring(value, 11, 99)))
            .when(value.rlike(r"^\d{2}\.\d{2}\.20\d\d$"), day.strftime("%d.%m.%Y"))
            .when(value.rlike(r"^\d{2}/\d{2}/20\d\d$"), day.strftime("%d/%m/%Y"))
            .when(value.rlike(r"^20\d{6}$"), day.strftime("%Y%m%d"))
            .when(value.rlike(r"^1\d{9}$"), seconds)
            .when(value.rlike(r"^1\d{12}$"), seconds + "000")
        )

    key = lambda x: F.lower(F.replace(x["k"], F.lit("-"), F.lit("")))
    fits = lambda x, keys: key(x).rlike(f"^(?:{keys})$") & moved(x["v"], today).isNotNull()
    pairs = query_pairs(url)
    start = F.get(F.filter(pairs, lambda x: fits(x, FROM_KEYS)), F.lit(0))
    end = F.get(F.filter(pairs, lambda x: fits(x, TO_KEYS)), F.lit(0))
    later = today + dt.timedelta(days=days)

    def value(x: Column) -> Column:
        return F.when(x["k"] == start["k"], moved(x["v"], today)).when(x["k"] == end["k"], moved(x["v"], later)).otherwise(x["v"])

    plain = lambda c: F.replace(F.replace(F.url_encode(c), F.lit("%3A"), F.lit(":")), F.lit("%2B"), F.lit("+"))
    q = F.array_join(F.transform(pairs, lambda x: F.concat(plain(x["k"]), F.lit("="), plain(value(x)))), "&")
    wide = F.concat(F.regexp_extract(url, r"^[^?]*\?", 0), q, F.regexp_extract(url, "#.*$", 0))
    return F.when(start.isNotNull() & end.isNotNull() & (end["v"] != moved(end["v"], later)), wide)


def event_like(url: Column, lastmod: Column, today: dt.date) -> Column:
    """Whether a sitemap address is an event page of this or the next season."""
    p = F.lower(decoded(path(url)))
    current = today.year - (1 if today.month < 8 else 0)
    whole = F.regexp_extract_all(p, F.lit(r"(?<!\d)20\d\d(?:[-/_]?(?:20)?\d\d)?(?!\d)"), F.lit(0))

    def old(s: Column) -> Column:
        year, end = F.substring(s, 1, 4).cast("int"), F.substring(s, -2, 2).cast("int")
        season = (F.length(s) > 4) & (end == (year + 1) % 100)
        return F.when(season, F.when(F.regexp_replace(s, r"\D", "").rlike(r"^20\d\d20\d\d$"), F.lit(2000) + end).otherwise(F.lit(2000) + end) <= current).otherwise(year < current)

    short = F.regexp_extract_all(p, F.lit(r"(?<!\d)\d\d[-_/]\d\d(?!\d)"), F.lit(0))
    short_old = lambda s: (F.substring(s, 4, 2).cast("int") == (F.substring(s, 1, 2).cast("int") + 1) % 100) & (F.lit(2000) + F.substring(s, 4, 2).cast("int") <= current)
    stale = F.coalesce(F.try_to_date(F.when(lastmod.rlike(r"^\d{4}-\d{2}-\d{2}$"), lastmod)) < F.lit(today - dt.timedelta(days=540)), F.lit(False))
    return p.rlike(f"(?iu)({EVENT_PATH})") & ~p.rlike(f"({OTHER_PATH})") & ~F.exists(whole, old) & ~F.exists(short, short_old) & ~stale


#: Social networks (fixed values): a name before a dot, or a whole host.
NETWORKS = ("facebook.", "instagram.", "twitter.", "x.com", "youtube.", "youtu.be", "tiktok.", "linkedin.", "pinterest.", "vimeo.", "spotify.", "whatsapp.")


def classify_links(links: Column, page: Column, most_same: int = 300, most_other: int = 80) -> Column:
    """Links of a page by site: ``struct<same array<string>, other array<string>>``; other sites without sellers and networks."""
    home = site_family(page)
    same = F.slice(F.array_distinct(F.filter(links, lambda u: site_family(u) == home)), 1, most_same)
    social = lambda u: host(u).rlike("|".join(rf"(^|\.){n.strip('.')}\." if n.endswith(".") else rf"(^|\.){n}$" for n in NETWORKS))
    other = F.slice(F.array_distinct(F.filter(links, lambda u: (site_family(u) != home) & (host(u) != "") & ~is_ticket_seller(u) & ~social(u))), 1, most_other)
    return F.struct(same.alias("same"), other.alias("other"))
