"""Text functions as column builders; every argument and result is a Column unless it says otherwise."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F



def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, as a lambda's variable, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Accented letters (fixed values); each becomes its base letter.
ACCENTED = "àáâãäåāăąçćčďđèéêëēėęěğìíîïīįıłļľñńňņòóôõöøōőŕřśšşșťţțùúûüūůűýÿźžżÀÁÂÃÄÅĀĂĄÇĆČĎĐÈÉÊËĒĖĘĚĞÌÍÎÏĪĮİŁĻĽÑŃŇŅÒÓÔÕÖØŌŐŔŘŚŠŞȘŤŢȚÙÚÛÜŪŮŰÝŸŹŽŻ"
_BARE = {"đ": "d", "ł": "l", "ø": "o", "ı": "i", "Đ": "D", "Ł": "L", "Ø": "O"}
PLAIN = "".join(_BARE.get(c) or unicodedata.normalize("NFD", c)[0] for c in ACCENTED)

#: Words that change from day to day on an unchanged page (fixed values).
VOLATILE = (
    "sold ?out|few (?:tickets|seats|places) left|last (?:tickets|seats|places)|low availability|limited availability|"
    "book now|buy tickets|tickets available|waiting ?list|udsolgt|få billetter|ausverkauft|restkarten|wenige karten|"
    r"\bcomplet\b|dernières places|uitverkocht|laatste kaarten|esaurito|ultimi posti|agotado|últimas entradas|slutsålt|"
    "få biljetter|utsolgt|loppuunmyyty|wyprzedane|vyprodáno|elfogyott|esgotado|"
    r"\d+\s+(?:seats|tickets|places|plätze|pladser|posti|plazas|platser|plaatsen)"
)
#: Whole lines that only name a day (fixed values).
DAY_LABELS = (
    "today", "tomorrow", "tonight", "heute", "morgen", "aujourd'hui", "demain", "ce soir", "vandaag", "vanavond", "oggi", "domani",
    "stasera", "hoy", "mañana", "esta noche", "i dag", "i morgen", "idag", "imorgon", "tänään", "huomenna", "dziś", "jutro", "dnes", "zítra",
)


def unaccent(c: Column) -> Column:
    """Letters without accents; ß, æ and œ become two letters."""
    for mark, plain in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("Æ", "AE"), ("Œ", "OE")):
        c = F.replace(c, F.lit(mark), F.lit(plain))
    return F.translate(c, ACCENTED, PLAIN)


def slugify(c: Column) -> Column:
    """Title and name key: no accents, lower case, runs of other characters as one hyphen, none at the ends. Null: empty."""
    return F.regexp_replace(F.regexp_replace(F.lower(unaccent(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def filled(c: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def trigrams(slug: Column) -> Column:
    """Distinct trigrams of a slug's words, each word padded with two spaces before and one after."""
    words = F.filter(F.split(slug, "-"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - both
    return F.when(total > 0, both / total).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two slugs, 0 to 1."""
    return overlap(trigrams(a), trigrams(b))


def holds(outer: Column, inner: Column, least: int = 5) -> Column:
    """Whether a slug contains another of at least ``least`` characters."""
    return (F.length(inner) >= least) & F.contains(outer, inner)


def title_close(a: Column, b: Column) -> Column:
    """Two titles name one show: similar by 0.3 or one holds the other."""
    a, b = slugify(a), slugify(b)
    return (similarity(a, b) >= 0.3) | holds(a, b) | holds(b, a)


def without_bracket(c: Column) -> Column:
    """Text without a bracket at its end."""
    return F.regexp_replace(c, r"\s*\(.*\)\s*$", "")


def piece_title(title: Column, program: Column) -> Column:
    """Title without the programme's name in a bracket at its end."""
    suffix = F.concat(F.lit(" ("), program, F.lit(")"))
    return F.when(F.coalesce(F.endswith(title, suffix), F.lit(False)), F.substr(title, F.lit(1), F.length(title) - F.length(suffix))).otherwise(title)


def is_generic_title(title: Column, company: Column) -> Column:
    """A title that names nothing: null, a tour label, or the company's own name."""
    tour = F.coalesce(title.rlike(r"(?iu)^\s*(on tour|tour|tournee|tournée|gastspiel|guest performance|en tournée|in tour)\b"), F.lit(False))
    return title.isNull() | tour | F.coalesce(slugify(title) == slugify(company), F.lit(False))


def cut_at_word(c: Column, most: int) -> Column:
    """Text of at most ``most`` characters, cut at a word and marked with three points."""
    head = F.substring(c, 1, most - 3)
    return F.when(F.length(c) > most, F.concat(F.regexp_replace(head, r" [^ ]*$", ""), F.lit("..."))).otherwise(c)


def key_of(*columns: Column) -> Column:
    """md5 over the columns with ``|`` between, nulls as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def fold_digits(md5: Column, n: int) -> Column:
    """A 128-bit md5 (hex) as a whole number modulo ``n``, digit by digit."""
    digits = F.filter(F.split(md5, ""), lambda d: d != "")
    return F.aggregate(digits, F.lit(0).cast("long"), lambda acc, d: (acc * 16 + F.instr(F.lit("0123456789abcdef"), d) - 1) % n).cast("int")


def fingerprint_lines(text: Column) -> Column:
    """The lines of a page that carry its programme, in order of text: without ticket noise, short lines and day labels."""

    def clean(line: Column) -> Column:
        calm = F.regexp_replace(F.lower(line), f"(?iu){VOLATILE}", " ")
        return F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(calm, r"(?U)\s+", " ")), r"^[ \-|·•,:]+", ""), r"[ \-|·•,:]+$", "")

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), clean)
    return F.array_sort(F.array_distinct(F.filter(lines, lambda s: (F.length(s) >= 3) & ~s.isin(*DAY_LABELS))))


def page_fingerprint(text: Column, events: Column | None = None, feed_dates: Column | None = None, sitemap: Column | None = None) -> Column:
    """sha256 of what matters on a page: its lines in any order, then event data, feed dates and sitemap if given."""
    body = F.array_join(fingerprint_lines(text), "\n")
    for label, part in ((None, events), ("\nFEEDS:", feed_dates), ("\nSITEMAP:", sitemap)):
        if part is not None:
            joined = F.array_join(F.array_sort(F.array_distinct(part)), " ")
            body = F.concat(body, F.when(F.size(part) > 0, F.concat(F.lit(label or ""), joined)).otherwise(F.lit("")))
    return F.sha2(body, 256)


#: A character reference: its number, in tens or hexadecimal, or its name.
_REFERENCE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def decode_references(c: Column) -> Column:
    """Character references of HTML as characters: all names of the standard's table, and numbers; others stay.

    Linear in the text: it is split at the references once, and these are looked up by first letter, then by name.
    """
    by_letter: dict[str, dict[str, str]] = {}
    for name, char in html5.items():
        if name.endswith(";"):
            by_letter.setdefault(name[0], {})[name[:-1]] = char
    # one literal: a map that is written out pair by pair takes the planner seconds
    table = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")
    number = lambda n: F.when(n.rlike("^#[0-9]"), F.substring(n, 2, 7).try_cast("int")).when(n.rlike("^#[xX]"), F.conv(F.substring(n, 3, 6), 16, 10).try_cast("int"))
    good = lambda k: (k > 0) & (k <= 0x10FFFF) & ~k.between(0xD800, 0xDFFF)
    told = lambda k: F.when(good(k), F.decode(F.unhex(F.lpad(F.hex(k), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
    named = lambda n: F.coalesce(F.try_element_at(F.try_element_at(table, F.substring(n, 1, 1)), n), F.concat(F.lit("&"), n, F.lit(";")))
    one = lambda n: F.when(n.startswith("#"), once(number(n), told)).otherwise(named(n))

    def joined(p: Column) -> Column:
        gaps = F.transform(p["gaps"], lambda g, k: F.concat(g, F.when(k < F.size(p["names"]), one(F.get(p["names"], k))).otherwise("")))
        return F.array_join(gaps, "")

    parts = lambda t: F.struct(F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(1)).alias("names"), F.split(t, _REFERENCE, -1).alias("gaps"))
    return once(c, lambda t: F.when(F.contains(t, F.lit("&")), once(parts(t), joined)).otherwise(t))


def html_text(html: Column) -> Column:
    """Readable text of a page: no scripts, styles and drawings, tags as spaces, references decoded."""
    c = F.coalesce(html, F.lit(""))
    for tag in ("script", "style", "noscript", "svg"):
        c = F.regexp_replace(c, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_references(c), r"(?U)\s+", " "))


def estimate_tokens(text: Column) -> Column:
    """Generous token estimate: 3 characters a token up to U+024F, 1.6 beyond; empty or null: 0."""
    n = once(F.length(F.regexp_replace(text, "[\\x{0000}-\\x{024F}]+", "")), lambda other: F.floor((F.length(text) - other) / F.lit(3.0) + other / F.lit(1.6)) + 1)
    return F.when(F.length(F.coalesce(text, F.lit(""))) == 0, F.lit(0)).otherwise(n).cast("long")


def clean_text(raw: Column) -> Column:
    """Text from bytes that may hold broken characters: what is no UTF-8 becomes the replacement character."""
    return F.make_valid_utf8(raw.cast("string"))


def time_seen(time: Column, text: Column) -> Column:
    """Whether a time HH:MM is written in a text in one of the usual forms (19:30, 19.30, 19h30, 20h, 7:30 pm)."""
    h, m = F.split_part(time, F.lit(":"), F.lit(1)).cast("int"), F.split_part(time, F.lit(":"), F.lit(2))
    whole, hour = m == "00", h.cast("string")
    two = F.lpad(hour, 2, "0")
    late = (h - 12).cast("string")
    none = F.lit(None).cast("string")
    forms = F.array(
        F.concat(hour, F.lit(":"), m), F.concat(two, F.lit(":"), m), F.concat(hour, F.lit(r"\."), m), F.concat(two, F.lit(r"\."), m),
        F.concat(hour, F.lit("h"), m), F.when(whole, F.concat(hour, F.lit("h"))).otherwise(none),
        F.when(h > 12, F.concat(late, F.lit(":"), m, F.lit(" ?pm"))), F.when(h > 12, F.concat(late, F.lit(r"\."), m, F.lit(" pm"))),
        F.when(h > 12, F.concat(late, F.lit(" ?pm"))),
    )
    pattern = F.concat(F.lit(r"(?i)(?<![\d:.])(?:"), F.array_join(F.array_compact(forms), "|"), F.lit(r")(?![\d])"))
    return F.coalesce(F.regexp_count(text, pattern) > 0, F.lit(False))


def case_words(titles: Column) -> Column:
    """The words of an array of titles, in order, as they are written."""
    return F.flatten(F.transform(F.array_compact(titles), lambda t: F.regexp_extract_all(t, F.lit(r"(?U)\w+"), F.lit(0))))


def excerpt(text: Column, words: Column, before: int = 600, after: int = 900, limit: int = 5000) -> Column:
    """Parts of a text around given words of 4 letters or more: windows are merged, joined by an ellipsis and cut.

    A window is from ``before`` a word's beginning to ``after`` its end. Without a hit, or with a text that fits, the
    beginning of the text is returned.
    """
    low = F.lower(text)
    long = F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= 4), F.lower))
    spots = F.array_sort(F.flatten(F.transform(long, lambda w: F.transform(_places(low, w), lambda p: F.struct(F.greatest(F.lit(0), p - before).alias("a"), F.least(F.length(text), p + F.length(w) + after).alias("b"))))))
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate(
        spots,
        F.slice(F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))), 1, 0),
        lambda acc, p: F.when(
            (F.size(acc) > 0) & (p["a"] <= last(acc)["b"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["a"].alias("a"), F.greatest(last(acc)["b"], p["b"]).alias("b"))))
        ).otherwise(F.concat(acc, F.array(p))),
    )
    parts = F.transform(merged, lambda w: F.substr(text, w["a"] + 1, w["b"] - w["a"]))
    out = F.when((F.length(text) <= limit) | (F.size(spots) == 0), text).otherwise(F.array_join(parts, " … "))
    return F.substring(out, 1, limit)


def _places(text: Column, word: Column) -> Column:
    """All places (from 0) of a word in a text: lengths of the split parts, summed up."""
    parts = F.split(text, F.concat(F.lit(r"\Q"), word, F.lit(r"\E")), -1)
    return F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, p: F.struct((acc["at"] + F.length(p) + F.length(word)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(p))).alias("out")),
        lambda acc: acc["out"],
    )


# ---- credit lines -------------------------------------------------------------------------------------------------

#: Patterns of credit lines (fixed values).
CREDIT_NOTES = (
    r"\s*\((after|nach|d.apr[eè]s|based on|frei nach|from|inspired by|(new\s+)?version|revised|revival|revived|restaged|staged|staging|"
    r"re-?adapted|recreated|reconstructed|supervised|arranged|production|produced|act\s|acts\s|scene\s|part\s)[^)]*\)"
)
CREDIT_AFTER = r"\s*,?\s+(after|nach|d.apr[eè]s|based on|frei nach)\s+.*$"
CREDIT_SPLIT = (
    r"\s*(/|,|&|;|\+|\||—|–|\s-\s|\s(and|und|et|y|e|en|og|och|with|mit|avec|con|feat\.?|featuring|in collaboration with|"
    r"in collaboration|in samenwerking met|en collaboration avec|in zusammenarbeit mit)\s)\s*"
)
CREDIT_LEAD = (
    r"^\s*(?:(?:and|und|et|y)\s+)?(?:choreograph(?:y|ie|ed)(?: by|:)?|chor[ée]graphie(?: de|:)?|coreograf[ií]a(?: di| de|:)?|"
    r"choreografie(?: von|:)?)?\s*"
)
CREDIT_VERBS = (
    r"^(after|nach|d.apr[eè]s|based on|frei nach|inspired by|from|by|with|revised|revival|revived|restaged|staged|staging|re-?adapted|"
    r"recreated|reconstructed|supervised|arranged|version|new version|production|produced|act|acts|scene|part)(\s|$)"
)
CREDIT_NOBODY = (
    r"^(gäste|gaeste|guests?|others?|andere|anderen|autres|altri|otros|weitere|friends|company|ensemble|dancers|cast|et al\.?|collective|"
    r"kollektiv|u\.a\.|etc\.?|various|diverse|verschiedene|tba|tbc|tbd|unknown|mixed|several|multiple|divers|various artists|"
    r"choreograph(y|ie|ers?)|chorégraphie|coreografia|line-up tba|others|version|original|restaging|staging|revival|reconstruction|"
    r"adaptation|inspiration|collaboration|col\.|coll\.|n\.n\.|concept|direction|regie|music|musik|libretto|text)$"
)
CREDIT_GROUP = r"(^|\s)(the\s+)?(dancers|members|ensemble|cast|company|collective|kollektiv|compagnie|compañía|companhia|compagnia|troupe|students|pupils)(\s|$)"
CREDIT_CODE = r"^[A-Z]{2,3}$"


def split_credit_line(line: Column) -> Column:
    """The names in a credit line, in order: without notes, lead-ins, group words and codes."""
    c = F.regexp_replace(F.coalesce(line, F.lit("")), f"(?iu){CREDIT_NOTES}", "")
    c = F.regexp_replace(F.regexp_replace(c, f"(?iu){CREDIT_AFTER}", ""), r"\s+\(([^)]*)\)\s*$", ", $1")
    parts = F.transform(F.split(c, f"(?iu){CREDIT_SPLIT}"), lambda p: F.regexp_replace(F.regexp_replace(p, f"(?iu){CREDIT_LEAD}", ""), r"^[ ,;:]+|[ ,;:]+$", ""))
    unwanted = lambda p: p.rlike(f"(?iu){CREDIT_VERBS}") | p.rlike(f"(?iu){CREDIT_NOBODY}") | p.rlike(CREDIT_CODE) | p.rlike(f"(?iu){CREDIT_GROUP}")
    return F.filter(parts, lambda p: (F.length(p) >= 2) & ~unwanted(p))
