"""Dates, times of day and time zones as column builders. The session time zone must be UTC."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Europe/Paris"

#: The zone of single-zone countries and the usual one of others (fixed values).
ZONE_BY_COUNTRY = {
    "Albania": "Europe/Tirane", "Armenia": "Asia/Yerevan", "Austria": "Europe/Vienna", "Belgium": "Europe/Brussels",
    "Bosnia and Herzegovina": "Europe/Sarajevo", "Bulgaria": "Europe/Sofia", "Croatia": "Europe/Zagreb", "Cyprus": "Asia/Nicosia",
    "Czech Republic": "Europe/Prague", "Czechia": "Europe/Prague", "Denmark": "Europe/Copenhagen", "Estonia": "Europe/Tallinn",
    "Finland": "Europe/Helsinki", "France": "Europe/Paris", "Georgia": "Asia/Tbilisi", "Germany": "Europe/Berlin",
    "Greece": "Europe/Athens", "Hungary": "Europe/Budapest", "Iceland": "Atlantic/Reykjavik", "Ireland": "Europe/Dublin",
    "Italy": "Europe/Rome", "Latvia": "Europe/Riga", "Liechtenstein": "Europe/Vaduz", "Lithuania": "Europe/Vilnius",
    "Luxembourg": "Europe/Luxembourg", "Malta": "Europe/Malta", "Moldova": "Europe/Chisinau", "Monaco": "Europe/Monaco",
    "Montenegro": "Europe/Podgorica", "Netherlands": "Europe/Amsterdam", "North Macedonia": "Europe/Skopje", "Norway": "Europe/Oslo",
    "Poland": "Europe/Warsaw", "Portugal": "Europe/Lisbon", "Romania": "Europe/Bucharest", "Russia": "Europe/Moscow",
    "Serbia": "Europe/Belgrade", "Slovakia": "Europe/Bratislava", "Slovenia": "Europe/Ljubljana", "Spain": "Europe/Madrid",
    "Sweden": "Europe/Stockholm", "Switzerland": "Europe/Zurich", "Turkey": "Europe/Istanbul", "Ukraine": "Europe/Kyiv",
    "United Kingdom": "Europe/London", "UK": "Europe/London", "Israel": "Asia/Jerusalem", "United States": "America/New_York",
    "USA": "America/New_York", "Canada": "America/Toronto", "Australia": "Australia/Sydney", "Japan": "Asia/Tokyo",
}
#: Countries with several zones, and the two neighbours whose islands keep their own (fixed values).
MULTI_ZONE = ("United States", "USA", "Canada", "Australia", "Russia", "Brazil", "Mexico")
IBERIA = {"Spain": "Europe/Madrid", "Portugal": "Europe/Lisbon"}

#: Days until a source is due again by tier, and the waits around announcements (fixed values).
RECHECK_DAYS = {0: 7, 1: 14, 2: 30, 3: 30}
FESTIVAL_WAIT_DAYS, ANNOUNCE_MAX_WAIT_DAYS = 30, 60
CORE_TIERS, CORE_WAIT_DAYS = (0, 1), 30


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table; null for unknown keys."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def local(ts: Column, *zones: Column) -> Column:
    """Wall-clock time of an instant in the first known zone."""
    return F.from_utc_timestamp(ts, F.coalesce(*zones, F.lit(DEFAULT_ZONE)))


def local_date(ts: Column, *zones: Column) -> Column:
    return F.to_date(local(ts, *zones))


def local_time(ts: Column, *zones: Column) -> Column:
    return F.date_format(local(ts, *zones), "HH:mm")


def minutes(time: Column) -> Column:
    """Minutes of the day of HH:MM; null if it is no time."""
    part = lambda k: F.regexp_extract(time, r"^\s*(\d{1,2}):(\d{2})\s*$", k).try_cast("int")
    return part(1) * 60 + part(2)


def time_known(time: Column) -> Column:
    return F.coalesce(time.rlike(r"^\s*\d{1,2}:\d{2}\s*$"), F.lit(False))


def start_instant(date: Column, time: Column, zone: Column, position: Column, in_program: Column) -> Column:
    """Instant of a local date and time (midnight if unknown); pieces of a programme follow each other by a second."""
    wall = F.make_timestamp_ltz(F.year(date), F.month(date), F.day(date), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    wall = wall + F.make_dt_interval(mins=F.coalesce(minutes(time), F.lit(0)))
    shift = F.when(in_program, F.coalesce(position, F.lit(1)) - 1).otherwise(0)
    return F.to_utc_timestamp(wall, F.coalesce(zone, F.lit(DEFAULT_ZONE))) + F.make_dt_interval(secs=shift.cast("decimal(18,6)"))


def minute_of(ts: Column) -> Column:
    """The evening's minute: starts are matched and grouped by it."""
    return F.date_trunc("minute", ts)


def known_zone(zone: Column) -> Column:
    """The zone if it is one that is known, else null."""
    return F.when(zone.isin(*sorted(available_timezones())), zone)


def zone_offset(zone: Column, date: Column) -> Column:
    """Seconds between local and universal time at 20:00 of a date; null for an unknown zone."""
    evening = F.make_timestamp_ltz(F.year(date), F.month(date), F.day(date), F.lit(20), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    known = known_zone(zone)
    return F.when(known.isNotNull(), F.unix_seconds(evening) - F.unix_seconds(F.to_utc_timestamp(evening, F.coalesce(known, F.lit("UTC")))))


def choose_timezone(own: Column, country: Column, date: Column, source_zone: Column, source_country: Column, today: dt.date | None = None) -> Column:
    """A show's zone: as read, unless it is unknown or does not fit the country; abroad the country's; else the source's.

    Zones are compared on the show's date, without one on ``today``.
    """
    own, date = F.nullif(own, F.lit("")), F.coalesce(date, F.lit(today).cast("date"))
    country = F.trim(F.coalesce(country, F.lit("")))
    by_country = lookup(country, ZONE_BY_COUNTRY)
    iberian = F.when(own.isin(*IBERIA.values()), lookup(country, IBERIA)).otherwise(own)
    misfit = by_country.isNotNull() & ~country.isin(*MULTI_ZONE) & ~zone_offset(own, date).eqNullSafe(zone_offset(by_country, date))
    read = F.when(country.isin(*IBERIA), iberian).when(misfit, by_country).otherwise(own)
    abroad = (country != "") & ~country.eqNullSafe(source_country) & by_country.isNotNull()
    return F.when(own.isNotNull(), read).when(abroad, by_country).otherwise(source_zone)


def recheck_days(tier: Column, kind: Column, found: Column, opens_soon: Column) -> Column:
    """Days until a source is looked at again. ``opens_soon``: a run with missing dates opens within 60 days."""
    days = reduce(lambda c, t: c.when(F.coalesce(tier, F.lit(2)) == t[0], t[1]), list(RECHECK_DAYS.items())[1:], F.when(F.coalesce(tier, F.lit(2)) == 0, RECHECK_DAYS[0])).otherwise(14)
    days = F.when((kind == "Festival") & (found == 0), F.greatest(days, F.lit(FESTIVAL_WAIT_DAYS))).otherwise(days)
    return F.when(opens_soon & tier.isin(0, 1), F.least(days, F.lit(7))).otherwise(days)


def announcement_date(date: Column, month: Column, today: dt.date, most: int = 400) -> Column:
    """The announced date (or the first of the announced month) if it lies after today and within ``most`` days."""
    day = F.coalesce(F.try_to_date(F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), date)), F.try_to_date(F.when(month.rlike(r"^\d{4}-\d{2}$"), F.concat(month, F.lit("-01")))))
    return F.when((day > F.lit(today)) & (day <= F.lit(today + dt.timedelta(days=most))), day)


def announcement_days(days: Column, found: Column, when: Column, today: dt.date, tier: Column) -> Column:
    """Days until the next check when an announcement is expected: the day after it, at least 1; 0 stays 0.

    With shows found the usual rhythm stays if it is shorter; with none the wait is limited, more so in the core tiers.
    """
    until = F.greatest(F.lit(1), F.date_diff(when, F.lit(today)) + 1)
    longest = F.when(F.coalesce(tier.isin(*CORE_TIERS), F.lit(False)), F.lit(CORE_WAIT_DAYS)).otherwise(F.lit(ANNOUNCE_MAX_WAIT_DAYS))
    return F.when((days == 0) | when.isNull(), days).when(found > 0, F.least(days, until)).otherwise(F.least(until, longest))
