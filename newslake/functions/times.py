"""Time expressions. "Now" is always an argument, so results can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.schemas import PARTITIONS


# Feed dates (RFC 822): an optional day name, day, month, year, time, and a numeric zone or a name of UTC.
_FEED_DATE = r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2})(:\d{2})? ([+-]\d{4}|GMT|UTC|UT|Z)\s*$"


def _feed_time(text: Column) -> Column:
    part = lambda n: F.regexp_extract(text, _FEED_DATE, n)
    second = F.when(part(5) == "", ":00").otherwise(part(5))
    zone = F.when(part(6).rlike(r"^[+-]"), part(6)).otherwise("+0000")
    plain = F.concat(part(1), F.lit(" "), F.initcap(part(2)), F.lit(" "), part(3), F.lit(" "), part(4), second, F.lit(" "), zone)
    return F.when(text.rlike(_FEED_DATE), F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss xx")))


def parse_time(text: Column) -> Column:
    """ISO text or a feed date to timestamp; null when it cannot be read."""
    return F.coalesce(F.try_to_timestamp(text), _feed_time(text))


def now_or(anchor: Column | None) -> Column:
    return F.current_timestamp() if anchor is None else anchor


def partition_parts(ts: Column, anchor: Column | None = None) -> dict[str, Column]:
    """Hour partition of an event; an unknown time falls into the anchor's hour."""
    at = F.coalesce(ts, now_or(anchor))
    parts = [F.year(at), F.month(at), F.dayofmonth(at), F.hour(at)]
    return dict(zip(PARTITIONS, parts))


def iso(ts: Column) -> Column:
    """ISO text with microseconds and offset, as other services expect it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def display(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'")


def iso_or_raw(text: Column) -> Column:
    """ISO form of a time text, or the text itself when it cannot be read."""
    return F.coalesce(iso(parse_time(text)), text)


def display_or_raw(text: Column) -> Column:
    return F.coalesce(display(parse_time(text)), text)


_CLOCK = r"^\s*(\d{1,2})\s*:\s*(\d{1,2})\s*$"


def clock_hour_minute(clock: Column) -> tuple[Column, Column]:
    """Hour and minute of an ``HH:MM`` text, both null when out of range."""
    hour = F.regexp_extract(clock, _CLOCK, 1).try_cast("int")
    minute = F.regexp_extract(clock, _CLOCK, 2).try_cast("int")
    valid = hour.between(0, 23) & minute.between(0, 59)
    return F.when(valid, hour), F.when(valid, minute)


def at_clock(day: Column, clock: Column) -> Column:
    """The given day at ``HH:MM``; null when the clock text is bad."""
    hour, minute = clock_hour_minute(clock)
    return F.try_make_timestamp(
        years=F.year(day), months=F.month(day), days=F.dayofmonth(day),
        hours=hour, mins=minute, secs=F.lit(0),
    )


def clock_to_time(clock: Column, anchor: Column) -> Column:
    """``HH:MM`` on the anchor's day, one day back if that lies in the future."""
    today = at_clock(anchor, clock)
    return F.when(today > anchor, today - F.expr("INTERVAL 1 DAY")).otherwise(today)


def dated_clock_to_time(date_text: Column, clock: Column, anchor: Column) -> Column:
    """Date text such as ``2026년 1월 23일 금요일`` plus ``HH:MM`` to a timestamp.

    The first three numbers are year, month and day. Without three numbers, or if
    they are no date, the anchor's day is used; a bad clock gives the anchor.
    """
    numbers = F.regexp_extract_all(date_text, F.lit(r"(\d+)"), F.lit(1))
    part = [F.get(numbers, F.lit(i)).try_cast("int") for i in range(3)]
    hour, minute = clock_hour_minute(clock)
    written = F.try_make_timestamp(
        years=part[0], months=part[1], days=part[2], hours=hour, mins=minute, secs=F.lit(0)
    )
    return F.coalesce(written, at_clock(anchor, clock), anchor)
