"""Date expressions: ISO parsing and feed dates."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ISO 8601 date with optional time and offset; any one character may separate date and time.
# Spark's own cast accepts some strings this rejects ("2026", " 2026-01-01") and rejects some
# it accepts ("20260101"), so the grammar is checked first and a canonical form is cast.
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}"
# a fraction counts as a fraction of a second, whatever it follows
ISO_TIME = r"(?:[0-9]{2}(?::[0-9]{2}(?::[0-9]{2})?)?|[0-9]{4}(?:[0-9]{2})?)(?:[.,][0-9]+)?"
ISO_OFFSET = r"[+-][0-9]{2}(?::?[0-9]{2})?"
ISO = rf"(?s)^({ISO_DATE})(?:.({ISO_TIME})({ISO_OFFSET})?)?\z"
# The usual full form, which Spark's cast reads as it stands.
FULL_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?"
    r"(?:Z|[+-][0-9]{2}:[0-9]{2})?\z"
)


def _pieces(c: Column) -> tuple[Column, Column, Column]:
    zoned = F.replace(c, F.lit("Z"), F.lit("+00:00"))
    return tuple(F.regexp_extract(zoned, ISO, group) for group in (1, 2, 3))


def _written_date(date: Column) -> Column:
    digits = F.replace(date, F.lit("-"), F.lit(""))
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2),
                       F.substring(digits, 7, 2))


def iso_timestamp(c: Column) -> Column:
    """The UTC instant of an ISO string, null when it is not one."""
    date, time, offset = _pieces(c)
    clock = F.rpad(F.regexp_replace(time, "[.,].*|:", ""), 6, "0")
    fraction = F.rpad(F.regexp_extract(time, "[.,]([0-9]+)", 1), 6, "0")
    zone = F.rpad(F.replace(offset, F.lit(":"), F.lit("")), 5, "0")
    canonical = F.concat(
        _written_date(date), F.lit(" "),
        F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":"),
        F.substring(clock, 5, 2), F.lit("."), fraction,
        F.when(offset == "", "+00:00").otherwise(
            F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2))),
    )
    return (
        F.when(F.startswith(c, F.lit("0000")), None)
        .when(c.rlike(FULL_ISO), F.try_to_timestamp(c))
        .when(date != "", F.try_to_timestamp(canonical))
    )


def iso_date_as_written(c: Column) -> Column:
    """The calendar date in the string, its offset not applied (O19); null when invalid."""
    date, _, _ = _pieces(c)
    return F.when(iso_timestamp(c).isNotNull(), _written_date(date).try_cast("date"))


def partition_date(published: Column, scraped: Column, today: Column | None = None) -> Column:
    """Partition date of an event.

    The scrape time stands in only for a missing publication date; a date that does not
    parse files the event under today.
    """
    raw = F.when(published != "", published).otherwise(scraped)
    return F.coalesce(iso_date_as_written(raw), today if today is not None else F.current_date())


def utc_day(instant: Column) -> Column:
    """UTC calendar day of an instant (O45); the session time zone is UTC."""
    return F.to_date(instant)


def utc_literal(ts: datetime) -> Column:
    """A Python datetime as an instant; one without a zone is UTC, whatever the machine's zone."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")


# The forms of nearly all feeds, which Spark reads itself.
FEED_DATE_FORMATS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z"]

_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
           "november", "december"]
_WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_CLOCK = re.compile(
    r"(?<![0-9:])([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?\s*(?:([ap])\.?m\b\.?)?(?![0-9:])"
    r"|(?<![0-9:])([0-9]{1,2})\s*([ap])\.?m\b\.?")
_OFFSET = re.compile(r"(?:(?:utc|gmt)\s*)?([+-])([0-9]{2}):?([0-9]{2})?$|(?:(?:utc|gmt)\s*)([+-])([0-9])$")
_WORD = re.compile(r"([0-9]+)(?:st|nd|rd|th)\b|([0-9]+)|([^\W\d_]+)\.?|([-/.,\s]+|[()])")
# Words that say nothing about the date.
_IDLE = frozenset(["at", "on", "of", "the", "t", "and"])


def _named(word: str, names: list[str]) -> int | None:
    """Number of a name that is written in full or with three or more of its letters."""
    return next((k for k, name in enumerate(names, 1) if len(word) >= 3 and name.startswith(word)), None)


def _year(digits: str) -> int:
    number = int(digits)
    return number if len(digits) > 2 else number + (2000 if number < 50 else 1900)


def _calendar(words: list[tuple[str, str]]) -> tuple[int, int, int] | None:
    """Year, month and day of a date's words; null where they leave one of them open.

    Words are (class, text): ``number``, ``month``. Rules, in order: eight digits are year, month
    and day; with a month's name the other numbers are day and year, the year being the one with
    more than two digits or above 31, else the second; of three numbers a first of four digits is
    the year before month and day; else the month comes first, unless it is above 12.
    """
    numbers = [text for kind, text in words if kind == "number"]
    months = [int(text) for kind, text in words if kind == "month"]
    if len(months) > 1:
        return None
    if months:
        if len(numbers) != 2:
            return None
        first, second = numbers
        year_first = len(first) > 2 or int(first) > 31
        year, day = (first, second) if year_first else (second, first)
        return (_year(year), months[0], int(day)) if len(day) <= 2 else None
    if len(numbers) == 1 and len(numbers[0]) == 8:
        return int(numbers[0][:4]), int(numbers[0][4:6]), int(numbers[0][6:])
    if len(numbers) != 3 or any(len(n) > 2 for n in numbers[1:2]):
        return None
    if len(numbers[0]) == 4:
        return (int(numbers[0]), int(numbers[1]), int(numbers[2])) if len(numbers[2]) <= 2 else None
    month, day = int(numbers[0]), int(numbers[1])
    if month > 12:
        month, day = day, month
    return _year(numbers[2]), month, day


def read_date(text: str) -> datetime | None:
    """The UTC instant of a date as feeds and people write it; null where it fits no rule.

    The clock and the zone are taken out first. Zone names other than UTC's read as UTC, as do
    dates without a zone; an offset after UTC or GMT counts as written. A clock alone is no date.
    """
    text = " ".join(text.lower().split())
    clock = _CLOCK.search(text)
    hour = minute = second = micro = offset = 0
    if clock:
        hour, minute, second = (int(clock[k] or 0) for k in (1, 2, 3)) if clock[1] else (int(clock[6]), 0, 0)
        micro = int((clock[4] or "0").ljust(6, "0")[:6])
        half = clock[5] or clock[7]
        if half:
            if not 1 <= hour <= 12:
                return None
            hour = hour % 12 + (12 if half == "p" else 0)
        before, after = text[:clock.start()].strip(), text[clock.end():].strip()
        zone = _OFFSET.search(after)
        if zone:
            sign, hours, minutes = (zone[1], zone[2], zone[3] or 0) if zone[1] else (zone[4], zone[5], 0)
            offset = (60 * int(hours) + int(minutes)) * (-1 if sign == "-" else 1)
            after = after[:zone.start()].strip()
        text = f"{before} {after}"
    words, at, zones = [], 0, 0
    while at < len(text):
        found = _WORD.match(text, at)
        if not found:
            return None
        at = found.end()
        number, word = found[1] or found[2], found[3]
        if number:
            words.append(("number", number))
        elif word:
            month = _named(word, _MONTHS) if word != "sept" else 9
            if month:
                words.append(("month", str(month)))
            elif not (_named(word, _WEEKDAYS) or word in _IDLE):
                # one zone name may follow a clock
                zones += 1
                if not clock or zones > 1 or not (1 <= len(word) <= 5 and word.isascii()):
                    return None
    found_date = _calendar(words)
    try:
        written = datetime(*found_date, hour, minute, second, micro) if found_date else None
        return None if written is None else written - timedelta(minutes=offset)
    except (ValueError, OverflowError):
        return None


@F.pandas_udf(StringType())
def _read_dates(texts: pd.Series) -> pd.Series:
    def read(text: str) -> str | None:
        found = read_date(text)
        return None if found is None else found.isoformat() + "+00:00"

    return texts.map(read, na_action="ignore")


def feed_date_iso(c: Column) -> Column:
    """A feed's date as a UTC ISO string (O15), null when no rule fits, see ``read_date``.

    The usual forms are read by Spark; only other ones go to Python.
    """
    text = F.trim(F.regexp_replace(c, r"^\s*[A-Za-z]+\.?,\s*", ""))
    text = F.regexp_replace(text, r"([0-9])\s*(?:Z|UT|[A-Z]{3,5})$", "$1 +0000")
    text = F.regexp_replace(text, r"([+-][0-9]{2}):([0-9]{2})$", "$1$2")
    instant = F.coalesce(
        *[F.try_to_timestamp(text, F.lit(form)) for form in FEED_DATE_FORMATS], iso_timestamp(F.trim(c)))
    with_fraction = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    usual = F.concat(F.regexp_replace(with_fraction, r"\.000000$", ""), F.lit("+00:00"))
    return F.coalesce(usual, _read_dates(F.when(usual.isNull(), c)))
