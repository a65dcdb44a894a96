"""Event-time parsing, ISO text and business hours (all UTC)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashtide.schemas import BUSINESS_HOURS

# ISO 8601: calendar or week dates, each part extended or basic.
_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?"
_TIME = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_ZONE = r"Z|[+-]\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?"
ISO_PATTERN = rf"^({_DATE})(?:Z|\D({_TIME})({_ZONE})?)?$"


def _iso_date(text: Column) -> Column:
    """A date of any form; NULL if there is no such day."""
    digits = F.replace(text, F.lit("-"), F.lit(""))
    calendar = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)).try_cast("date")
    year, week = (F.substring(digits, at, size).try_cast("int") for at, size in ((1, 4), (6, 2)))
    day = F.coalesce(F.substring(digits, 8, 1).try_cast("int"), F.lit(1))
    # The fourth of January is in the first week; a week belongs to the year of its Thursday.
    fourth = F.concat(F.substring(digits, 1, 4), F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.trunc(fourth, "week"), (week - 1) * 7)
    exists = day.between(1, 7) & (week >= 1) & (F.year(F.date_add(monday, 3)) == year)
    return F.when(F.substring(digits, 5, 1) == "W", F.when(exists, F.date_add(monday, day - 1))).otherwise(calendar)


def _part(digits: Column, at: int) -> Column:
    """Two digits, 0 where there are none."""
    return F.coalesce(F.substring(digits, at, 2).try_cast("int"), F.lit(0))


def _iso_micros(text: Column) -> Column:
    date, time, zone = (F.regexp_extract(text, ISO_PATTERN, group) for group in (1, 2, 3))
    clock = F.replace(F.replace(time, F.lit(":"), F.lit("")), F.lit(","), F.lit("."))
    hour, minute, second = (_part(clock, at) for at in (1, 3, 5))
    fraction = F.rpad(F.substring(F.substring_index(clock, ".", -1), 1, 6), 6, "0").try_cast("long")
    micros = F.when(F.contains(clock, F.lit(".")), fraction).otherwise(F.lit(0))
    away = F.replace(F.substring(zone, 2, 8), F.lit(":"), F.lit(""))
    off_hour, off_minute, off_second = (_part(away, at) for at in (1, 3, 5))
    exists = (hour < 24) & (minute < 60) & (second < 60) & (off_hour < 24) & (off_minute < 60) & (off_second < 60)
    offset = (off_hour * 3600 + off_minute * 60 + off_second) * F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    seconds = F.unix_date(_iso_date(date)).cast("long") * 86_400 + hour * 3600 + minute * 60 + second - offset
    return F.when(exists, seconds * 1_000_000 + micros)


def parse_iso(text: Column) -> Column:
    """ISO text to TIMESTAMP with millisecond precision; NULL when it is not a valid instant.

    Text without a zone is read as UTC whatever the session zone is.  Any character that is no digit may stand
    between date and time.  The usual form is cast; only others are taken apart.
    """
    plain = F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$"))
    parsed = F.when(plain, F.unix_micros(text.try_cast("timestamp"))).when(F.regexp_like(text, F.lit(ISO_PATTERN)), _iso_micros(text))
    return F.timestamp_millis(F.floor(parsed / 1000).cast("long"))


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP to ISO text with milliseconds and zone (session zone is UTC in all jobs)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def in_business_hours(ts: Column, start: str = BUSINESS_HOURS[0], end: str = BUSINESS_HOURS[1]) -> Column:
    """Whether the HH:MM of ``ts`` lies in [start, end], both ends included."""
    return F.date_format(ts, "HH:mm").between(start, end)
