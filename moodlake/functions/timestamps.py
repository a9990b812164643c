"""Timestamps: six text formats in, one type out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moodlake.functions.text import _col, strip

# The accepted shapes with their patterns, first match wins. The
# weekday is cut off before parsing, since Spark does not parse weekdays.
# 1 Mon Apr 06 22:19:45 PDT 2009
# 2 Mon Apr 06 22:19:45 -0700 2009, also -07:00 or Z
# 3 2024-01-02T03:04:05Z, +05:00 or +0500, with up to six fractional digits
# 4 2024-01-02 03:04:05
# 5 13/01/2024 03:04:05, day first
# 6 01/13/2024 03:04:05, month first, reached when day first is impossible
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_NAMED_DAY = (
    r"(?i)^(mon|tue|wed|thu|fri|sat|sun) (jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) \d{1,2} "
)
_NAMED_ZONE = rf"{_NAMED_DAY}{_CLOCK} [a-z]{{2,5}} \d{{4}}$"
_WITH_WEEKDAY = (
    (rf"{_NAMED_DAY}{_CLOCK} (Z|[+-]\d{{4}}) \d{{4}}$", "MMM d H:m:s XX yyyy"),
    (rf"{_NAMED_DAY}{_CLOCK} [+-]\d\d:\d\d \d{{4}}$", "MMM d H:m:s xxx yyyy"),
)
_NUMERIC = (
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}T{_CLOCK}(\.\d{{1,6}})?(Z|[+-]\d\d:\d\d)$", "yyyy-M-d'T'H:m:s[.SSSSSS]XXX"),
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}T{_CLOCK}(\.\d{{1,6}})?[+-]\d{{4}}$", "yyyy-M-d'T'H:m:s[.SSSSSS]xx"),
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}} {_CLOCK}$", "yyyy-M-d H:m:s"),
    # A second number above 12 is no month, and only then can month first succeed
    # where day first does not.
    (rf"^\d{{1,2}}/(1[3-9]|[2-9]\d)/\d{{4}} {_CLOCK}$", "M/d/yyyy H:m:s"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_CLOCK}$", "d/M/yyyy H:m:s"),
)

# Offsets of the zone names of RFC 822. Java would take these for
# regions and apply daylight saving by date instead of by name.
ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _parse(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern))


def _offsets() -> Column:
    return F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])


def _parse_named_zone(raw: Column) -> Column:
    # The shape is known here: six words, one space apart, the zone the fifth.
    zone = F.upper(F.substring_index(F.substring_index(raw, " ", -2), " ", 1))
    date = F.substring_index(F.substring_index(raw, " ", 4), " ", -3)
    offset = F.try_element_at(_offsets(), zone)
    numeric = F.concat_ws(" ", date, offset, F.substring_index(raw, " ", -1))
    by_offset = _parse(numeric, "MMM d H:m:s XX yyyy")
    by_name = _parse(F.substring_index(raw, " ", -5), "MMM d H:m:s zzz yyyy")
    return F.when(zone.isin(*ZONE_OFFSETS), by_offset).otherwise(by_name)


def parse_timestamp(c: Column | str) -> Column:
    """The instant in ``c``, or NULL when no format fits.

    The shape picks the one pattern that can fit, so no row pays for failing
    through the list. Words are cut out by position, not by regex, since Spark
    evaluates them again wherever a branch names them.
    """
    raw = F.regexp_replace(strip(c), r"\s+", " ")
    out = F.when(F.rlike(raw, F.lit(_NAMED_ZONE)), _parse_named_zone(raw))
    for shape, pattern in _WITH_WEEKDAY:
        out = out.when(F.rlike(raw, F.lit(shape)), _parse(F.substring_index(raw, " ", -5), pattern))
    for shape, pattern in _NUMERIC:
        out = out.when(F.rlike(raw, F.lit(shape)), _parse(raw, pattern))
    return out


def normalise_timestamp(c: Column | str, default: Column | None = None) -> Column:
    """``parse_timestamp`` with ``default`` for text that is no timestamp.

    The default is the caller's choice (``F.current_timestamp()`` for arrival
    time); without one the result is NULL and can be counted.
    """
    parsed = parse_timestamp(c)
    return parsed if default is None else F.coalesce(parsed, default)


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text with offset; fractions only where there are any."""
    ts = _col(ts)
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, ISO_SECONDS)).otherwise(F.date_format(ts, ISO_MICROS))


def iso_timestamp(c: Column | str) -> Column:
    """ISO text to timestamp, NULL for bad text.

    ``to_timestamp`` raises under ANSI mode, and one bad row would stop a stream.
    """
    return F.try_to_timestamp(_col(c))
