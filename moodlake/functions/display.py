"""Report formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moodlake.functions.text import _col


def thousands(n: Column | str) -> Column:
    """1234567 -> 1,234,567"""
    return F.format_number(_col(n), 0)


def percent(x: Column | str) -> Column:
    """One decimal with a percent sign."""
    return F.concat(F.format_number(_col(x), 1), F.lit("%"))


def clock(ts: Column | str) -> Column:
    """24-hour time."""
    return F.date_format(_col(ts), "HH:mm:ss")


def alert_badge(n: Column | str) -> Column:
    """One alert per 800 posts, at most 99."""
    return F.least(F.lit(99), F.floor(_col(n) / 800)).cast("int")
