"""Timetable times as columns: text to seconds, windows, headways. Null in, null out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY, HOUR = 86_400, 3_600
WINDOW_START, WINDOW_END = 6 * HOUR, 22 * HOUR


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _parts(text: Column, f: Callable[[Column, Column, Column], Column]) -> Column:
    """f of the integer parts of "H:MM:SS", each null where it is missing or no plain number (signs and spaces around are
    allowed)."""
    numbers = F.transform(F.split(text, ":"), lambda x: x.try_cast("int"))
    return once(numbers, lambda p: f(F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2))))


def clock_seconds(text: Column) -> Column:
    """Seconds of the day of "H:MM:SS", hours taken modulo 24; null for minutes or seconds beyond 59 and for fewer than
    three parts."""
    return _parts(text, lambda h, m, s: F.when((m >= 0) & (m <= 59) & (s >= 0) & (s <= 59), F.pmod(h, F.lit(24)) * HOUR + m * 60 + s))


def elapsed_seconds(text: Column) -> Column:
    """Seconds since the start of the service day; hours may exceed 23."""
    return _parts(text, lambda h, m, s: h * HOUR + m * 60 + s)


def clock_text(seconds: Column) -> Column:
    """"HH:MM:SS" of seconds; hours may exceed 23."""
    return once(seconds, lambda t: F.format_string("%02d:%02d:%02d", F.floor(t / HOUR), F.floor(F.pmod(t, F.lit(HOUR)) / 60), F.pmod(t, F.lit(60))))


def in_window(seconds: Column, start: int = WINDOW_START, end: int = WINDOW_END) -> Column:
    return (seconds >= start) & (seconds < end)


def one_day_back(text: Column) -> Column:
    """"HH:MM:SS" with 24 hours taken off once where the hour is 24 or more."""

    def back(p: Column) -> Column:
        hour = once(F.get(p, F.lit(0)).try_cast("int"), lambda h: F.when(h >= 24, h - 24).otherwise(h))
        return F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), F.get(p, F.lit(1)), F.get(p, F.lit(2)))

    return once(F.split(text, ":"), back)


def headway_trips(start: Column, end: Column, headway: Column, lo: int = WINDOW_START, hi: int = WINDOW_END) -> Column:
    """Departures of a headway service within [lo, hi], in closed form; halves round to even."""
    span = F.greatest(F.lit(0), F.least(end, F.lit(hi)) - F.greatest(start, F.lit(lo)))
    return F.when(headway > 0, F.bround(span / headway)).cast("bigint")
