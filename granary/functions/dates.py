"""Date and time scalar expressions. All arithmetic is on UTC instants."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, for zoned and zone-less timestamps alike."""
    return F.unix_timestamp(ts.cast("timestamp"))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Floor of the elapsed days between two timestamps (not calendar dates)."""
    return F.floor((epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(86400)).cast("long")


def months_elapsed(as_of: str, ts: Column, month_lag: Column) -> Column:
    """30-day months from ``ts`` to a fixed reference day, plus the recorded lag."""
    days = whole_days_between(F.lit(as_of).cast("timestamp"), ts)
    return F.floor(days / F.lit(30)).cast("long") + month_lag


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Calendar parts; ``dow`` counts Monday as 0 and ``week`` is the ISO week."""
    return {
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "week": F.weekofyear(ts),
        "day": F.dayofmonth(ts),
        "dow": F.weekday(ts),
        "hour": F.hour(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "month_abbr": F.date_format(ts, "MMM"),
    }


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def in_months(ts: Column, months: tuple[int, ...]) -> Column:
    return F.month(ts).isin(*months).cast("int")


def compact_date(text: Column) -> Column:
    """``yyyymmdd`` text or integer to a date; NULL when it is not one."""
    return F.try_to_date(text.cast("string"), "yyyyMMdd")


def weekly_fourier(day: Column, order: int) -> dict[str, Column]:
    """Sine and cosine terms of a weekly cycle.

    Seven daily points carry three independent harmonics, so higher orders only repeat
    earlier ones and are left out.
    """
    phase = F.weekday(day).cast("double") * F.lit(2.0 * math.pi / 7.0)
    terms = {}
    for k in range(1, min(order, 3) + 1):
        terms[f"sin_{k}"] = F.sin(phase * F.lit(float(k)))
        terms[f"cos_{k}"] = F.cos(phase * F.lit(float(k)))
    return terms
