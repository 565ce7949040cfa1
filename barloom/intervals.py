"""The bar intervals, their lengths and how many bars of each a calendar day may hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interval name, length in milliseconds, bars a day.
INTERVALS = {
    "1d": (86_400_000, 1),
    "4h": (14_400_000, 6),
    "1h": (3_600_000, 24),
    "15m": (900_000, 96),
    "5m": (300_000, 288),
    "3m": (180_000, 480),
    "1m": (60_000, 1440),
}


class UnknownInterval(ValueError):
    """An interval that is not in INTERVALS."""


def interval_ms(interval: str) -> int:
    try:
        return INTERVALS[interval][0]
    except KeyError:
        raise UnknownInterval(f"unsupported interval: {interval!r}") from None


def bars_per_day(interval: str) -> int:
    interval_ms(interval)
    return INTERVALS[interval][1]


def expand_intervals(token: str) -> list[str]:
    """'all' or a list separated by commas, each name checked, in the order given."""
    if token.strip().lower() == "all":
        return list(INTERVALS)
    names = [x.strip() for x in token.split(",") if x.strip()]
    for x in names:
        interval_ms(x)
    return list(dict.fromkeys(names))


def _case(interval: Column, at: int) -> Column:
    expr = F.lit(None).cast("long")
    for name, row in INTERVALS.items():
        expr = F.when(interval == name, F.lit(row[at]).cast("long")).otherwise(expr)
    return expr


def ms_of(interval: Column) -> Column:
    """Length in milliseconds; null for an unknown interval."""
    return _case(interval, 0)


def cap_of(interval: Column) -> Column:
    """Bars a calendar day may hold; null for an unknown interval."""
    return _case(interval, 1)


def floor_to(x: Column, step: Column) -> Column:
    """The grid point at or before x, also below zero."""
    return x - F.pmod(x, step)


def nearest_slot(x: Column, step: Column) -> Column:
    """Start of the grid cell whose start is nearest to x; exactly half way goes up."""
    y = x + (step / 2).cast("long")
    return y - F.pmod(y, step)
