"""Calendar fields of a bar: UTC, and UTC+8 for the calendar day it is filed under. No session time zone takes part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_time(ms: Column) -> Column:
    """Epoch ms as a time without zone."""
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH))


def millis_of(t: Column) -> Column:
    """Epoch ms of a time without zone, read as UTC whatever the session's zone; rounds down."""
    us = F.timestamp_diff("MICROSECOND", F.expr(EPOCH), t.cast("timestamp_ntz"))
    return F.call_function("div", us - F.pmod(us, F.lit(1000)), F.lit(1000))


def taipei_time(ms: Column) -> Column:
    return utc_time(ms) + F.expr("interval 8 hours")


def iso(t: Column, ms: Column) -> Column:
    """ISO text of a time; a fraction only where there is one, with six digits."""
    frac = F.pmod(ms, F.lit(1000))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.when(frac != 0, F.concat(F.lit("."), F.lpad(frac.cast("string"), 3, "0"), F.lit("000"))).otherwise(""))


def with_calendar(df: DataFrame, open_time: str = "open_time", text: bool = False) -> DataFrame:
    """Adds open_time_utc, open_time_taipei (as times, or as ISO text), date, year and month, all from open_time; columns of these names are replaced. Null gives nulls."""
    ms = F.col(open_time)
    utc, local = utc_time(ms), taipei_time(ms)
    return df.withColumns(
        {
            "open_time_utc": iso(utc, ms) if text else utc,
            "open_time_taipei": iso(local, ms) if text else local,
            "date": F.date_format(local, "yyyy-MM-dd"),
            "year": F.year(local),
            "month": F.month(local),
        }
    )


def month_partitions(start_ms: int, end_ms: int) -> list[tuple[int, int]]:
    """(year, month) of the UTC+8 calendar that [start_ms, end_ms) touches, for pruning partitions by hand."""
    from datetime import datetime, timedelta, timezone

    if end_ms <= start_ms:
        return []
    zone = timezone(timedelta(hours=8))
    a = datetime.fromtimestamp(start_ms / 1000, zone)
    b = datetime.fromtimestamp((end_ms - 1) / 1000, zone)
    n0, n1 = a.year * 12 + a.month - 1, b.year * 12 + b.month - 1
    return [(n // 12, n % 12 + 1) for n in range(n0, n1 + 1)]
