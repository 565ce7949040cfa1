"""Gaps, lag and backfill plans of series, for all series in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.intervals import ms_of

SERIES = ["symbol", "interval"]
#: Distinct bars in a chunk of a series, for the windows that look for gaps.
CHUNK = 4096


def _div(a: Column, b: Column) -> Column:
    """Floor division."""
    return F.call_function("div", a - F.pmod(a, b), b)


def latest_closed(interval: Column, now_ms: int, lag_ms: int = 2000) -> Column:
    """open_time of the last bar that has closed, lag_ms before now."""
    ms = ms_of(interval)
    return _div(F.lit(now_ms - lag_ms).cast("long"), ms) * ms - ms


def gaps(bars: DataFrame) -> DataFrame:
    """(symbol, interval, start, end, missing): the stretches of bars missing between two neighbours of a series. A gap is counted in whole intervals between the distinct open_times, rounded down.

    Windows run over chunks of a series; between chunks the first and last of each are compared, so no task holds a whole series."""
    ms = ms_of(F.col("interval"))
    one = bars.select(*SERIES, "open_time").where("open_time is not null").distinct().withColumn("chunk", _div(F.col("open_time"), ms * CHUNK))
    inner = Window.partitionBy(*SERIES, "chunk").orderBy("open_time")
    within = one.select(*SERIES, F.lag("open_time").over(inner).alias("before"), "open_time")
    ends = one.groupBy(*SERIES, "chunk").agg(F.min("open_time").alias("open_time"), F.max("open_time").alias("last"))
    between = ends.select(*SERIES, F.lag("last").over(Window.partitionBy(*SERIES).orderBy("chunk")).alias("before"), "open_time")
    step = _div(F.col("open_time") - F.col("before"), ms)
    found = within.unionByName(between).where("before is not null").withColumn("missing", step - 1).where("missing > 0")
    return found.select(*SERIES, (F.col("before") + ms).alias("start"), (F.col("before") + ms * F.col("missing")).alias("end"), "missing")


def continuity(bars: DataFrame, now_ms: int, lag_ms: int = 2000) -> DataFrame:
    """A row a series: rows, min and max open_time, duplicates, misaligned, close_mismatches, missing, latest_closed, lag_bars and status (ok or gap_detected). Series without bars have no row; see continuity_of() for a given list."""
    ms = ms_of(F.col("interval"))
    n = lambda x: F.count(F.when(x, 1))
    keys = bars.where("open_time is not null").groupBy(*SERIES, "open_time").agg(F.count(F.lit(1)).alias("n"), n(F.col("close_time").isNull() | (F.col("close_time") != F.col("open_time") + ms - 1)).alias("bad"))
    per = keys.groupBy(*SERIES).agg(F.sum("n").alias("rows"), F.min("open_time").alias("min_open_time"), F.max("open_time").alias("max_open_time"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum(F.when(F.pmod("open_time", ms) != 0, F.col("n")).otherwise(0)).alias("misaligned"), F.sum("bad").alias("close_mismatches"))
    holes = gaps(bars).groupBy(*SERIES).agg(F.sum("missing").alias("missing"))
    out = per.join(holes, SERIES, "left").withColumn("missing", F.coalesce("missing", F.lit(0))).withColumn("latest_closed", latest_closed(F.col("interval"), now_ms, lag_ms))
    out = out.withColumn("lag_bars", F.greatest(F.lit(0), _div(F.col("latest_closed") - F.col("max_open_time"), ms)))
    bad = F.col("duplicates") + F.col("misaligned") + F.col("close_mismatches") + F.col("missing") > 0
    return out.withColumn("status", F.when(bad, "gap_detected").otherwise("ok"))


def continuity_of(bars: DataFrame, wanted: DataFrame, now_ms: int, lag_ms: int = 2000) -> DataFrame:
    """continuity() for the series in wanted; one without bars has status empty."""
    out = wanted.select(*SERIES).distinct().join(continuity(bars, now_ms, lag_ms), SERIES, "left")
    return out.withColumn("status", F.coalesce("status", F.lit("empty"))).withColumn("rows", F.coalesce("rows", F.lit(0))).withColumn("latest_closed", latest_closed(F.col("interval"), now_ms, lag_ms))


def overall(results: DataFrame, by: list[str]) -> DataFrame:
    """(by, overall_status, series): empty when all are, gap_detected when any has one, else ok."""
    s = F.when(F.every(F.col("status") == "empty"), "empty").when(F.bool_or(F.col("status") == "gap_detected"), "gap_detected").otherwise("ok")
    return results.groupBy(*by).agg(s.alias("overall_status"), F.count(F.lit(1)).alias("series"))


def backfill_plan(wanted: DataFrame, state: DataFrame, bars: DataFrame, now_ms: int, lag_ms: int = 2000) -> DataFrame:
    """(symbol, interval, source, last_closed, latest_closed, missing, start, end, status) for each wanted series: the last closed bar from state (symbol, interval, last_closed_open_time), else from the bars, else bootstrap_required."""
    ms = ms_of(F.col("interval"))
    s = state.groupBy(*SERIES).agg(F.max("last_closed_open_time").alias("_s"))
    b = bars.groupBy(*SERIES).agg(F.max("open_time").alias("_b"))
    out = wanted.select(*SERIES).distinct().join(s, SERIES, "left").join(b, SERIES, "left")
    out = out.withColumn("last_closed", F.coalesce("_s", "_b")).withColumn("source", F.when(F.col("_s").isNotNull(), "state").when(F.col("_b").isNotNull(), "current_dataset").otherwise("bootstrap_required"))
    out = out.withColumn("latest_closed", latest_closed(F.col("interval"), now_ms, lag_ms))
    out = out.withColumn("missing", F.greatest(F.lit(0), F.coalesce(_div(F.col("latest_closed") - F.col("last_closed"), ms), F.lit(0))))
    some = F.col("missing") > 0
    return out.select(*SERIES, "source", "last_closed", "latest_closed", "missing", F.when(some, F.col("last_closed") + ms).alias("start"), F.when(some, F.col("latest_closed")).alias("end"), F.when(F.col("last_closed").isNull(), "bootstrap_required").when(some, "missing").otherwise("up_to_date").alias("status"))


def stale_streams(wanted: DataFrame, seen: DataFrame, now_ms: int, multiplier: int = 3) -> DataFrame:
    """(symbol, interval, last_message_ms, threshold_ms) of the wanted series whose last message, in seen as (symbol, interval, message_ms), is older than multiplier intervals, or that never had one."""
    last = seen.groupBy(*SERIES).agg(F.max("message_ms").alias("last_message_ms"))
    out = wanted.select(*SERIES).distinct().join(last, SERIES, "left").withColumn("threshold_ms", ms_of(F.col("interval")) * multiplier)
    return out.where(F.col("last_message_ms").isNull() | (F.lit(now_ms) - F.col("last_message_ms") > F.col("threshold_ms")))


def flush_state(state: DataFrame, merged: DataFrame, monotone: bool = True) -> DataFrame:
    """state (symbol, interval, last_closed_open_time, merged_bars) after merges (symbol, interval, max_open_time, input_rows). monotone keeps the largest open_time; without it the merged partition's maximum replaces the old one, also when that is earlier."""
    m = merged.groupBy(*SERIES).agg(F.max("max_open_time").alias("_m"), F.sum("input_rows").alias("_n"))
    out = state.join(m, SERIES, "full")
    last = F.greatest("last_closed_open_time", "_m") if monotone else F.coalesce("_m", "last_closed_open_time")
    return out.select(*SERIES, last.alias("last_closed_open_time"), (F.coalesce("merged_bars", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("merged_bars"))
