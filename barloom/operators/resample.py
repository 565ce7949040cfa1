"""Bars from ticks, and coarser bars from finer ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.intervals import floor_to, interval_ms


def bars_from_ticks(ticks: DataFrame, interval: str) -> DataFrame:
    """(symbol, interval, open_time, open, high, low, close, volume, trade_count, close_time) from ticks (symbol, time_ms, seq, price, size); first and last by time and seq. Ticks without symbol, time or price count for nothing."""
    ms = F.lit(interval_ms(interval)).cast("long")
    at = F.struct("time_ms", "seq")
    out = ticks.where("symbol is not null and time_ms is not null and price is not null").groupBy("symbol", floor_to(F.col("time_ms"), ms).alias("open_time"))
    out = out.agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("size").alias("volume"), F.count(F.lit(1)).alias("trade_count"))
    return out.select("symbol", F.lit(interval).alias("interval"), "open_time", "open", "high", "low", "close", "volume", "trade_count", (F.col("open_time") + ms - 1).alias("close_time"))


def coarser(bars: DataFrame, interval: str) -> DataFrame:
    """Bars of a longer interval from those of a shorter one; bars must be single per key. parts is the number of bars in each."""
    ms = F.lit(interval_ms(interval)).cast("long")
    out = bars.where("symbol is not null and open_time is not null").groupBy("symbol", floor_to(F.col("open_time"), ms).alias("_o"))
    out = out.agg(F.min_by("open", "open_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_time").alias("close"), F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"), F.count(F.lit(1)).alias("parts"))
    return out.select("symbol", F.lit(interval).alias("interval"), F.col("_o").alias("open_time"), "open", "high", "low", "close", "volume", "trade_count", (F.col("_o") + ms - 1).alias("close_time"), "parts")
