"""Rules on bars: one pass over the rows for any number of counts, flags for quarantine, and messages for live bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import taipei_time
from barloom.intervals import cap_of, ms_of

#: Value columns that must not be null.
REQUIRED = ["symbol", "interval", "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", "source_archive", "archive_source", "archive_period"]

# The messages about a live bar in their order; the fourth takes the expected and the found close_time.
MESSAGES = [
    "symbol is required",
    "open_time must be non-negative",
    "open_time is not aligned to interval",
    "close_time mismatch: expected %d, got %d",
    "OHLC invalid: high is below open/close/low",
    "OHLC invalid: low is above open/close/high",
    "volume must be non-negative",
    "quote_volume must be non-negative",
    "trade_count must be non-negative",
    "taker_buy_base_volume must be non-negative",
    "taker_buy_quote_volume must be non-negative",
    "closed Kline close_time must be >= open_time",
]


def _nan(c: str) -> Column:
    return F.coalesce(F.isnan(F.col(c)), F.lit(False))


def bar_valid(parity: bool = True) -> Column:
    """Whether the prices fit each other and volumes and trades aren't negative. NaN or null in any of them makes a bar invalid. Never null."""
    c = F.col
    rules = [c("high") >= c("low"), c("high") >= c("open"), c("high") >= c("close"), c("low") <= c("open"), c("low") <= c("close"), c("volume") >= 0, c("quote_volume") >= 0, c("trade_count") >= 0]
    numbers = [~_nan(x) for x in ("open", "high", "low", "close", "volume", "quote_volume")]
    return F.coalesce(reduce(lambda a, b: a & b, rules + numbers), F.lit(False))


def aligned() -> Column:
    return F.pmod(F.col("open_time"), ms_of(F.col("interval"))) == 0


def close_fits() -> Column:
    return F.try_subtract(F.col("close_time"), F.col("open_time")) == ms_of(F.col("interval")) - 1


def time_valid() -> Column:
    """Whether open_time lies on the grid and close_time ends the bar. Never null."""
    return F.coalesce(aligned() & close_fits(), F.lit(False))


def with_quarantine(bars: DataFrame) -> DataFrame:
    """Adds ohlc_bad, time_bad and quarantined. A bar that fails both counts in both flags and once in quarantined."""
    flagged = bars.withColumns({"ohlc_bad": ~bar_valid(), "time_bad": ~time_valid()})
    return flagged.withColumn("quarantined", F.col("ohlc_bad") | F.col("time_bad"))


def time_details(bars: DataFrame) -> DataFrame:
    """Bars with a wrong time, with open_time_mod and expected_close_time."""
    ms = ms_of(F.col("interval"))
    return bars.where(~time_valid()).withColumns({"open_time_mod": F.pmod(F.col("open_time"), ms), "expected_close_time": F.col("open_time") + ms - 1})


def live_errors(strict: bool = True, closed: Column | None = None) -> Column:
    """The messages about a live bar, in a fixed order, as an array. Without strict, a NaN passes the comparisons that are written as violations; with it, a NaN price or volume counts as violating them."""
    c, ms = F.col, ms_of(F.col("interval"))
    nan = lambda *xs: reduce(lambda a, b: a | b, [_nan(x) for x in xs]) if strict else F.lit(False)
    top, bottom = F.greatest("open", "close", "low"), F.least("open", "close", "high")
    plain = lambda bad, *xs: (bad & ~reduce(lambda a, b: a | b, [_nan(x) for x in xs])) | nan(*xs)
    expected = c("open_time") + ms - 1
    violated = [
        c("symbol").isNull() | (c("symbol") == ""),
        c("open_time") < 0,
        F.pmod(c("open_time"), ms) != 0,
        c("close_time") != expected,
        plain(c("high") < top, "high", "open", "close", "low"),
        plain(c("low") > bottom, "low", "open", "close", "high"),
        plain(c("volume") < 0, "volume"),
        plain(c("quote_volume") < 0, "quote_volume"),
        c("trade_count") < 0,
        plain(c("taker_buy_base_volume") < 0, "taker_buy_base_volume"),
        plain(c("taker_buy_quote_volume") < 0, "taker_buy_quote_volume"),
        (F.lit(True) if closed is None else closed) & (c("close_time") < c("open_time")),
    ]
    said = [F.format_string(m, expected, c("close_time")) if "%d" in m else F.lit(m) for m in MESSAGES]
    checks = zip(violated, said, strict=True)
    return F.array_compact(F.array(*[F.when(bad, text) for bad, text in checks]))


def fused_counts(bars: DataFrame, by: list[str]) -> DataFrame:
    """All counts of the validation in one scan: rows, null_rows, ohlc_bad, date_bad, misaligned, close_bad, first and last date."""
    nulls = reduce(lambda a, b: a | b, [F.col(x).isNull() for x in REQUIRED])
    n = lambda x: F.count(F.when(x, 1))
    day = F.date_format(taipei_time(F.col("open_time")), "yyyy-MM-dd")
    day_number = F.col("date").try_cast("date")  # a number underneath, so the aggregation stays hashed
    return bars.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), n(nulls).alias("null_rows"), n(~bar_valid()).alias("ohlc_bad"), n(F.col("date").isNotNull() & (F.col("date") != day)).alias("date_bad"), n(~aligned()).alias("misaligned"), n(~close_fits()).alias("close_bad"), F.min(day_number).cast("string").alias("date_min"), F.max(day_number).cast("string").alias("date_max"))


def null_counts(bars: DataFrame, columns: list[str]) -> DataFrame:
    """(field, nulls) for each column, from one scan."""
    one = bars.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("nulls")) for c in columns])).alias("x")).select("x.field", "x.nulls")


def duplicate_keys(bars: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """(by, keys, duplicated): distinct keys and those with more than one row."""
    return bars.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).groupBy(*by).agg(F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("n") > 1, 1)).alias("duplicated"))


def over_cap(bars: DataFrame) -> DataFrame:
    """(symbol, interval, date, rows, cap) of days with more bars than the interval allows."""
    days = bars.groupBy("symbol", "interval", "date").agg(F.count(F.lit(1)).alias("rows"))
    return days.withColumn("cap", cap_of(F.col("interval"))).where(F.col("rows") > F.col("cap"))


def first_samples(rows: DataFrame, by: list[str], order: list[str], each: int, total: int | None = None) -> DataFrame:
    """The first `each` rows of every group, and of those the first `total`; a report's sample. A group's rows are narrowed in its own partition first."""
    w = Window.partitionBy(*by).orderBy(*order)
    out = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= each).drop("_rn")
    return out if total is None else out.orderBy(*by, *order).limit(total)


#: Finer interval, coarser one, the least ratio of their row counts.
RATIOS = [("4h", "1d", 1.0), ("1h", "4h", 3.5), ("15m", "1h", 3.5), ("5m", "15m", 2.5), ("3m", "5m", 1.5), ("1m", "3m", 2.5)]


def ratio_checks(counts: DataFrame, full: bool = True) -> DataFrame:
    """(rule_id, fine_rows, coarse_rows, status) for rows (interval, rows): passed when the finer interval has enough rows, skipped where the output isn't full or one is missing."""
    spark = counts.sparkSession
    pairs = spark.createDataFrame([(f"PQ-{a.upper()}-ROWS-GT-{b.upper()}", a, b, r) for a, b, r in RATIOS], "rule_id string, fine string, coarse string, least double")
    got = pairs.join(counts.select(F.col("interval").alias("fine"), F.col("rows").alias("fine_rows")), "fine", "left").join(counts.select(F.col("interval").alias("coarse"), F.col("rows").alias("coarse_rows")), "coarse", "left")
    enough = F.when(F.col("fine") == "4h", F.col("fine_rows") > F.col("coarse_rows")).otherwise(F.col("fine_rows") >= F.col("least") * F.col("coarse_rows"))
    known = F.col("fine_rows").isNotNull() & F.col("coarse_rows").isNotNull() & F.lit(full)
    return got.select("rule_id", "fine_rows", "coarse_rows", F.when(~known, "skipped").when(enough, "passed").otherwise("failed").alias("status"))
