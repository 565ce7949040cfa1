"""Schemas of bars at rest and on the way."""

from __future__ import annotations

from pyspark.sql import types as T

PRICES = ["open", "high", "low", "close"]
#: The values that make two bars of a key the same; provenance isn't one of them.
VALUES = ["open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"]
KEY = ["symbol", "interval", "open_time"]
PROVENANCE = ["source_archive", "archive_source", "archive_period"]
_LONGS = {"open_time", "close_time", "trade_count"}


def _field(name: str) -> T.StructField:
    kind = T.LongType() if name in _LONGS else T.DoubleType()
    return T.StructField(name, kind)


#: The columns of an archive's CSV by position; a twelfth is ignored.
CSV = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"]

#: A bar with its key and provenance.
BAR = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("interval", T.StringType()), *[_field(c) for c in CSV], *[T.StructField(c, T.StringType()) for c in PROVENANCE]])

#: What a file of the seed layer holds; symbol and year come from its path.
SEED = ["interval", "open_time", "open_time_utc", "open_time_taipei", "date", "month", *PRICES, "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", *PROVENANCE]
#: What a file of the current layer holds besides.
CURRENT = [*SEED, "schema_version", "dataset_version"]
SCHEMA_VERSION, DATASET_VERSION = 1, "current-v1"
