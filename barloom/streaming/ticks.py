"""Live payloads to bars: rows of a REST answer, kline messages with or without an envelope, and flat webhook objects.

Messages have keys that differ only in case, so they are read as VARIANT, never as structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import taipei_time
from barloom.intervals import INTERVALS
from barloom.schema import CSV

# Keys of the fields of a kline message, in the order of schema.CSV.
KLINE_KEYS = ["t", "o", "h", "l", "c", "v", "T", "q", "n", "V", "Q"]
# Provenance of each channel, source_archive and archive_source.
CHANNELS = {"rest": ("live_rest:/v1/bars", "live_rest"), "websocket": ("live_websocket:kline", "live_websocket"), "webhook": ("live_webhook:kline", "live_webhook")}
TYPES = {c: "long" if c in ("open_time", "close_time", "trade_count") else "double" for c in CSV}


def _fixed(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """df with cols computed once: a generator between the projections, so later conditions on cols aren't pushed into, and repeated inside, the expressions they come from."""
    return df.select(*[c for c in df.columns if c not in cols], F.inline(F.array(F.struct(*[e.alias(n) for n, e in cols.items()]))))


def _finish(df: DataFrame, channel: str, first_error: Column) -> DataFrame:
    archive, source = CHANNELS[channel]
    bad = F.lit(None).cast("string")
    for c in reversed(CSV):
        bad = F.when(F.col(c).isNull(), F.lit(f"cannot read {c}")).otherwise(bad)
    known = F.col("interval").isin(list(INTERVALS))
    rest = F.when(F.col("symbol").isNull() | (F.col("symbol") == ""), "payload has no symbol").when(~F.coalesce(known, F.lit(False)), F.concat(F.lit("unsupported interval: "), F.coalesce("interval", F.lit("")))).otherwise(bad)
    return df.withColumn("error", F.coalesce(first_error, rest)).withColumns({"source_archive": F.lit(archive), "archive_source": F.lit(source), "archive_period": F.date_format(taipei_time(F.col("open_time")), "yyyy-MM-dd")})


def parse_rest(rows: DataFrame, now_ms: Column, lag_ms: int = 2000) -> DataFrame:
    """rows (symbol, interval, payload, ...) with a bar's columns, is_closed and error. payload is a JSON array of at least eleven elements by position. A bar is closed when close_time lies lag_ms before now."""
    df = _fixed(rows.withColumn("symbol", F.upper("symbol")), {"_a": F.from_json("payload", "array<string>")})
    short = F.when(F.col("_a").isNull(), "payload is not a JSON array").when(F.size("_a") < 11, "bar has fewer than 11 fields")
    df = _fixed(df, {c: F.try_element_at("_a", F.lit(i + 1)).try_cast(TYPES[c]) for i, c in enumerate(CSV)} | {"_error": short})
    df = df.withColumn("is_closed", F.col("close_time") <= now_ms - lag_ms)
    return _finish(df.drop("_a"), "rest", F.col("_error")).drop("_error")


def _get(v: str, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is_object(c: Column) -> Column:
    return F.coalesce(F.schema_of_variant(c).startswith("OBJECT"), F.lit(False))


def _truth(c: Column) -> Column:
    """Truth of a JSON value: a text is true when it isn't empty, a number when it isn't zero."""
    kind = F.schema_of_variant(c)
    return F.when(c.isNull() | (kind == "VOID"), False).when(kind == "BOOLEAN", F.try_variant_get(c, "$", "boolean")).when(kind == "STRING", F.try_variant_get(c, "$", "string") != "").when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), True).otherwise(F.coalesce(F.try_variant_get(c, "$", "double") != 0, F.lit(True)))


def _permissive(c: Column) -> Column:
    """true, 1, yes, false, 0 and no as texts; null for a missing value; else the value's truth."""
    text = F.lower(F.trim(F.try_variant_get(c, "$", "string")))
    kind = F.schema_of_variant(c)
    return F.when(c.isNull() | (kind == "VOID"), F.lit(None).cast("boolean")).when((kind == "STRING") & text.isin("true", "1", "yes"), True).when((kind == "STRING") & text.isin("false", "0", "no"), False).otherwise(_truth(c))


def parse_messages(df: DataFrame, channel: str, now_ms: Column, lag_ms: int = 2000) -> DataFrame:
    """df (payload, ...) with payload_format, stream, a bar's columns, is_closed and error (null when the payload can be read).

    payload_format: 'combined' for an envelope {stream, data}, 'raw' for a kline message, 'normalized' for a flat object with the bar's columns by name (webhooks only). is_closed of a message is the truth of k.x as JSON has it, so the text "false" counts as true; a flat object's is read permissively, and derived from the clock where it is missing.
    Unreadable, empty and null payloads get an error and null fields."""
    df = df.withColumn("_v", F.try_parse_json("payload"))
    df = df.withColumn("_object", _is_object(F.col("_v"))).withColumn("_env", F.coalesce(F.col("_object") & _get("_v", "$.stream", "string").isNotNull() & _get("_v", "$.data", "variant").isNotNull(), F.lit(False)))
    df = df.withColumn("_d", F.when(F.col("_env"), _get("_v", "$.data", "variant")).otherwise(F.col("_v")))
    df = df.withColumn("_k", _get("_d", "$.k", "variant"))
    df = df.withColumn("_kline", F.coalesce(_get("_d", "$.e", "string") == "kline", F.lit(False)) & _is_object(F.col("_k")))
    df = df.withColumn("_flat", ~F.col("_kline") & ~F.col("_env") & F.col("_object") & F.lit(channel == "webhook"))
    # One map of texts by key, case kept, for either shape.
    df = _fixed(df, {"_m": F.when(F.col("_kline"), _get("_k", "$", "map<string,string>")).when(F.col("_flat"), _get("_v", "$", "map<string,string>"))} | {c: F.col(c) for c in ("_object", "_env", "_d", "_k", "_kline", "_flat", "_v")})
    at = lambda k, c: F.try_element_at("_m", F.when(F.col("_kline"), F.lit(k)).otherwise(F.lit(c)))
    cols = {c: at(k, c).try_cast(TYPES[c]) for c, k in zip(CSV, KLINE_KEYS, strict=True)}
    cols["symbol"] = F.upper(F.coalesce(F.nullif(at("s", "symbol"), F.lit("")), F.when(F.col("_kline"), _get("_d", "$.s", "string"))))
    cols["interval"] = at("i", "interval")
    cols["payload_format"] = F.when(F.col("_kline") & F.col("_env"), "combined").when(F.col("_kline"), "raw").when(F.col("_flat"), "normalized")
    df = _fixed(df, cols)
    needed = F.array(*[F.lit(c) for c in ["symbol", "interval", *CSV]])
    lacking = F.when(F.col("_flat"), F.array_except(needed, F.map_keys("_m")))
    given = _permissive(_get("_v", "$.is_closed", "variant"))
    closed = F.when(F.col("_kline"), _truth(_get("_k", "$.x", "variant"))).when(F.col("_flat"), F.coalesce(given, F.col("close_time") <= now_ms - lag_ms))
    stream = F.coalesce(F.when(F.col("_env"), _get("_v", "$.stream", "string")), F.when(F.col("_kline"), F.concat(F.lower("symbol"), F.lit("@kline_"), F.col("interval"))))
    error = F.when(~F.col("_object"), "payload is not a JSON object").when(~F.col("_kline") & ~F.col("_flat"), "payload is not a kline event").when(F.size(lacking) > 0, F.concat(F.lit("payload lacks: "), F.array_join(lacking, ", ")))
    df = _fixed(df, {"is_closed": closed, "stream": stream, "_error": error}).drop("_v", "_object", "_env", "_d", "_k", "_kline", "_flat", "_m")
    return _finish(df, channel, F.col("_error")).drop("_error")
