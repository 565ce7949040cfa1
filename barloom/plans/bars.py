"""Queries of the bar operators over the project's tables, with their SQL for DuckDB."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import millis_of, taipei_time, with_calendar
from barloom.functions.identity import SQL_KEYED, unit_factor, with_identity
from barloom.intervals import INTERVALS
from barloom.operators import catalog as C
from barloom.operators import conflicts, continuity, instruments, layout, quality, resample
from barloom.schema import VALUES
from barloom.session import work_dir
from barloom.sources.lake import read_bars
from barloom.streaming import ticks
from barloom.streaming.router import Router

#: The clock of the queries that need one: 2026-07-01 00:00 UTC.
NOW_MS = 1_782_864_000_000
#: A point in time for the universe: 2024-06-01 00:00 UTC.
AT_MS = 1_717_200_000_000
CAPS = "CASE ivl WHEN '1d' THEN 1 WHEN '4h' THEN 6 WHEN '1h' THEN 24 WHEN '15m' THEN 96 WHEN '5m' THEN 288 WHEN '3m' THEN 480 WHEN '1m' THEN 1440 END"

QUERIES: dict = {}
SQL: dict = {}

SQL_CLOSE = "CASE WHEN abs(open_time) < 100000000000 THEN close_time * 1000 WHEN abs(open_time) < 100000000000000 THEN close_time WHEN abs(open_time) < 100000000000000000 THEN close_time // 1000 ELSE close_time // 1000000 END"
#: Bars with identity under clean names.
SQL_BARS = f"""{SQL_KEYED},
bars AS (SELECT row_id, batch_id, received_at, sym AS symbol, ivl AS interval, inst AS open_time, ms, open, high, low, close, volume, {SQL_CLOSE} AS close_time, quote_volume, trade_count, taker_buy_base_volume, taker_buy_quote_volume, source_archive, archive_source, archive_period, strftime(make_timestamp_ms(inst) + INTERVAL 8 HOUR, '%Y-%m-%d') AS date, CAST(year(make_timestamp_ms(inst) + INTERVAL 8 HOUR) AS INTEGER) AS year, CAST(month(make_timestamp_ms(inst) + INTERVAL 8 HOUR) AS INTEGER) AS month, date AS given_date FROM keyed)"""


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def bars(spark: SparkSession, d: str) -> DataFrame:
    """klines under clean names: symbol, interval and open_time as identity has them, close_time in ms, calendar fields derived; rows without identity are left out."""
    df = with_identity(_t(spark, d, "klines")).where("_symbol is not null and _instant is not null and _ms is not null")
    df = df.withColumn("given_date", F.col("date")).withColumn("close_time", unit_factor(F.col("open_time"), F.col("close_time")))
    df = df.withColumns({"symbol": F.col("_symbol"), "interval": F.col("_interval"), "open_time": F.col("_instant"), "ms": F.col("_ms")})
    return with_calendar(df.drop("_symbol", "_interval", "_instant", "_archive", "_ms", "_slot", "record_key"))


# -- calendar, coverage, latest


@query(f"""WITH {SQL_BARS} SELECT row_id, strftime(make_timestamp_ms(open_time), '%Y-%m-%dT%H:%M:%S') || CASE WHEN open_time % 1000 <> 0 THEN '.' || lpad(CAST(open_time % 1000 AS VARCHAR), 3, '0') || '000' ELSE '' END AS utc, strftime(make_timestamp_ms(open_time) + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || CASE WHEN open_time % 1000 <> 0 THEN '.' || lpad(CAST(open_time % 1000 AS VARCHAR), 3, '0') || '000' ELSE '' END AS taipei, date, year, month FROM bars""")
def calendar_fields(spark, d):
    return with_calendar(bars(spark, d), text=True).select("row_id", F.col("open_time_utc").alias("utc"), F.col("open_time_taipei").alias("taipei"), "date", "year", "month")


@query(f"""WITH {SQL_BARS} SELECT symbol, interval, min(date) AS first_date, max(date) AS last_date, count(*) AS bars FROM bars GROUP BY ALL""")
def coverage_by_symbol(spark, d):
    ends = bars(spark, d).groupBy("symbol", "interval").agg(F.min("open_time").alias("a"), F.max("open_time").alias("b"), F.count(F.lit(1)).alias("bars"))
    day = lambda c: F.date_format(taipei_time(F.col(c)), "yyyy-MM-dd")
    return ends.select("symbol", "interval", day("a").alias("first_date"), day("b").alias("last_date"), "bars")  # numbers are aggregated, texts made after


@query(f"""WITH {SQL_BARS} SELECT row_id, symbol, open_time, interval FROM bars ORDER BY open_time DESC, row_id DESC LIMIT 20""")
def latest_bars(spark, d):
    """The latest 20 bars: a top-k without a full sort."""
    return bars(spark, d).select("row_id", "symbol", "open_time", "interval").orderBy(F.desc("open_time"), F.desc("row_id")).limit(20)


@query(f"""WITH {SQL_BARS} SELECT symbol, interval, max_by(row_id, row_id) AS row_id FROM bars GROUP BY ALL""")
def latest_cache(spark, d):
    """The last arrival of each series, valid or not."""
    return bars(spark, d).groupBy("symbol", "interval").agg(F.max("row_id").alias("row_id"))


# -- quality


@query(f"""WITH {SQL_BARS}, k AS (SELECT symbol, interval, open_time, count(*) AS n FROM bars GROUP BY ALL) SELECT interval, count(*) AS keys, count(*) FILTER (n > 1) AS duplicated FROM k GROUP BY ALL""")
def duplicate_keys(spark, d):
    return quality.duplicate_keys(bars(spark, d), ["symbol", "interval", "open_time"], ["interval"])


@query(f"""WITH {SQL_BARS}, n AS (SELECT symbol, interval AS ivl, date, count(*) AS rows FROM bars GROUP BY ALL) SELECT symbol, ivl AS interval, date, rows, CAST({CAPS} AS BIGINT) AS cap FROM n WHERE rows > {CAPS}""")
def rows_per_date(spark, d):
    return quality.over_cap(bars(spark, d))


_AUDITED = ["symbol", "open_time", "open", "close", "volume", "close_time", "trade_count", "schema_version", "dataset_version", "date"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS nulls FROM klines" for c in _AUDITED))
def null_audit(spark, d):
    return quality.null_counts(_t(spark, d, "klines"), _AUDITED)


_NUMBERS = ["open", "high", "low", "close", "volume", "quote_volume"]
SQL_VALID = "coalesce(high >= low AND high >= open AND high >= close AND low <= open AND low <= close AND volume >= 0 AND quote_volume >= 0 AND trade_count >= 0 AND " + " AND ".join(f"NOT isnan({c})" for c in _NUMBERS) + ", false)"
SQL_TIME = "coalesce(open_time % ms = 0 AND close_time = open_time + ms - 1, false)"


@query(f"""WITH {SQL_BARS} SELECT interval, count(*) AS rows, count(*) FILTER ({" OR ".join(f"{c} IS NULL" for c in quality.REQUIRED)}) AS null_rows, count(*) FILTER (NOT {SQL_VALID}) AS ohlc_bad, count(*) FILTER (given_date IS NOT NULL AND given_date <> date) AS date_bad, count(*) FILTER (open_time % ms <> 0) AS misaligned, count(*) FILTER (close_time <> open_time + ms - 1) AS close_bad, min(given_date) AS date_min, max(given_date) AS date_max FROM bars GROUP BY ALL""")
def quality_fused(spark, d):
    """Every count of the dataset validation from one scan."""
    return quality.fused_counts(bars(spark, d).withColumn("date", F.col("given_date")), ["interval"])


@query(f"""WITH {SQL_BARS} SELECT row_id, NOT {SQL_VALID} AS ohlc_bad, NOT {SQL_TIME} AS time_bad FROM bars WHERE NOT {SQL_VALID} OR NOT {SQL_TIME}""")
def quarantine(spark, d):
    return quality.with_quarantine(bars(spark, d)).where("quarantined").select("row_id", "ohlc_bad", "time_bad")


@query(f"""WITH {SQL_BARS} SELECT row_id, open_time % ms AS open_time_mod, open_time + ms - 1 AS expected_close_time FROM bars WHERE NOT {SQL_TIME}""")
def time_violations(spark, d):
    return quality.time_details(bars(spark, d)).select("row_id", "open_time_mod", "expected_close_time")


def _sql_nan(*xs):
    return "(" + " OR ".join(f"coalesce(isnan({x}), false)" for x in xs) + ")"


SQL_ERRORS = "concat_ws('; ', CASE WHEN open_time < 0 THEN 'open_time must be non-negative' END, CASE WHEN open_time % ms <> 0 THEN 'open_time is not aligned to interval' END, CASE WHEN close_time <> open_time + ms - 1 THEN 'close_time mismatch: expected ' || (open_time + ms - 1) || ', got ' || close_time END, " + f"CASE WHEN high < greatest(open, close, low) OR {_sql_nan('high', 'open', 'close', 'low')} THEN 'OHLC invalid: high is below open/close/low' END, CASE WHEN low > least(open, close, high) OR {_sql_nan('high', 'open', 'close', 'low')} THEN 'OHLC invalid: low is above open/close/high' END, " + ", ".join(f"CASE WHEN {c} < 0" + (f" OR {_sql_nan(c)}" if c != "trade_count" else "") + f" THEN '{c} must be non-negative' END" for c in ("volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")) + ", CASE WHEN close_time < open_time THEN 'closed Kline close_time must be >= open_time' END)"


@query(f"""WITH {SQL_BARS} SELECT * FROM (SELECT row_id, {SQL_ERRORS} AS errors FROM bars) WHERE errors <> ''""")
def live_errors(spark, d):
    return bars(spark, d).select("row_id", F.array_join(quality.live_errors(), "; ").alias("errors")).where("errors <> ''")


@query(f"""WITH {SQL_BARS}, b AS (SELECT symbol, row_id FROM bars WHERE NOT {SQL_VALID}) SELECT symbol, row_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY row_id) AS rn FROM b) WHERE rn <= 20""")
def violation_samples(spark, d):
    """A report's sample: the first 20 invalid bars of each symbol."""
    return quality.first_samples(bars(spark, d).where(~quality.bar_valid()).select("symbol", "row_id"), ["symbol"], ["row_id"], 20)


_PAIRS = ", ".join(f"('PQ-{a.upper()}-ROWS-GT-{b.upper()}', '{a}', '{b}', {r})" for a, b, r in quality.RATIOS)


@query(f"""WITH {SQL_BARS}, n AS (SELECT interval, count(*) AS rows FROM bars GROUP BY ALL), p(rule_id, fine, coarse, least) AS (VALUES {_PAIRS})
SELECT rule_id, f.rows AS fine_rows, c.rows AS coarse_rows, CASE WHEN f.rows IS NULL OR c.rows IS NULL THEN 'skipped' WHEN (fine = '4h' AND f.rows > c.rows) OR (fine <> '4h' AND f.rows >= least * c.rows) THEN 'passed' ELSE 'failed' END AS status FROM p LEFT JOIN n f ON f.interval = fine LEFT JOIN n c ON c.interval = coarse""")
def row_count_ratios(spark, d):
    return quality.ratio_checks(bars(spark, d).groupBy("interval").agg(F.count(F.lit(1)).alias("rows")))


@query(f"""WITH {SQL_BARS}, u AS (SELECT DISTINCT sym AS symbol FROM (SELECT regexp_replace(upper(symbol), '[\\s/-]', '', 'g') AS sym FROM universe_metadata))
SELECT interval, count(*) AS rows, count(DISTINCT symbol) AS symbols, min(date) AS date_min, max(date) AS date_max, min(year) AS year_min, max(year) AS year_max, CASE WHEN count(DISTINCT symbol) = (SELECT count(*) FROM u) AND bool_and(symbol IN (SELECT symbol FROM u)) THEN 'FULL_OUTPUT' ELSE 'SAMPLE_OUTPUT' END AS scope FROM bars GROUP BY ALL""")
def manifest_summary(spark, d):
    """Totals of a materialised dataset; its scope is full when its symbols are those of the universe."""
    from barloom.functions.identity import canonical_symbol

    per = bars(spark, d).groupBy("interval", "symbol").agg(F.count(F.lit(1)).alias("n"), F.min(F.to_date("date")).alias("a"), F.max(F.to_date("date")).alias("b"), F.min("year").alias("y"), F.max("year").alias("z"))
    known = _t(spark, d, "universe_metadata").select(canonical_symbol(F.col("symbol")).alias("symbol")).distinct().withColumn("hit", F.lit(1))
    total = known.count()
    g = per.join(known, "symbol", "left").groupBy("interval").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("symbols"), F.min("a").cast("string").alias("date_min"), F.max("b").cast("string").alias("date_max"), F.min("y").alias("year_min"), F.max("z").alias("year_max"), F.count("hit").alias("_hits"))
    full = (F.col("symbols") == total) & (F.col("_hits") == F.col("symbols"))
    return g.withColumn("scope", F.when(full, "FULL_OUTPUT").otherwise("SAMPLE_OUTPUT")).drop("_hits")


# -- conflicts and upserts

_SAME = " AND ".join(f"(r.{v} IS NOT DISTINCT FROM x.{v}" + (f" AND NOT coalesce(isnan(r.{v}), false)" if v not in ("close_time", "trade_count") else "") + ")" for v in VALUES)
SQL_FOLD = f"""{SQL_BARS},
a AS (SELECT *, CASE archive_source WHEN 'monthly' THEN 1 ELSE 2 END AS rank, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY CASE archive_source WHEN 'monthly' THEN 1 ELSE 2 END, coalesce(archive_period, ''), row_id) AS rn FROM bars WHERE archive_source IN ('monthly', 'daily')),
base AS (SELECT * FROM a WHERE rn = 1),
star AS (SELECT r.symbol, r.interval, r.open_time, min(r.rn) AS rn FROM a r JOIN base x USING (symbol, interval, open_time) WHERE x.rank = 1 AND r.rank = 2 AND NOT ({_SAME}) GROUP BY ALL),
cmp AS (SELECT r.symbol, r.interval, r.open_time, r.rn, s.rn AS srn, coalesce(r.rn = 1 OR r.rn = s.rn, false) AS head, ({_SAME}) AS same FROM a r LEFT JOIN star s USING (symbol, interval, open_time) JOIN a x ON x.symbol = r.symbol AND x.interval = r.interval AND x.open_time = r.open_time AND x.rn = CASE WHEN r.rn > coalesce(s.rn, 9223372036854775807) THEN s.rn ELSE 1 END)"""


@query(f"""WITH {SQL_FOLD}, n AS (SELECT symbol, interval, open_time, coalesce(max(srn), 1) AS w, count(*) FILTER (NOT head AND same) AS duplicates, CAST(count(DISTINCT srn) AS BIGINT) AS conflicts, count(*) FILTER (NOT head AND NOT same) AS inconsistent FROM cmp GROUP BY ALL)
SELECT n.symbol, n.interval, n.open_time, a.row_id, a.archive_source, duplicates, conflicts, inconsistent FROM n JOIN a ON a.symbol = n.symbol AND a.interval = n.interval AND a.open_time = n.open_time AND a.rn = n.w""")
def archive_conflicts(spark, d):
    rows = bars(spark, d).where("archive_source in ('monthly', 'daily')").select("symbol", "interval", "open_time", F.col("row_id").alias("order"), "archive_source", "archive_period", *VALUES)
    out = conflicts.resolve_archives(rows, ["symbol", "interval", "open_time"], VALUES)
    return out.select("symbol", "interval", "open_time", F.col("winner.order").alias("row_id"), "winner.archive_source", "duplicates", "conflicts", "inconsistent")


SQL_LIVE = "archive_source LIKE 'live%'"


@query(f"""WITH {SQL_BARS} SELECT symbol, interval, open_time, row_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY {SQL_LIVE} DESC, row_id DESC) AS rn FROM bars WHERE archive_source IS NOT NULL) WHERE rn = 1""")
def upsert_last_wins(spark, d):
    """Live bars put over archived ones: the last received of each key."""
    b = bars(spark, d).where("archive_source is not null").select("symbol", "interval", "open_time", "row_id", "archive_source")
    live = F.col("archive_source").startswith("live")
    return conflicts.upsert(b.where(~live), b.where(live), ["symbol", "interval", "open_time"], "row_id").select("symbol", "interval", "open_time", "row_id")


@query(f"""WITH {SQL_BARS}, k AS (SELECT symbol, year, month, interval, open_time, count(*) FILTER ({SQL_LIVE}) AS n, count(*) FILTER (NOT {SQL_LIVE}) AS e FROM bars WHERE archive_source IS NOT NULL GROUP BY ALL)
SELECT symbol, year, month, CAST(sum(n) AS BIGINT) AS input_rows, CAST(sum(e) AS BIGINT) AS existing_rows, count(*) AS output_rows, CAST(sum(CASE WHEN n > 0 THEN n - CASE WHEN e > 0 THEN 0 ELSE 1 END ELSE 0 END) AS BIGINT) AS replaced, min(open_time) AS min_open_time, max(open_time) AS max_open_time FROM k GROUP BY symbol, year, month HAVING sum(n) > 0""")
def upsert_counts(spark, d):
    b = bars(spark, d).where("archive_source is not null")
    live = F.col("archive_source").startswith("live")
    return conflicts.upsert_counts(b.where(~live), b.where(live), ["symbol", "interval", "open_time"], ["symbol", "year", "month"])


@query(f"""WITH {SQL_BARS} SELECT symbol, interval, open_time, row_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY source_archive DESC, row_id DESC) AS rn FROM bars) WHERE rn = 1""")
def merge_by_path(spark, d):
    """The rule of a layout migration: the last row by file path and position."""
    b = bars(spark, d).select("symbol", "interval", "open_time", "source_archive", "row_id")
    return conflicts.last_wins(b, ["symbol", "interval", "open_time"], ["source_archive", "row_id"]).select("symbol", "interval", "open_time", "row_id")


# -- continuity

SQL_GAPS = f"""{SQL_BARS}, o AS (SELECT DISTINCT symbol, interval, ms, open_time FROM bars),
l AS (SELECT *, lag(open_time) OVER (PARTITION BY symbol, interval ORDER BY open_time) AS prev FROM o),
gaps AS (SELECT symbol, interval, prev + ms AS "start", prev + ms * ((open_time - prev) // ms - 1) AS "end", (open_time - prev) // ms - 1 AS missing FROM l WHERE (open_time - prev) // ms > 1)"""


@query(f"""WITH {SQL_GAPS} SELECT symbol, interval, "start", "end", missing FROM gaps""")
def missing_ranges(spark, d):
    return continuity.gaps(bars(spark, d))


SQL_LATEST = f"((({NOW_MS} - 2000) // ms) * ms - ms)"
SQL_CONTINUITY = f"""{SQL_GAPS}, g AS (SELECT symbol, interval, CAST(sum(missing) AS BIGINT) AS missing FROM gaps GROUP BY ALL),
c AS (SELECT symbol, interval, ms, count(*) AS rows, min(open_time) AS min_open_time, max(open_time) AS max_open_time, count(*) - count(DISTINCT open_time) AS duplicates, count(*) FILTER (open_time % ms <> 0) AS misaligned, count(*) FILTER (close_time IS NULL OR close_time <> open_time + ms - 1) AS close_mismatches FROM bars GROUP BY ALL),
report AS (SELECT symbol, interval, rows, min_open_time, max_open_time, duplicates, misaligned, close_mismatches, coalesce(missing, 0) AS missing, {SQL_LATEST} AS latest_closed, greatest(0, ({SQL_LATEST} - max_open_time) // ms) AS lag_bars, CASE WHEN duplicates + misaligned + close_mismatches + coalesce(missing, 0) > 0 THEN 'gap_detected' ELSE 'ok' END AS status FROM c LEFT JOIN g USING (symbol, interval))"""


@query(f"""WITH {SQL_CONTINUITY} SELECT * FROM report""")
def continuity_report(spark, d):
    return continuity.continuity(bars(spark, d), NOW_MS)


@query(f"""WITH {SQL_CONTINUITY} SELECT interval, CASE WHEN bool_or(status = 'gap_detected') THEN 'gap_detected' ELSE 'ok' END AS overall_status, count(*) AS series FROM report GROUP BY ALL""")
def continuity_overall(spark, d):
    return continuity.overall(continuity.continuity(bars(spark, d), NOW_MS), ["interval"])


@query(f"""WITH {SQL_BARS}, w AS (SELECT DISTINCT symbol, interval, {SQL_KEYED and "CASE interval WHEN '1d' THEN 86400000 WHEN '4h' THEN 14400000 WHEN '1h' THEN 3600000 WHEN '15m' THEN 900000 WHEN '5m' THEN 300000 WHEN '3m' THEN 180000 WHEN '1m' THEN 60000 END"} AS ms FROM archive_catalog),
s AS (SELECT symbol, interval, max(open_time) AS s FROM bars WHERE archive_source = 'live_websocket' GROUP BY ALL), b AS (SELECT symbol, interval, max(open_time) AS b FROM bars GROUP BY ALL),
j AS (SELECT w.symbol, w.interval, CAST(ms AS BIGINT) AS ms, coalesce(s, b) AS last_closed, CASE WHEN s IS NOT NULL THEN 'state' WHEN b IS NOT NULL THEN 'current_dataset' ELSE 'bootstrap_required' END AS source FROM w LEFT JOIN s USING (symbol, interval) LEFT JOIN b USING (symbol, interval)),
m AS (SELECT *, {SQL_LATEST} AS latest_closed, greatest(0, coalesce(({SQL_LATEST} - last_closed) // ms, 0)) AS missing FROM j)
SELECT symbol, interval, source, last_closed, latest_closed, missing, CASE WHEN missing > 0 THEN last_closed + ms END AS "start", CASE WHEN missing > 0 THEN latest_closed END AS "end", CASE WHEN last_closed IS NULL THEN 'bootstrap_required' WHEN missing > 0 THEN 'missing' ELSE 'up_to_date' END AS status FROM m""")
def backfill_plan(spark, d):
    """What each listed series lacks up to now, from the state of the websocket bars or else from the dataset."""
    b = bars(spark, d)
    state = b.where("archive_source = 'live_websocket'").select("symbol", "interval", F.col("open_time").alias("last_closed_open_time"))
    return continuity.backfill_plan(_t(spark, d, "archive_catalog"), state, b, NOW_MS)


@query(f"""WITH {SQL_BARS}, w AS (SELECT DISTINCT symbol, interval, ms FROM bars), s AS (SELECT symbol, interval, max(epoch_ms(received_at)) AS last_message_ms FROM bars WHERE archive_source = 'live_websocket' GROUP BY ALL)
SELECT symbol, interval, last_message_ms, ms * 3 AS threshold_ms FROM w LEFT JOIN s USING (symbol, interval) WHERE last_message_ms IS NULL OR {NOW_MS} - last_message_ms > ms * 3""")
def stale_streams(spark, d):
    b = bars(spark, d)
    at = millis_of(F.col("received_at"))
    return continuity.stale_streams(b, b.where("archive_source = 'live_websocket'").select("symbol", "interval", at.alias("message_ms")), NOW_MS)


# -- archive catalog

SQL_CLASSIFIED = """cat AS (SELECT catalog_id, symbol, interval, archive_package_source, zip_name, checksum_name, covered_by_monthly AS given, download_decision AS given_decision, regexp_extract(zip_name, '-(\\d{4}-\\d{2}(-\\d{2})?)\\.zip$', 1) AS period FROM archive_catalog),
months AS (SELECT DISTINCT symbol, period[1:7] AS month FROM cat WHERE archive_package_source = 'monthly'),
classified AS (SELECT c.*, CASE WHEN archive_package_source <> 'monthly' THEN m.month IS NOT NULL END AS covered_by_monthly, CASE WHEN archive_package_source <> 'monthly' THEN CASE WHEN m.month IS NOT NULL THEN 'skipped_by_default' ELSE 'required_delta' END END AS daily_status, CASE WHEN archive_package_source <> 'monthly' AND m.month IS NOT NULL THEN 'skip' ELSE 'download' END AS download_decision FROM cat c LEFT JOIN months m ON m.symbol = c.symbol AND m.month = c.period[1:7])"""


def _classified(spark, d):
    cat = _t(spark, d, "archive_catalog").withColumn("given", F.col("covered_by_monthly")).withColumn("archive_period", C.period_of(F.col("zip_name"), F.col("symbol"), F.col("interval")))
    return C.classify(cat, ["symbol"])


@query(f"WITH {SQL_CLASSIFIED} SELECT catalog_id, covered_by_monthly, daily_status, download_decision FROM classified")
def covered_by_monthly(spark, d):
    """Daily archives in a month for which the symbol has a monthly one."""
    return _classified(spark, d).select("catalog_id", "covered_by_monthly", "daily_status", "download_decision")


SQL_ENDS = "CASE WHEN length(period) = 7 THEN strftime(last_day(CAST(period || '-01' AS DATE)), '%Y-%m-%d') ELSE period END"


@query(f"""WITH {SQL_CLASSIFIED} SELECT interval, count(*) AS files, count(*) FILTER (archive_package_source = 'monthly') AS monthly_files, count(*) FILTER (archive_package_source <> 'monthly') AS daily_files, count(DISTINCT CASE WHEN archive_package_source = 'monthly' THEN symbol END) AS monthly_symbols, count(DISTINCT CASE WHEN archive_package_source <> 'monthly' THEN symbol END) AS daily_symbols, count(*) FILTER (daily_status = 'required_delta') AS required_delta, count(*) FILTER (daily_status = 'skipped_by_default') AS skipped_by_default, count(*) FILTER (daily_status = 'included_by_explicit_full_daily_history') AS included_full_history, count(*) FILTER (download_decision = 'download') AS planned_downloads, min(CASE WHEN length(period) = 7 THEN period || '-01' ELSE period END) AS date_min, max({SQL_ENDS}) AS date_max FROM classified GROUP BY ALL""")
def discovery_summary(spark, d):
    return C.discovery_summary(_classified(spark, d), ["interval"])


SQL_FILES = f"""{SQL_CLASSIFIED}, files AS (SELECT *, CASE WHEN download_decision = 'skip' THEN 'skipped_daily_overlap' ELSE 'downloaded' END AS download_status, CASE WHEN checksum_name IS NULL THEN 'missing_checksum' WHEN given IS NULL THEN 'failed' WHEN download_decision = 'skip' THEN 'not_attempted' ELSE 'passed' END AS checksum_status, CAST(length(zip_name) AS BIGINT) AS file_size FROM classified)"""


def _files(spark, d):
    skip = F.col("download_decision") == "skip"
    return _classified(spark, d).withColumns({"download_status": F.when(skip, "skipped_daily_overlap").otherwise("downloaded"), "checksum_status": F.when(F.col("checksum_name").isNull(), "missing_checksum").when(F.col("given").isNull(), "failed").when(skip, "not_attempted").otherwise("passed"), "file_size": F.length("zip_name").cast("long")})


@query(f"""WITH {SQL_FILES} SELECT count(*) AS files, count(*) FILTER (download_status = 'downloaded') AS downloaded, count(*) FILTER (download_status = 'skipped_daily_overlap') AS skipped_overlap, count(*) FILTER (checksum_status = 'passed') AS verified, count(*) FILTER (checksum_status = 'failed') AS checksum_failed, count(*) FILTER (checksum_status = 'missing_checksum') AS missing, CAST(sum(file_size) AS BIGINT) AS total_bytes, list_aggregate(list_sort(list(DISTINCT archive_package_source)), 'string_agg', ',') AS sources, min(CASE WHEN length(period) = 7 THEN period || '-01' ELSE period END) AS date_min, max({SQL_ENDS}) AS date_max, count(*) FILTER (checksum_status IN ('failed', 'missing_checksum')) AS gaps FROM files""")
def process_summary(spark, d):
    out = C.process_summary(_files(spark, d))
    return out.select("files", "downloaded", "skipped_overlap", "verified", "checksum_failed", "missing", "total_bytes", F.array_join("sources", ",").alias("sources"), "date_min", "date_max", "gaps")


@query(f"WITH {SQL_FILES} SELECT catalog_id, checksum_status FROM files WHERE checksum_status IN ('failed', 'missing_checksum')")
def gap_files(spark, d):
    return C.gap_files(_files(spark, d)).select("catalog_id", "checksum_status")


@query(f"WITH {SQL_FILES} SELECT symbol, count(*) AS archives FROM files WHERE download_status = 'downloaded' AND checksum_status = 'passed' GROUP BY symbol")
def work_units(spark, d):
    """Verified archives by symbol, what a materialisation has to read."""
    return C.verified_archives(_files(spark, d)).groupBy("symbol").agg(F.count(F.lit(1)).alias("archives"))


@query(f"WITH {SQL_KEYED} SELECT DISTINCT arc AS zip_name FROM keyed WHERE arc LIKE '%.zip' AND arc NOT IN (SELECT lower(zip_name) FROM archive_catalog)")
def unlisted_archives(spark, d):
    """Archives that bars name and the catalog doesn't list."""
    named = with_identity(_t(spark, d, "klines")).where("_symbol is not null and _instant is not null and _ms is not null").select(F.col("_archive").alias("zip_name")).where("zip_name like '%.zip'")
    return C.missing_from(named, _t(spark, d, "archive_catalog").select(F.lower("zip_name").alias("zip_name")), ["zip_name"])


@query("SELECT doc_id, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def content_checksums(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


# -- layout

SQL_PATHS = f"""{SQL_BARS}, rows AS (SELECT symbol, open_time, date[1:7] AS m, 'symbol=' || symbol || '/year=' || year || CASE WHEN {SQL_LIVE} THEN '/month=' || lpad(CAST(month AS VARCHAR), 2, '0') ELSE '' END || '/part-000.parquet' AS path FROM bars WHERE archive_source IS NOT NULL),
lay AS (SELECT symbol, count(DISTINCT CASE WHEN path NOT LIKE '%/month=%' THEN path END) AS year_only_files, count(DISTINCT CASE WHEN path LIKE '%/month=%' THEN path END) AS year_month_files FROM rows GROUP BY ALL),
checks AS (SELECT r.symbol, year_only_files, year_month_files, count(*) AS row_count, count(*) - count(DISTINCT open_time) AS duplicates, count(DISTINCT m) AS partitions, min(open_time) AS min_open_time, max(open_time) AS max_open_time, CASE WHEN year_only_files > 0 AND year_month_files > 0 THEN 'mixed_layout_needs_migration' WHEN year_only_files > 0 THEN 'year_only_needs_migration' ELSE 'no_migration_needed' END AS status FROM rows r JOIN lay USING (symbol) GROUP BY ALL)"""


def _paths(spark, d):
    b = bars(spark, d).where("archive_source is not null")
    month = F.when(F.col("archive_source").startswith("live"), F.concat(F.lit("/month="), F.lpad(F.col("month").cast("string"), 2, "0"))).otherwise("")
    return b.select("symbol", "open_time", F.concat(F.lit("symbol="), "symbol", F.lit("/year="), F.col("year").cast("string"), month, F.lit("/part-000.parquet")).alias("path"))


@query(f"WITH {SQL_PATHS} SELECT symbol, year_only_files, year_month_files, year_only_files > 0 AND year_month_files > 0 AS mixed FROM lay")
def layout_audit(spark, d):
    return layout.audit(_paths(spark, d).select("symbol", "path").distinct())


@query(f"WITH {SQL_PATHS} SELECT symbol, year_only_files, year_month_files, row_count, duplicates, partitions, min_open_time, max_open_time, status FROM checks")
def layout_precheck(spark, d):
    return layout.precheck(_paths(spark, d))


_REASON = "CASE WHEN symbol = 'NOVUSDV' THEN 'default_excluded_symbol' WHEN status = 'mixed_layout_needs_migration' THEN 'mixed_layout' WHEN regexp_matches(symbol, '_[0-9]{6}$') THEN 'delivery_contract' WHEN contains(symbol, 'SETTLED') THEN 'settled' WHEN regexp_matches(symbol, '[^\\x00-\\x7F]') THEN 'non_ascii' WHEN NOT split_part(symbol, '_', 1) LIKE '%USDV' THEN 'quote_asset_mismatch' END"


def _candidates(spark, d):
    return layout.with_reason(layout.candidates(layout.precheck(_paths(spark, d)), include_mixed=True), ["NOVUSDV"], [], ["USDV", "USDK"], ["USDV"])


@query(f"WITH {SQL_PATHS} SELECT symbol, row_count, duplicates, partitions, {_REASON} AS reason FROM checks WHERE status <> 'no_migration_needed'")
def migration_candidates(spark, d):
    return _candidates(spark, d).select("symbol", "row_count", "duplicates", "partitions", "reason")


@query(f"WITH {SQL_PATHS}, c AS (SELECT *, {_REASON} AS reason FROM checks WHERE status <> 'no_migration_needed'), r AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN duplicates > 0 THEN 1 ELSE 0 END, row_count, partitions, symbol) AS n FROM c WHERE reason IS NULL) SELECT (n - 1) // 5 + 1 AS batch_no, count(*) AS symbols, CAST(sum(row_count) AS BIGINT) AS total_rows, CAST(sum(partitions) AS BIGINT) AS total_partitions, max(row_count) AS most_rows, max(partitions) AS most_partitions FROM r WHERE n <= 20 GROUP BY ALL")
def migration_batches(spark, d):
    """The first four batches of five symbols of a migration."""
    return layout.batch_totals(layout.batches(_candidates(spark, d), 5, 4))


@query(r"SELECT DISTINCT symbol, CASE WHEN split_part(symbol, '_', 1) LIKE '%USDV' THEN 'USDV' WHEN split_part(symbol, '_', 1) LIKE '%USDK' THEN 'USDK' END AS quote, regexp_matches(symbol, '_[0-9]{6}$') AS delivery, NOT regexp_matches(symbol, '[^\x00-\x7F]') AS ascii FROM archive_catalog")
def symbol_kinds(spark, d):
    s = F.col("symbol")
    return _t(spark, d, "archive_catalog").select("symbol").distinct().select("symbol", layout.quote_asset(s, ["USDV", "USDK"]).alias("quote"), layout.is_delivery(s).alias("delivery"), layout.is_ascii(s).alias("ascii"))


# -- instruments

SQL_HELD = """held AS (SELECT meta_row_id, instrument_id, upper(trim(symbol)) AS symbol, exchange, base_asset, quote_asset, market_type, contract_type, lower(trim(status)) AS status, listed_at, nullif(trim(delisted_at), '') AS delisted_at, nullif(trim(successor_id), '') AS successor_id, tick_size, step_size, contract_size, epoch_ms(CAST(listed_at AS TIMESTAMPTZ)) AS a, epoch_ms(CAST(nullif(trim(delisted_at), '') AS TIMESTAMPTZ)) AS b, epoch_ms(CAST(ingestion_time AS TIMESTAMPTZ)) AS t FROM universe_metadata)"""
SQL_LAST = f"{SQL_HELD}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY t DESC, meta_row_id DESC) AS rn FROM held) WHERE rn = 1)"


def _records(spark, d):
    m = _t(spark, d, "universe_metadata")
    clean = {"symbol": F.upper(F.trim("symbol")), "status": F.lower(F.trim("status")), "delisted_at": F.nullif(F.trim("delisted_at"), F.lit("")), "successor_id": F.nullif(F.trim("successor_id"), F.lit(""))}
    return m.withColumns(clean).withColumn("t", instruments.iso_millis(F.col("ingestion_time")))


def _last(spark, d):
    return conflicts.last_wins(_records(spark, d), ["instrument_id"], ["t", "meta_row_id"])


def _positive_sql(c):
    return f"coalesce(TRY_CAST(trim({c}) AS DECIMAL(38,18)) > 0, false)"


_RULES = [
    *[("UM-Q1", f"{f} IS NULL OR {f} = ''", f, "missing") for f in instruments.REQUIRED],
    ("UM-Q3", "coalesce(status NOT IN ('active', 'delisted', 'renamed', 'merged'), true)", "status", "unknown status"),
    ("UM-Q3", "(status IS NOT DISTINCT FROM 'active') <> (delisted_at IS NULL)", "delisted_at", "delisted_at must be null for active records only"),
    ("UM-Q3", "coalesce(status IN ('renamed', 'merged'), false) <> (successor_id IS NOT NULL)", "successor_id", "successor_id belongs to renamed and merged records only"),
    ("UM-Q4", "b < a", "delisted_at", "delisted_at before listed_at"),
    ("UM-Q4", "a > t", "listed_at", "listed_at after ingestion_time"),
    ("UM-Q4", "b > t", "delisted_at", "delisted_at after ingestion_time"),
    ("UM-Q5", "coalesce(market_type NOT IN ('spot', 'futures', 'perpetual', 'option'), true)", "market_type", "unknown market_type"),
    ("UM-Q5", "market_type = 'spot' AND contract_type IS NOT NULL", "contract_type", "spot has no contract_type"),
    *[("UM-Q5", f"market_type = '{k}' AND coalesce(contract_type NOT IN ({', '.join(repr(x) for x in v)}), true)", "contract_type", f"{k} needs one of {', '.join(v)}") for k, v in instruments.CONTRACTS.items()],
    ("UM-Q5", "market_type = 'spot' AND contract_size IS NOT NULL", "contract_size", "spot has no contract_size"),
    ("UM-Q5", f"market_type IN ('futures', 'perpetual', 'option') AND NOT {_positive_sql('contract_size')}", "contract_size", "must be > 0"),
    *[("UM-Q5", f"{f} IS NOT NULL AND NOT {_positive_sql(f)}", f, "must be > 0") for f in ("tick_size", "step_size")],
]


@query(f"WITH {SQL_HELD} " + " UNION ALL ".join(f"SELECT meta_row_id AS id, '{r}' AS rule_id, '{f}' AS field, '{why}' AS reason FROM held WHERE {cond}" for r, cond, f, why in _RULES))
def instrument_rules(spark, d):
    return instruments.record_rules(_records(spark, d), "meta_row_id", F.col("t"))


@query(f"""WITH {SQL_HELD} SELECT 'instrument_id' AS kind, meta_row_id AS record, f AS first_record FROM (SELECT *, min(meta_row_id) OVER (PARTITION BY instrument_id) AS f FROM held) WHERE meta_row_id > f
UNION ALL SELECT 'symbol_era', meta_row_id, f FROM (SELECT *, min(meta_row_id) OVER (PARTITION BY exchange, symbol, listed_at) AS f FROM held) WHERE meta_row_id > f
UNION ALL SELECT 'active_symbol', meta_row_id, f FROM (SELECT *, min(meta_row_id) OVER (PARTITION BY exchange, symbol) AS f FROM held WHERE status = 'active') WHERE meta_row_id > f""")
def instrument_uniqueness(spark, d):
    return instruments.uniqueness(_records(spark, d), "meta_row_id")


@query(f"""WITH {SQL_HELD} SELECT exchange, symbol, meta_row_id AS record FROM (SELECT *, max(coalesce(b, 9223372036854775807)) OVER (PARTITION BY exchange, symbol ORDER BY a, meta_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM held WHERE a IS NOT NULL) WHERE until > a""")
def era_overlaps(spark, d):
    return instruments.era_overlaps(_records(spark, d), "meta_row_id")


@query(f"WITH {SQL_LAST} SELECT instrument_id FROM last WHERE a <= {AT_MS} AND (b IS NULL OR b > {AT_MS})")
def universe_at_time(spark, d):
    return instruments.universe_at(_last(spark, d), AT_MS).select("instrument_id")


@query(f"""WITH {SQL_LAST} SELECT DISTINCT instrument_id, successor_id, CASE WHEN successor_id = instrument_id THEN 'self-reference' ELSE 'missing successor' END AS reason FROM last WHERE successor_id = instrument_id OR (successor_id IS NOT NULL AND successor_id NOT IN (SELECT instrument_id FROM last))""")
def missing_successors(spark, d):
    return instruments.missing_successors(_last(spark, d))


@query(f"""WITH {SQL_LAST} SELECT o.instrument_id FROM last o LEFT JOIN last n ON n.instrument_id = o.successor_id WHERE o.status = 'renamed' AND (n.instrument_id IS NULL OR n.a IS DISTINCT FROM o.b)""")
def rename_breaks(spark, d):
    return instruments.rename_breaks(_last(spark, d))


@query(f"""WITH RECURSIVE {SQL_LAST}, chain AS (SELECT instrument_id, instrument_id AS here, successor_id AS nxt, CAST(0 AS BIGINT) AS steps FROM last WHERE successor_id IN (SELECT instrument_id FROM last) UNION ALL SELECT c.instrument_id, l.instrument_id, l.successor_id, c.steps + 1 FROM chain c JOIN last l ON l.instrument_id = c.nxt WHERE c.steps < 100)
SELECT instrument_id, here AS last_id, steps, false AS cycle FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY steps DESC) AS rn FROM chain) WHERE rn = 1""")
def successor_ends(spark, d):
    return instruments.successor_ends(_last(spark, d))


@query(f"""WITH {SQL_LAST}, base AS (SELECT instrument_id AS given_id, exchange || '.' || market_type || '.' || regexp_replace(regexp_replace(lower(symbol), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS id, symbol, listed_at FROM last),
o AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY listed_at, given_id) AS k FROM base)
SELECT given_id, CASE WHEN n = 1 THEN id ELSE id || '.h' || substr(sha256('{{"base_id":"' || id || '","listed_at":"' || listed_at || '","ordinal":' || k || ',"symbol":"' || symbol || '"}}'), 1, 8) END AS instrument_id FROM o""")
def collision_suffixes(spark, d):
    """Readable ids by market and symbol alone, made unique."""
    rows = _last(spark, d).select(F.col("instrument_id").alias("given_id"), F.concat("exchange", F.lit("."), "market_type", F.lit("."), instruments.safe_name(F.col("symbol"))).alias("instrument_id"), "symbol", "listed_at")
    return instruments.collision_suffixes(rows, ["listed_at", "given_id"]).select("given_id", "instrument_id")


# -- ticks and bars from ticks


def _ticks_query(interval: str):
    ms = INTERVALS[interval][0]

    def run(spark, d):
        e = _t(spark, d, "events").select(F.col("event_type").alias("symbol"), millis_of(F.col("ts")).alias("time_ms"), F.col("event_id").alias("seq"), F.col("value").alias("price"), F.col("value").cast("decimal(18,4)").alias("size"))
        out = resample.bars_from_ticks(e, interval)
        return out.withColumn("volume", F.col("volume").cast("double"))

    run.__name__ = f"bars_{interval}"
    query(f"""SELECT event_type AS symbol, '{interval}' AS interval, (epoch_ms(ts) // {ms}) * {ms} AS open_time, arg_min(value, (epoch_ms(ts), event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (epoch_ms(ts), event_id)) AS close, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS volume, count(*) AS trade_count, (epoch_ms(ts) // {ms}) * {ms} + {ms - 1} AS close_time FROM events GROUP BY ALL""")(run)


for _interval in ("1d", "4h", "1h", "15m"):
    _ticks_query(_interval)


@query(f"""WITH {SQL_BARS}, s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY row_id DESC) AS rn FROM bars WHERE interval = '1h') WHERE rn = 1)
SELECT symbol, '1d' AS interval, (open_time // 86400000) * 86400000 AS open_time, arg_min(row_id, open_time) AS first_row, max(high) AS high, min(low) AS low, arg_max(row_id, open_time) AS last_row, CAST(sum(trade_count) AS BIGINT) AS trade_count, count(*) AS parts FROM s GROUP BY ALL""")
def hours_to_days(spark, d):
    """Daily bars from the last delivered hourly ones; open and close stand for the rows they come from."""
    one = conflicts.last_wins(bars(spark, d).where("interval = '1h'").select("symbol", "interval", "open_time", "row_id", "high", "low", "volume", "trade_count"), ["symbol", "interval", "open_time"], ["row_id"])
    out = resample.coarser(one.withColumn("open", F.col("row_id")).withColumn("close", F.col("row_id")), "1d")
    return out.select("symbol", "interval", "open_time", F.col("open").alias("first_row"), "high", "low", F.col("close").alias("last_row"), "trade_count", "parts")


def as_messages(b: DataFrame) -> DataFrame:
    """Bars as kline messages, numbers as texts where a stream has them so."""
    k = {"t": "open_time", "T": "close_time", "s": "symbol", "i": "interval", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "q": "quote_volume", "V": "taker_buy_base_volume", "Q": "taker_buy_quote_volume"}
    pairs = [F.concat(F.lit(f'"{key}":'), F.col(c).cast("string") if c in ("open_time", "close_time") else F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))) for key, c in k.items()]
    inner = F.concat(F.lit("{"), F.concat_ws(",", *pairs, F.concat(F.lit('"n":'), F.col("trade_count").cast("string")), F.lit('"x":true')), F.lit("}"))
    return b.withColumn("payload", F.concat(F.lit('{"e":"kline","E":0,"s":"'), F.col("symbol"), F.lit('","k":'), inner, F.lit("}")))


@query(f"""WITH {SQL_BARS} SELECT row_id, symbol, interval, open_time, high, close_time, quote_volume, trade_count, taker_buy_quote_volume, true AS is_closed, 'raw' AS payload_format FROM bars WHERE {SQL_LIVE} AND {" AND ".join(f"{c} IS NOT NULL" for c in ["open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"])}""")
def tick_messages(spark, d):
    """Live bars written as stream messages and read back."""
    m = as_messages(bars(spark, d).where("archive_source like 'live%'")).select("row_id", "payload")
    out = ticks.parse_messages(m, "websocket", F.lit(NOW_MS))
    return out.where("error is null").select("row_id", "symbol", "interval", "open_time", "high", "close_time", "quote_volume", "trade_count", "taker_buy_quote_volume", "is_closed", "payload_format")


@query(f"""WITH {SQL_BARS}, ok AS (SELECT *, {SQL_ERRORS} AS errors FROM bars WHERE {SQL_LIVE} AND (open + high + low + close + volume + close_time + quote_volume + trade_count + taker_buy_base_volume + taker_buy_quote_volume) IS NOT NULL)
SELECT symbol, interval, open_time, close_time, high, quote_volume, trade_count FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY row_id DESC) AS rn FROM ok WHERE errors = '') WHERE rn = 1""")
def stream_merge(spark, d):
    """Live bars as messages through a stream into the current datasets: the last received valid bar of each key."""
    root = work_dir(spark, "stream")
    live = as_messages(bars(spark, d).where("archive_source like 'live%'"))
    live.select("payload", millis_of(F.col("received_at")).alias("received_ms"), F.col("row_id").alias("arrival")).where("payload is not null").write.json(f"{root}/in")
    router = Router(spark, f"{root}/out", "websocket")
    router.run(spark.readStream.schema("payload string, received_ms long, arrival long").json(f"{root}/in")).awaitTermination()
    out = [read_bars(spark, f"{root}/out/current/{i}") for i in INTERVALS]
    return reduce(lambda a, b: a.unionByName(b), out).select("symbol", "interval", "open_time", "close_time", "high", "quote_volume", "trade_count")
