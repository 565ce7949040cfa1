"""The queries of the general problems over the project's tables, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.identity import NOISE, SQL_KEYED, SQL_MS, canonical_archive, canonical_symbol, unit_factor, with_identity
from barloom.operators import gridfill
from barloom.operators.asknown import as_known, iso_millis
from barloom.operators.history import history
from barloom.operators.spikes import implausible
from barloom.operators.redelivery import MessageTable
from barloom.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- 1


def klines_table(spark: SparkSession, root: str) -> MessageTable:
    """An exactly-once table for deliveries of klines, with partitions by month of arrival."""
    ids = {
        "symbol": F.coalesce(canonical_symbol(F.col("symbol")), canonical_symbol(F.col("record_key.symbol"))),
        "interval": F.col("interval"),
        "instant": unit_factor(F.col("open_time"), F.col("open_time")),
        "archive": canonical_archive(F.col("source_archive"), F.col("archive_source")),
    }
    month = F.expr("greatest(0, least(9999, _mt_instant div 2592000000))")  # thirty days, whatever the session's zone
    return MessageTable(spark, root, ids, ["symbol", "interval", "instant"], "row_id", F.date_format("received_at", "yyyyMM"), bucket=month)


def _two_loads(spark: SparkSession, sf_dir: str) -> MessageTable:
    """All of klines through the table: the first four fifths of the batches as history, the rest as messages that come in later."""
    bars = table(spark, sf_dir, "klines")
    top = bars.agg(F.max("batch_id")).first()[0]
    t = klines_table(spark, work_dir(spark, "messages"))
    old = F.coalesce(F.col("batch_id"), F.lit(0)) <= (top or 0) * 4 // 5
    t.merge(bars.where(old))
    t.merge(bars.where(~old))
    t.vacuum()
    return t


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are further copies of a message, as the table took them out."""
    return _two_loads(spark, sf_dir).removed().select("row_id")


def p1_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one copy of each message that the table keeps."""
    kept = _two_loads(spark, sf_dir).read()
    kept = table(spark, sf_dir, "klines").limit(0) if kept is None else kept
    return kept.select("row_id", "batch_id", "symbol", "interval", "open_time")


P1_FOUND_SQL = f"""WITH {SQL_KEYED} SELECT row_id FROM (SELECT row_id, min(row_id) OVER (PARTITION BY sym, ivl, inst, arc) AS first_id FROM keyed) WHERE row_id > first_id"""
P1_KEPT_SQL = f"""WITH {SQL_KEYED}, found AS ({P1_FOUND_SQL[P1_FOUND_SQL.rindex("SELECT row_id FROM"):]}) SELECT row_id, batch_id, symbol, interval, open_time FROM klines WHERE row_id NOT IN (SELECT row_id FROM found)"""

# -- 2


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = with_identity(table(spark, sf_dir, "klines").select("row_id", "record_key", "symbol", "interval", "open_time", "source_archive", "archive_source", "close"))
    readings = bars.where("_instant is not null").select(F.col("_symbol").alias("s"), F.col("_interval").alias("g"), F.col("_slot").alias("slot"), F.col("row_id").alias("order"), F.col("close").alias("value"))
    slots = gridfill.promised_slots(table(spark, sf_dir, "archive_catalog")).select(F.col("symbol").alias("s"), F.col("interval").alias("g"), "slot")
    return gridfill.regular_grid(readings, slots)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promised slots without any reading."""
    return _grid(spark, sf_dir).where(F.col("status") != gridfill.OBSERVED).select(F.col("s").alias("symbol"), F.col("g").alias("interval"), F.col("slot").alias("open_time"))


def p2_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole regular series of closes, observed, filled and marked."""
    return _grid(spark, sf_dir).select(F.col("s").alias("symbol"), F.col("g").alias("interval"), F.col("slot").alias("open_time"), F.col("value").alias("close"), "status", "n_readings")


def p2_heldout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimates scored: a tenth of the slots with a close is hidden from the grid, and what it says there is held against the truth. By status of the hidden cells: their number and the median error of the logarithm of close, of the estimate and of two plain ones, the series' mean and its median, on the same cells. A status that no hidden cell has gives no row."""
    bars = with_identity(table(spark, sf_dir, "klines").select("record_key", "symbol", "interval", "open_time", "source_archive", "archive_source", "row_id", "close")).where("_instant is not null and close > 0 and not isnan(close)")
    readings = bars.select(F.col("_symbol").alias("s"), F.col("_interval").alias("g"), F.col("_slot").alias("slot"), F.col("row_id").alias("order"), F.col("close").alias("value")).where("s is not null and g is not null and slot is not null")
    hidden = F.pmod(F.xxhash64("s", "g", "slot"), F.lit(10)) == 0
    truth = readings.where(hidden).groupBy("s", "g", "slot").agg(F.log(F.max_by("value", "order")).alias("truth"))
    grid = gridfill.regular_grid(readings.where(~hidden), truth.select("s", "g", "slot"))
    plain = readings.where(~hidden).groupBy("s", "g").agg(F.avg(F.log("value")).alias("mean"), F.percentile_approx(F.log("value"), 0.5, 10_000).alias("median"))
    both = grid.join(truth, ["s", "g", "slot"]).join(plain, ["s", "g"], "left")
    mid = lambda x, n: F.percentile_approx(F.abs(x - F.col("truth")), 0.5, 10_000).alias(n)
    return both.groupBy("status").agg(F.count(F.lit(1)).alias("cells"), mid(F.log("value"), "error"), mid(F.col("mean"), "error_of_mean"), mid(F.col("median"), "error_of_median"))


P2_FOUND_SQL = rf"""WITH {SQL_KEYED},
listed AS (SELECT DISTINCT symbol, interval, coalesce(nullif(regexp_extract(zip_name, '-(\d{{4}}-\d{{2}}(-\d{{2}})?)\.zip$', 1), ''), archive_period) AS period FROM archive_catalog),
spans AS (SELECT symbol, interval, CAST({SQL_MS} AS BIGINT) AS ms, CASE WHEN length(period) = 7 THEN CAST(period || '-01' AS DATE) ELSE CAST(period AS DATE) END AS first, CASE WHEN length(period) = 7 THEN CAST(CAST(period || '-01' AS DATE) + INTERVAL 1 MONTH AS DATE) ELSE CAST(CAST(period AS DATE) + INTERVAL 1 DAY AS DATE) END AS past FROM listed),
slots AS (SELECT DISTINCT symbol, interval, unnest(range(CAST(epoch_ms(CAST(first AS TIMESTAMP)) AS BIGINT), CAST(epoch_ms(CAST(past AS TIMESTAMP)) AS BIGINT), ms)) AS open_time FROM spans)
SELECT symbol, interval, open_time FROM slots s WHERE NOT EXISTS (SELECT 1 FROM keyed k WHERE k.sym = s.symbol AND k.ivl = s.interval AND k.slot = s.open_time)"""

# -- 4


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = with_identity(table(spark, sf_dir, "klines").select("row_id", "record_key", "symbol", "interval", "open_time", "source_archive", "archive_source", "open", "high", "low", "close_time", "trade_count"))
    readings = bars.where("_instant is not null").select(
        F.col("row_id").alias("id"), F.col("_symbol").alias("s"), F.col("_interval").alias("g"), F.col("_ms").alias("ms"), F.col("_slot").alias("slot"), F.col("_instant").alias("instant"),
        "open", "high", "low", unit_factor(F.col("open_time"), F.col("close_time")).alias("close_time"), "trade_count",
    )
    return implausible(readings)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a spike beyond the series' cutoff that also stands the exact check, a frozen bar, an impossible price or a wrong time."""
    return _flags(spark, sf_dir).where("(spike and extreme) or stuck or impossible or mistimed").select(F.col("id").alias("row_id"))


def p4_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows that any rule flags, with the rules."""
    return _flags(spark, sf_dir).where("spike or stuck or impossible or mistimed").select(F.col("id").alias("row_id"), "x", "cut", "spike", "extreme", "stuck", "impossible", "mistimed")


P4_FOUND_SQL = f"""WITH {SQL_KEYED},
p AS (SELECT row_id, sym, ivl, ms, inst, slot, CASE WHEN NOT isnan(open) THEN open END AS o, CASE WHEN NOT isnan(high) THEN high END AS h, CASE WHEN NOT isnan(low) THEN low END AS l, trade_count AS tc, CASE WHEN abs(open_time) < 100000000000 THEN close_time * 1000 WHEN abs(open_time) < 100000000000000 THEN close_time WHEN abs(open_time) < 100000000000000000 THEN close_time // 1000 ELSE close_time // 1000000 END AS ct FROM keyed),
slots AS (SELECT sym, ivl, slot, min(least(o, h, l)) AS lo, max(greatest(o, h, l)) AS hi FROM p WHERE coalesce(o, h, l) IS NOT NULL GROUP BY ALL),
nb AS (SELECT *, row_number() OVER w AS r, lag(lo) OVER w AS plo, lag(hi) OVER w AS phi, lead(lo) OVER w AS nlo, lead(hi) OVER w AS nhi FROM slots WINDOW w AS (PARTITION BY sym, ivl ORDER BY slot)),
med AS (SELECT sym, ivl, median(h - l) AS m FROM p WHERE tc > 0 AND h IS NOT NULL AND l IS NOT NULL GROUP BY ALL),
far AS (SELECT row_id FROM (SELECT row_id, sym, ivl, slot, unnest([o, h, l]) AS v FROM p) JOIN nb USING (sym, ivl, slot) JOIN med USING (sym, ivl) WHERE v IS NOT NULL AND plo IS NOT NULL AND nlo IS NOT NULL AND least(greatest(plo - v, v - phi, 0), greatest(nlo - v, v - nhi, 0)) > 8 * m),
bars AS (SELECT DISTINCT sym, ivl, r, o, h, l FROM p JOIN nb USING (sym, ivl, slot) WHERE tc > 0 AND o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL),
isles AS (SELECT *, r - row_number() OVER (PARTITION BY sym, ivl, o, h, l ORDER BY r) AS isle FROM bars),
runs AS (SELECT sym, ivl, r, o, h, l FROM (SELECT *, count(*) OVER (PARTITION BY sym, ivl, o, h, l, isle) AS n FROM isles) WHERE n >= 6),
stuck AS (SELECT row_id FROM p JOIN nb USING (sym, ivl, slot) JOIN runs USING (sym, ivl, r, o, h, l) WHERE tc > 0)
SELECT DISTINCT row_id FROM (SELECT row_id FROM far UNION ALL SELECT row_id FROM stuck UNION ALL SELECT row_id FROM p WHERE o <= 0 OR h <= 0 OR l <= 0 OR h < l OR o < l OR o > h OR ct <= inst OR abs(ct - inst + 1 - ms) > ms / 2)"""

# -- 5


def listing_versions(meta: DataFrame) -> DataFrame:
    """(entity, valid_from, valid_to, state) of the listing periods in universe_metadata: of each instrument its last ingestion, the larger meta_row_id where two tie. state has instrument_id, status, listed_at, delisted_at as spelled there, and whether the period is the symbol's latest."""
    held = meta.where("instrument_id is not null").groupBy("instrument_id").agg(F.max(F.struct(iso_millis(F.col("ingestion_time")).alias("at"), "meta_row_id", "symbol", "status", "listed_at", "delisted_at")).alias("m"))
    v = held.select(canonical_symbol(F.col("m.symbol")).alias("entity"), iso_millis(F.col("m.listed_at")).alias("valid_from"), iso_millis(F.col("m.delisted_at")).alias("valid_to"), "instrument_id", F.lower(F.trim("m.status")).alias("status"), "m.listed_at", "m.delisted_at")
    latest = v.groupBy("entity").agg(F.max(F.struct("valid_from", "instrument_id")).alias("l")).select(F.col("entity").alias("_e"), F.col("l.instrument_id").alias("_latest"))
    v = v.join(latest, F.col("entity") == F.col("_e"), "left")
    return v.select("entity", "valid_from", "valid_to", F.struct("instrument_id", "status", "listed_at", "delisted_at", (F.col("instrument_id") == F.col("_latest")).alias("is_latest")).alias("state"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = with_identity(table(spark, sf_dir, "klines").select("row_id", "record_key", "symbol", "interval", "open_time", "source_archive", "archive_source"), slots=False)
    events = bars.where("_symbol is not null and _instant is not null").select("row_id", F.col("_symbol").alias("entity"), F.col("_instant").alias("time"))
    return as_known(events, listing_versions(table(spark, sf_dir, "universe_metadata")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in a listing period that is not the symbol's latest, or in none."""
    return _listed(spark, sf_dir).where("state is null or not state.is_latest").select("row_id", F.coalesce("state.instrument_id", F.lit("none")).alias("instrument_id"))


def p5_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with identity and the instrument that was valid at its time."""
    return _listed(spark, sf_dir).select("row_id", "state.instrument_id", "state.status", "state.listed_at", "state.delisted_at")


SQL_PERIODS = f"""held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY CAST(ingestion_time AS TIMESTAMPTZ) DESC, meta_row_id DESC) AS rn FROM universe_metadata WHERE instrument_id IS NOT NULL) WHERE rn = 1),
periods AS (SELECT *, row_number() OVER (PARTITION BY psym ORDER BY valid_from DESC, instrument_id DESC) = 1 AS is_latest FROM (SELECT instrument_id, nullif(regexp_replace(upper(symbol), '{NOISE}', '', 'g'), '') AS psym, lower(trim(status)) AS status, listed_at, delisted_at, epoch_ms(CAST(listed_at AS TIMESTAMPTZ)) AS valid_from, epoch_ms(CAST(nullif(trim(delisted_at), '') AS TIMESTAMPTZ)) AS valid_to FROM held)),
joined AS (SELECT k.row_id, p.instrument_id, p.status, p.listed_at, p.delisted_at, p.is_latest FROM keyed k LEFT JOIN periods p ON p.psym = k.sym AND k.inst >= p.valid_from AND (p.valid_to IS NULL OR k.inst < p.valid_to))"""
P5_FOUND_SQL = f"""WITH {SQL_KEYED}, {SQL_PERIODS} SELECT row_id, coalesce(instrument_id, 'none') AS instrument_id FROM joined WHERE instrument_id IS NULL OR NOT is_latest"""
P5_JOINED_SQL = f"""WITH {SQL_KEYED}, {SQL_PERIODS} SELECT row_id, instrument_id, status, listed_at, delisted_at FROM joined"""

# -- 6


def _size(c: str) -> Column:
    """A size as a decimal, whatever its notation; null if it is none."""
    return F.trim(c).try_cast("decimal(38,18)")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda c: F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))
    snaps = table(spark, sf_dir, "universe_snapshots").select(
        F.col("instrument_id").alias("entity"), F.col("server_time").alias("time"), "received_at", "snap_row_id",
        word("status").alias("status"), _size("tick_size").alias("tick_size"), _size("step_size").alias("step_size"),
        F.coalesce(word("successor_id"), F.lit("")).alias("successor_id"),
    )
    return history(snaps, ["status", "tick_size", "step_size", "successor_id"], ["received_at", "snap_row_id"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot of each version of an instrument."""
    return _versions(spark, sf_dir).select(F.col("entity").alias("instrument_id"), F.col("valid_from").alias("server_time"))


def p6_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version with the period in which it held; sizes as plain decimals."""
    return _versions(spark, sf_dir).withColumnRenamed("entity", "instrument_id").withColumn("successor_id", F.nullif("successor_id", F.lit("")))


SQL_VERSIONS = """held AS (SELECT * FROM (SELECT instrument_id, server_time, nullif(lower(trim(status)), '') AS status, TRY_CAST(trim(tick_size) AS DECIMAL(38,18)) AS tick, TRY_CAST(trim(step_size) AS DECIMAL(38,18)) AS step, coalesce(lower(trim(successor_id)), '') AS succ, row_number() OVER (PARTITION BY instrument_id, server_time ORDER BY received_at DESC, snap_row_id DESC) AS rn FROM universe_snapshots) WHERE rn = 1),
known AS (SELECT instrument_id, server_time, last_value(status IGNORE NULLS) OVER w AS status, last_value(tick IGNORE NULLS) OVER w AS tick, last_value(step IGNORE NULLS) OVER w AS step, succ FROM held WINDOW w AS (PARTITION BY instrument_id ORDER BY server_time ROWS UNBOUNDED PRECEDING)),
flagged AS (SELECT *, lag(server_time) OVER w IS NULL OR status <> lag(status) OVER w OR tick <> lag(tick) OVER w OR step <> lag(step) OVER w OR succ <> lag(succ) OVER w AS starts FROM known WINDOW w AS (PARTITION BY instrument_id ORDER BY server_time))"""
P6_FOUND_SQL = f"""WITH {SQL_VERSIONS} SELECT instrument_id, server_time FROM flagged WHERE starts"""
P6_HISTORY_SQL = f"""WITH {SQL_VERSIONS}, n AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY instrument_id ORDER BY server_time) AS v FROM flagged),
p AS (SELECT instrument_id, v, min(server_time) AS valid_from, max_by(status, server_time) AS status, CAST(max_by(tick, server_time) AS VARCHAR) AS tick_size, CAST(max_by(step, server_time) AS VARCHAR) AS step_size, nullif(max_by(succ, server_time), '') AS successor_id FROM n GROUP BY ALL)
SELECT instrument_id, valid_from, lead(valid_from) OVER (PARTITION BY instrument_id ORDER BY valid_from) AS valid_to, status, tick_size, step_size, successor_id FROM p"""

QUERIES = {"p1_found": p1_found, "p1_kept": p1_kept, "p2_found": p2_found, "p2_grid": p2_grid, "p2_heldout": p2_heldout, "p4_found": p4_found, "p4_flags": p4_flags, "p5_found": p5_found, "p5_joined": p5_joined, "p6_found": p6_found, "p6_history": p6_history}
SQL = {"p1_found": P1_FOUND_SQL, "p1_kept": P1_KEPT_SQL, "p2_found": P2_FOUND_SQL, "p4_found": P4_FOUND_SQL, "p5_found": P5_FOUND_SQL, "p5_joined": P5_JOINED_SQL, "p6_found": P6_FOUND_SQL, "p6_history": P6_HISTORY_SQL}
