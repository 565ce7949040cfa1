"""Queries of the sources and sinks: the project's tables go through files, archives, datasets and streams of this engine and come back, with their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import millis_of
from barloom.operators import instruments
from barloom.operators.conflicts import last_wins
from barloom.plans.bars import NOW_MS, SQL_BARS, SQL_ERRORS, SQL_LIVE, SQL_TIME, SQL_VALID, _t, as_messages, bars
from barloom.schema import BAR, CSV
from barloom.session import ship, stored, work_dir
from barloom.sources import archives, lake, snapshots
from barloom.sources.materialize import materialize, read_manifest
from barloom.storage import arrow_place
from barloom.streaming import ticks
from barloom.streaming.router import Router, rebuild

QUERIES: dict = {}
SQL: dict = {}
#: Bars from here on (2024-01-01 00:00 UTC) and before its end (2025-01-01) in the query of a range.
FROM_MS, TO_MS = 1_704_067_200_000, 1_735_689_600_000


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# -- archives: zips with their checksums, written a symbol, interval and month each

_COMPLETE = f"({' + '.join(CSV)}) IS NOT NULL"


def zips(spark: SparkSession, bars_: DataFrame, folder: str) -> DataFrame:
    """One zip with a CSV for each symbol, interval, year and month of bars_, in order of row_id, beside it its checksum: (symbol, interval, year, month, path, checksum_path). Rows come sorted, so a task holds one archive at a time, and that compressed. The checksums of every fifth month are wrong, to be found."""
    cols = ["symbol", "interval", "year", "month"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import io
        import zipfile

        def put(path: str, content: bytes) -> None:
            system, place = arrow_place(path)
            with system.open_output_stream(place) as f:
                f.write(content)

        def close(key: tuple, held) -> pd.DataFrame:
            raw, z, member = held
            member.close()
            z.close()
            name = f"{folder}/{'-'.join(map(str, key))}.zip"
            put(name, raw.getvalue())
            digest = hashlib.sha256(raw.getvalue()).hexdigest()
            put(f"{name}.CHECKSUM", f"{digest if key[3] % 5 else '00'}  {name.rpartition('/')[2]}\n".encode())
            return pd.DataFrame([(*key, name, f"{name}.CHECKSUM")], columns=[*cols, "path", "checksum_path"])

        key, held = None, None
        for b in batches:
            for k, part in b.groupby(cols, sort=False):
                if k != key:
                    if held is not None:
                        yield close(key, held)
                    raw = io.BytesIO()
                    z = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                    key, held = k, (raw, z, z.open("bars.csv", "w"))
                held[2].write(("\n".join(part["line"]) + "\n").encode())
        if held is not None:
            yield close(key, held)

    ship(spark)
    system, place = arrow_place(folder)
    system.create_dir(place, recursive=True)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CSV], F.lit("0"))
    rows = bars_.select(*cols, "row_id", line.alias("line")).repartition(*cols).sortWithinPartitions(*cols, "row_id")
    return stored(rows.mapInPandas(run, "symbol string, interval string, year int, month int, path string, checksum_path string"), "zips")


def _specs(z: DataFrame) -> DataFrame:
    return z.select("symbol", "interval", F.lit("monthly").alias("archive_source"), F.format_string("%04d-%02d", "year", "month").alias("archive_period"), "path")


@query(f"""WITH {SQL_BARS} SELECT symbol, interval, CASE WHEN {_COMPLETE} THEN open_time END AS open_time, CASE WHEN {_COMPLETE} THEN close_time END AS close_time, CASE WHEN {_COMPLETE} THEN trade_count END AS trade_count, {_COMPLETE} AS readable, count(*) AS lines FROM bars GROUP BY ALL""")
def zip_lines(spark, d):
    """All bars as zipped CSV files and back; a bar that lacks a value comes back as an error."""
    z = zips(spark, bars(spark, d), work_dir(spark, "zips"))
    back = archives.parse_lines(archives.read_zip_lines(spark, _specs(z)), keep_errors=True)
    ok = F.col("error").isNull()
    return back.groupBy("symbol", "interval", *[F.when(ok, F.col(c)).alias(c) for c in ("open_time", "close_time", "trade_count")], ok.alias("readable")).agg(F.count(F.lit(1)).alias("lines"))


@query(f"""WITH {SQL_BARS} SELECT DISTINCT symbol, interval, year, month, CASE WHEN month % 5 = 0 THEN 'failed' ELSE 'passed' END AS checksum_status FROM bars""")
def zip_checksums(spark, d):
    """The archives of all bars, verified against their checksum files."""
    z = zips(spark, bars(spark, d), work_dir(spark, "zips"))
    return archives.verify_files(spark, z.withColumnsRenamed({"path": "local_zip_path", "checksum_path": "local_checksum_path"})).select("symbol", "interval", "year", "month", "checksum_status")


_SQL_FIRST = f"{SQL_BARS}, one AS (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY row_id) AS rn FROM bars WHERE {_COMPLETE}), good AS (SELECT * FROM one WHERE rn = 1 AND {SQL_VALID} AND {SQL_TIME})"


@query(f"""WITH {_SQL_FIRST} SELECT symbol, open_time, year, month, close_time, trade_count FROM good WHERE interval = '1h'""")
def materialized_bars(spark, d):
    """Archives of hourly bars to the seed dataset, half of the symbols in a second run that goes on with the first, and read from there."""
    whole = bars(spark, d).where("interval = '1h'").where(_COMPLETE)
    units, root = _specs(zips(spark, whole, work_dir(spark, "zips"))), work_dir(spark, "seed")
    half = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 0
    materialize(spark, units.where(half), root, "1h")
    materialize(spark, units, root, "1h", resume=True)
    return lake.read_bars(spark, root, current=False).select("symbol", "open_time", "year", "month", "close_time", "trade_count")


@query(f"""WITH {_SQL_FIRST} SELECT '1h' AS interval, count(*) AS row_count, count(DISTINCT symbol) AS symbols, count(DISTINCT (symbol, year)) AS files, min(date) AS date_min, max(date) AS date_max FROM good WHERE interval = '1h'""")
def materialized_manifest(spark, d):
    """What the manifest says of that dataset after both runs."""
    whole = bars(spark, d).where("interval = '1h'").where(_COMPLETE)
    units, root = _specs(zips(spark, whole, work_dir(spark, "zips"))), work_dir(spark, "seed")
    half = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 0
    materialize(spark, units.where(half), root, "1h")
    materialize(spark, units, root, "1h", resume=True)
    m = read_manifest(spark, root)
    # A symbol without a valid bar has a report, but nothing in the dataset.
    written = lake.read_bars(spark, root, current=False).select("symbol").distinct().count()
    return spark.createDataFrame([(m["interval"], m["row_count"], written, m["files"], m["date_min"], m["date_max"])], "interval string, row_count long, symbols long, files long, date_min string, date_max string")


# -- the datasets


def _single(spark: SparkSession, d: str) -> DataFrame:
    """The last delivered bar of each key."""
    cols = [*BAR.fieldNames(), "row_id"]
    return last_wins(bars(spark, d).select(*cols), ["symbol", "interval", "open_time"], ["row_id"])


_SQL_SINGLE = f"{SQL_BARS}, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, interval, open_time ORDER BY row_id DESC) AS rn FROM bars) WHERE rn = 1), good AS (SELECT * FROM one WHERE {SQL_VALID} AND {SQL_TIME})"


def _seed(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    root = work_dir(spark, "seed")
    return root, lake.write_seed(_single(spark, d), root)


@query(f"""WITH {_SQL_SINGLE} SELECT symbol, interval, open_time, year, month, date, close FROM good WHERE open_time >= {FROM_MS} AND open_time < {TO_MS}""")
def seed_range(spark, d):
    """The seed dataset written and a year of it read: only that year's folders (two, in the calendar of UTC+8) are opened."""
    root, _ = _seed(spark, d)
    return lake.read_bars(spark, root, None, FROM_MS, TO_MS, current=False).select("symbol", "interval", "open_time", "year", "month", "date", "close")


@query(f"""WITH {_SQL_SINGLE} SELECT symbol, interval, open_time, ohlc_bad, time_bad FROM (SELECT *, NOT {SQL_VALID} AS ohlc_bad, NOT {SQL_TIME} AS time_bad FROM one) WHERE ohlc_bad OR time_bad""")
def seed_quarantine(spark, d):
    """The bars that writing the seed sets aside."""
    return _seed(spark, d)[1].select("symbol", "interval", "open_time", "ohlc_bad", "time_bad")


@query(f"""WITH {_SQL_SINGLE} SELECT symbol, count(DISTINCT year) AS folders, count(*) AS bars, true AS readable FROM good GROUP BY symbol""")
def seed_files(spark, d):
    """The seed's files by symbol, from their footers alone."""
    root, _ = _seed(spark, d)
    year = F.regexp_extract("path", r"year=(\d+)", 1)
    return lake.probe_files(spark, root).groupBy("symbol").agg(F.count_distinct(year).alias("folders"), F.sum("num_rows").alias("bars"), F.every("readable").alias("readable"))


@query(f"""WITH {_SQL_SINGLE} SELECT symbol, interval, open_time, year, month, close, 1 AS schema_version, 'current-v1' AS dataset_version FROM good""")
def current_from_seed(spark, d):
    """The current dataset made once from the seed; asked again, nothing happens."""
    root, _ = _seed(spark, d)
    current = work_dir(spark, "current")
    for _ in range(2):
        lake.ensure_current(spark, root, current)
    return lake.read_bars(spark, current).select("symbol", "interval", "open_time", "year", F.col("month").cast("int").alias("month"), "close", "schema_version", "dataset_version")


_SQL_HOURS = f"{SQL_BARS}, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY row_id DESC) AS rn FROM bars WHERE interval = '1h') WHERE rn = 1)"


@query(f"""WITH {_SQL_HOURS} SELECT symbol, open_time, year, month, close, close_time FROM h""")
def current_upserts(spark, d):
    """Hourly bars put over the current dataset in two upserts; of each key the last delivered stays."""
    root = work_dir(spark, "current")
    b = bars(spark, d).where("interval = '1h'")
    late = F.coalesce(F.pmod("row_id", F.lit(3)) == 0, F.lit(False))  # what comes in the second upsert is decided by the newest of a key
    top = last_wins(b.select(*BAR.fieldNames(), "row_id"), ["symbol", "open_time"], ["row_id"])
    rest = b.join(top.select("row_id"), "row_id", "left_anti")
    lake.upsert_current(spark, root, rest.unionByName(top.where(~late), allowMissingColumns=True), "row_id")
    lake.upsert_current(spark, root, top.where(late), "row_id")
    return lake.read_bars(spark, root).select("symbol", "open_time", "year", F.col("month").cast("int").alias("month"), "close", "close_time")


# -- listings and manifests

_CATALOG = "catalog_id long, symbol string, interval string, archive_package_source string, archive_period string, zip_name string, source_path string, source_checksum_path string"


@query("SELECT catalog_id, symbol, interval, archive_package_source, archive_period, zip_name, coalesce(source_checksum_path, source_path || '.CHECKSUM') AS source_checksum_path FROM archive_catalog")
def catalog_lines(spark, d):
    """The catalog as JSON lines and back."""
    folder = work_dir(spark, "lines")
    _t(spark, d, "archive_catalog").select(*[c.split()[0] for c in _CATALOG.split(", ")]).write.json(folder)
    return archives.read_jsonl(spark, folder, _CATALOG).drop("source_path")


@query("SELECT DISTINCT symbol FROM archive_catalog")
def listed_symbols(spark, d):
    """The symbols of the listings' folders, monthly and daily ones together."""
    c = _t(spark, d, "archive_catalog")
    keys = lambda kind: c.where(F.col("archive_package_source") == kind).select(F.concat(F.lit(f"data/{kind}/"), "symbol", F.lit("/")).alias("key"))
    return archives.archive_symbols(keys("monthly"), keys("daily"))


_SQL_SNAPSHOT = "snap AS (SELECT DISTINCT upper(symbol) AS symbol, upper(quote_asset) AS quote FROM universe_metadata WHERE symbol IS NOT NULL AND quote_asset IS NOT NULL AND lower(trim(status)) = 'active')"


@query(f"WITH {_SQL_SNAPSHOT} SELECT symbol FROM snap WHERE quote = 'USDV'")
def snapshot_symbols(spark, d):
    """The instruments as an exchange's raw snapshot, kept by content and loaded, and the symbols in it that trade in one asset. A snapshot is one small document."""
    m = _t(spark, d, "universe_metadata").where("symbol is not null and quote_asset is not null and lower(trim(status)) = 'active'")
    rows = m.select(F.upper("symbol").alias("s"), F.upper("quote_asset").alias("q")).distinct().orderBy("s", "q").collect()
    response = {"symbols": [{"symbol": r.s, "contractType": "PERPETUAL", "status": "TRADING", "quoteAsset": r.q} for r in rows]}
    root = work_dir(spark, "snapshots")
    names = {snapshots.store(spark, root, response, f"2026-01-0{i}T00:00:00Z") for i in (1, 2)}  # the same content is stored once
    return instruments.tradable_symbols(snapshots.load(spark, root, names.pop()), "USDV")


# -- streams

_SQL_MESSAGES = f"{SQL_BARS}, ok AS (SELECT *, {SQL_ERRORS} AS errors FROM bars WHERE {SQL_LIVE} AND {_COMPLETE})"
_SQL_UNREAD = "CASE " + " ".join(f"WHEN {c} IS NULL THEN 'cannot read {c}'" for c in CSV) + f" ELSE {SQL_ERRORS} END"


@query(f"""WITH {_SQL_MESSAGES}, f(payload_format) AS (VALUES ('raw'), ('combined'), ('normalized')) SELECT row_id, payload_format, symbol, interval, open_time, close_time, high, trade_count, true AS is_closed FROM ok CROSS JOIN f""")
def tick_formats(spark, d):
    """Live bars as messages of all three formats, and read as one webhook takes them."""
    b = as_messages(bars(spark, d).where("archive_source like 'live%'").where(_COMPLETE))
    flat = F.to_json(F.struct("symbol", "interval", *[F.when(F.isnan(c), F.lit("NaN")).otherwise(F.col(c).cast("string")).alias(c) if dict(b.dtypes)[c] == "double" else F.col(c) for c in CSV], F.lit("yes").alias("is_closed")))
    shapes = F.array(F.col("payload"), F.concat(F.lit('{"stream":"x","data":'), "payload", F.lit("}")), flat)
    m = b.select("row_id", F.explode(shapes).alias("payload"))
    out = ticks.parse_messages(m, "webhook", F.lit(NOW_MS))
    return out.where("error is null").select("row_id", "payload_format", "symbol", "interval", "open_time", "close_time", "high", "trade_count", "is_closed")


def _streamed(spark: SparkSession, d: str) -> tuple[str, Router]:
    root = work_dir(spark, "stream")
    live = as_messages(bars(spark, d).where("archive_source like 'live%'"))
    live.select("payload", millis_of(F.col("received_at")).alias("received_ms"), F.col("row_id").alias("arrival")).where("payload is not null").write.json(f"{root}/in")
    router = Router(spark, f"{root}/out", "websocket")
    router.run(spark.readStream.schema("payload string, received_ms long, arrival long").json(f"{root}/in")).awaitTermination()
    return f"{root}/out", router


@query(f"""WITH {_SQL_MESSAGES} SELECT symbol, interval, max(open_time) AS last_closed_open_time, count(*) AS merged_bars FROM ok WHERE errors = '' GROUP BY ALL""")
def stream_state(spark, d):
    """What the stream's state says after its run: the last closed bar of each series and how many were merged."""
    state = _streamed(spark, d)[1].state()
    return state.select("symbol", "interval", "last_closed_open_time", "merged_bars")


@query(f"""WITH {SQL_BARS}, live AS (SELECT symbol, interval, open_time, {_SQL_UNREAD} AS errors FROM bars WHERE {SQL_LIVE}) SELECT symbol, interval, open_time, errors, count(*) AS messages FROM live WHERE errors <> '' GROUP BY ALL""")
def stream_rejects(spark, d):
    """The messages that the stream refused, with the reasons."""
    root, _ = _streamed(spark, d)
    log = spark.read.schema("errors array<string>, record struct<symbol: string, interval: string, open_time: long>").json(f"{root}/rejects/batch=*")
    return log.groupBy("record.symbol", "record.interval", "record.open_time", F.array_join("errors", "; ").alias("errors")).agg(F.count(F.lit(1)).alias("messages"))


@query(f"""WITH {_SQL_MESSAGES} SELECT symbol, open_time, close_time, high FROM (SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY row_id DESC) AS rn FROM ok WHERE errors = '' AND interval = '1h') WHERE rn = 1""")
def stream_rebuilt(spark, d):
    """The current dataset of hourly bars made anew from the stream's log of closed bars."""
    root, _ = _streamed(spark, d)
    target = work_dir(spark, "again")
    rebuild(spark, root, "1h", target)
    return lake.read_bars(spark, target).select("symbol", "open_time", "close_time", "high")
