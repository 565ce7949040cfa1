"""The partitioned bar datasets: the seed (symbol, year) and the current one (symbol, year, month), their reads, upserts and migration."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.calendar import month_partitions, with_calendar
from barloom.operators.conflicts import last_wins, upsert, upsert_counts
from barloom.operators.quality import with_quarantine
from barloom.schema import BAR, CURRENT, DATASET_VERSION, KEY, SCHEMA_VERSION, SEED
from barloom.session import ship
from barloom.sources.archives import spread
from barloom.storage import Files, arrow_place

BAR_COLUMNS = BAR.fieldNames()
#: Name of an upsert's journal, before its number.
JOURNAL = "__upsert_"


class LayoutError(ValueError):
    """A dataset or a request that doesn't fit."""


def _schema(text_times: bool, month_in_path: bool) -> T.StructType:
    kinds = {f.name: f.dataType for f in BAR.fields} | {"date": T.StringType(), "month": T.IntegerType(), "schema_version": T.IntegerType(), "dataset_version": T.StringType()}
    kinds |= {c: T.StringType() if text_times else T.TimestampNTZType() for c in ("open_time_utc", "open_time_taipei")}
    names = (CURRENT if text_times else SEED) + ["symbol", "year"]
    return T.StructType([T.StructField(n, kinds.get(n, T.IntegerType())) for n in names if n != "month"] + [T.StructField("month", T.IntegerType())])


def read_bars(spark: SparkSession, root: str, symbols: list[str] | None = None, start_ms: int | None = None, end_ms: int | None = None, current: bool = True) -> DataFrame:
    """Bars of a dataset, of the given symbols and with open_time in [start_ms, end_ms). The times also become conditions on year and month, which the optimizer couldn't derive from open_time, so other partitions aren't opened. A dataset that isn't there has no rows; folders beside symbol=* are ignored."""
    schema = _schema(current, current)
    there = [n for n in Files(spark, root).names() if n.startswith("symbol=")]
    if symbols is not None:  # other symbols' folders aren't even listed
        there = sorted({f"symbol={s.upper()}" for s in symbols} & set(there))
    if not there:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", root).parquet(*([f"{root}/symbol=*"] if symbols is None else [f"{root}/{n}" for n in there]))
    if start_ms is not None:
        df = df.where(F.col("open_time") >= start_ms)
    if end_ms is not None:
        df = df.where(F.col("open_time") < end_ms)
    if start_ms is not None and end_ms is not None:
        months = month_partitions(start_ms, end_ms)
        cond = reduce(lambda a, b: a | b, [(F.col("year") == y) & (F.col("month") == m) for y, m in months], F.lit(False)) if current else F.col("year").isin(sorted({y for y, _ in months}))
        df = df.where(cond)
    return df


def write_seed(bars: DataFrame, root: str) -> DataFrame:
    """Writes the valid bars as symbol=/year=, sorted by open_time, over the same partitions only; returns the quarantined ones. bars: schema.BAR, single per key. A partition is one file unless it is larger than the advisory size, when the rebalance splits it over tasks, so a symbol with a third of all bars isn't one task's work."""
    marked = with_quarantine(with_calendar(bars.select(*BAR_COLUMNS)))
    good = marked.where(~F.col("quarantined")).select(*SEED, "symbol", "year")
    good.hint("rebalance", "symbol", "year").sortWithinPartitions("symbol", "year", "open_time").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "year").parquet(root)
    return marked.where("quarantined")


def _current_rows(bars: DataFrame) -> DataFrame:
    """Bars in the columns of the current dataset, calendar fields and versions filled in, month padded for its path."""
    df = with_calendar(bars, text=True)
    for c, v in (("schema_version", F.lit(SCHEMA_VERSION)), ("dataset_version", F.lit(DATASET_VERSION))):
        blank = F.lit(0) if c == "schema_version" else F.lit("")
        df = df.withColumn(c, F.coalesce(F.nullif(F.col(c), blank), v) if c in bars.columns else v)
    return df.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")).withColumn("symbol", F.upper("symbol"))


def _write_current(rows: DataFrame, root: str, mode: str = "dynamic") -> None:
    cols = [c for c in CURRENT if c != "month"]
    out = rows.select(*cols, "symbol", "year", "month").hint("rebalance", "symbol", "year", "month").sortWithinPartitions("symbol", "year", "month", "open_time")
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("symbol", "year", "month").parquet(root)


def upsert_current(spark: SparkSession, root: str, incoming: DataFrame, arrival: str = "arrival") -> list[dict]:
    """Puts bars (schema.BAR and an arrival number) over the current dataset: of each key the last received one stays. Only the partitions that the bars belong to are read and rewritten. Returns the counts of each.

    The new partitions are written aside; then a journal that names them makes the upsert count, and they are put in place by renames. A crash before the journal changes nothing; after it, the next writer, or recover(), finishes the renames. One writer at a time: a dataset is fed by one stream."""
    rows = _current_rows(incoming).withColumn("_arrival", F.col(arrival).cast("long"))
    where = [(r[0], r[1], r[2]) for r in rows.select("symbol", "year", "month").distinct().collect()]
    files = Files(spark, root)
    recover(spark, root)
    listed = {(s, y): set(files.names(f"symbol={s}", f"year={y}")) for s, y in {(s, y) for s, y, _ in where}}
    there = [f"{root}/symbol={s}/year={y}/month={m}" for s, y, m in where if f"month={m}" in listed[s, y]]
    cols = [c for c in CURRENT if c != "month"] + ["symbol", "year", "month", "_arrival"]
    if there:
        old = spark.read.schema(_schema(True, True)).option("basePath", root).parquet(*there).withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")).withColumn("_arrival", F.col("open_time"))
    else:
        old = rows.limit(0)
    old, rows = old.select(*cols), rows.select(*cols)
    counts = [r.asDict() for r in upsert_counts(old, rows, KEY, ["symbol", "year", "month"]).collect()]
    own = uuid.uuid4().hex[:12]
    _write_current(upsert(old, rows, KEY, "_arrival"), f"{root}/__stage_upsert_{own}", "static")
    files.write_new(json.dumps([f"symbol={s}/year={y}/month={m}" for s, y, m in where]), f"{JOURNAL}{own}.json")
    _put_in_place(files, own)
    return counts


def _put_in_place(files: Files, own: str) -> None:
    """The renames of an upsert whose journal is written; may be run again after a crash at any point."""
    stage, old = f"__stage_upsert_{own}", f"__backup_upsert_{own}"
    for part in json.loads(files.read_text(f"{JOURNAL}{own}.json")):
        if files.exists(stage, part):
            if files.exists(part) and not files.rename([part], [old, part]):
                raise LayoutError(f"cannot set {part} aside")
            if not files.rename([stage, part], [part]):
                raise LayoutError(f"cannot put {part} in place")
    files.delete(f"{JOURNAL}{own}.json")
    files.delete(stage)
    files.delete(old)


def recover(spark: SparkSession, root: str) -> int:
    """Finishes the upserts that a crash left between their journal and its end; how many."""
    files = Files(spark, root)
    open_ = [n[len(JOURNAL) : -5] for n in files.names() if n.startswith(JOURNAL) and n.endswith(".json")]
    for own in open_:
        _put_in_place(files, own)
    return len(open_)


def ensure_current(spark: SparkSession, seed: str, current: str, symbols: list[str] | None = None) -> str:
    """Makes the current dataset from the seed once: 'already_initialized', 'initialized', or 'bootstrap_required' when there is no seed. With symbols, only those that are missing are added."""
    have = {n.partition("=")[2] for n in Files(spark, current).names() if n.startswith("symbol=")}
    if symbols is None and have:
        return "already_initialized"
    if symbols is not None and set(s.upper() for s in symbols) <= have:
        return "already_initialized"
    bars = read_bars(spark, seed, symbols, current=False)
    if have:
        bars = bars.where(~F.col("symbol").isin(sorted(have)))
    if bars.limit(1).count() == 0:
        return "bootstrap_required"
    _write_current(_current_rows(bars.select(*BAR_COLUMNS)), current)
    return "initialized"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, symbol, length) of every Parquet file of a dataset in any layout; contents aren't read."""
    from barloom.operators.layout import symbol_of

    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
    return df.select("path", symbol_of(F.col("path")).alias("symbol"), "length")


def probe_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, symbol, length, head, tail, readable, num_rows, error) of every Parquet file, from its first and last bytes and its footer; data pages aren't read."""
    import pandas as pd

    ship(spark)
    files = spread(list_files(spark, root), "path")

    def run(batches):
        import pyarrow.parquet as pq

        for b in batches:
            rows = []
            for path, symbol, length in b.itertuples(index=False):
                head = tail = error = n = None
                try:
                    system, place = arrow_place(path)
                    with system.open_input_file(place) as f:
                        head = f.read(4)
                        if length >= 4:
                            f.seek(length - 4)
                            tail = f.read(4)
                        f.seek(0)
                        n = pq.ParquetFile(f).metadata.num_rows
                except Exception as e:  # noqa: BLE001 - the reason is the result
                    error = f"{type(e).__name__}: {e}"[:500]
                show = lambda x: None if x is None else (x.decode() if x.isascii() and x.decode().isprintable() else x.hex())
                rows.append((path, symbol, length, show(head), show(tail), error is None, n, error))
            yield pd.DataFrame(rows, columns=["path", "symbol", "length", "head", "tail", "readable", "num_rows", "error"]).astype({"num_rows": "Int64"})

    return files.mapInPandas(run, "path string, symbol string, length long, head string, tail string, readable boolean, num_rows long, error string")


def migrate_symbol(spark: SparkSession, root: str, symbol: str, execute: bool = False) -> dict:
    """Brings one symbol of the current dataset to year and month partitions: read in any layout, last row by file path and position wins, stage, verify, then swap by renames with the old directory kept as a backup; a failed swap is undone. Without execute only the plan is returned. A corrupt file stops it before anything is written."""
    from barloom.operators.layout import NONE, precheck

    files = Files(spark, root)
    name = f"symbol={symbol.upper()}"
    if not files.exists(name):
        return {"status": "source_missing", "symbol": symbol}
    bad = probe_files(spark, f"{root}/{name}").where("not readable").select("path", "error").collect()
    if bad:
        return {"status": "source_parquet_unreadable", "symbol": symbol, "files": [r.asDict() for r in bad]}
    cols = ["open_time", *[c for c in BAR_COLUMNS if c not in ("open_time", "symbol")]]
    raw = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{name}")
    rows = raw.select(*cols, F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at")).withColumn("symbol", F.lit(symbol.upper()))
    check = precheck(rows.select("symbol", "path", "open_time")).first().asDict()
    plan = {"symbol": symbol.upper(), "row_count": check["row_count"], "duplicates": check["duplicates"], "partitions": check["partitions"], "source_status": check["status"]}
    if check["status"] == NONE or not execute:
        return plan | {"status": "planned" if check["status"] != NONE else NONE}
    stamp = uuid.uuid4().hex[:8]
    stage, backup = f"__stage_migrate_{stamp}", f"__backup_migrate_{stamp}"
    single = last_wins(rows, ["open_time"], ["path", "at"])
    _write_current(_current_rows(single.select(*BAR_COLUMNS)), f"{root}/{stage}", "static")
    staged = read_bars(spark, f"{root}/{stage}")
    got = staged.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("open_time").alias("k"), F.min("open_time").alias("a"), F.max("open_time").alias("b"), F.count_distinct("year", "month").alias("p")).first()
    want = (check["row_count"] - check["duplicates"], check["row_count"] - check["duplicates"], check["min_open_time"], check["max_open_time"], check["partitions"])
    if tuple(got) != want:
        files.delete(stage)
        return plan | {"status": "verification_failed", "found": tuple(got), "wanted": want}
    if not files.rename([name], [backup, name]):
        return plan | {"status": "promotion_failed"}
    if not files.rename([stage, name], [name]):
        files.rename([backup, name], [name])
        return plan | {"status": "restored"}
    files.delete(stage)
    return plan | {"status": "migrated", "backup": backup}
