"""Verified archives to the seed dataset, for all symbols in one job, with a manifest a run and resumption by symbol."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import with_calendar
from barloom.intervals import bars_per_day
from barloom.operators.conflicts import resolve_archives
from barloom.operators.quality import over_cap, with_quarantine
from barloom.schema import BAR, VALUES
from barloom.session import stored
from barloom.sources.archives import parse_lines, read_zip_lines
from barloom.sources.lake import write_seed
from barloom.storage import Files

SIDECAR = "symbol string, row_count long, files long, date_min string, date_max string, year_min int, year_max int, duplicates long, conflicts long, inconsistent long, over_cap_days long, ohlc_bad long, time_bad long, quarantined long"


class StrictError(RuntimeError):
    """Data that a strict run doesn't accept."""


def done_symbols(spark: SparkSession, root: str) -> DataFrame:
    """The reports of all finished symbols, the latest of each."""
    runs = [n for n in Files(spark, root).names("manifests", "symbols") if n.startswith("run=")]
    if not runs:
        return spark.createDataFrame([], SIDECAR + ", run string")
    df = spark.read.schema(SIDECAR + ", run string").option("basePath", f"{root}/manifests/symbols").json(*[f"{root}/manifests/symbols"])
    return df.groupBy("symbol").agg(F.max_by(F.struct(*df.columns), "run").alias("r")).select("r.*")


def materialize(spark: SparkSession, units: DataFrame, root: str, interval: str, strict: bool = False, resume: bool = False, universe: list[str] | None = None) -> dict:
    """Reads the archives in units (symbol, interval, archive_source, archive_period, path), resolves conflicts, sets invalid bars aside and writes the seed dataset under root; returns the totals.

    Counts of duplicates, conflicts and days over the cap are of all resolved bars; row_count, dates and years of what was written. quarantined counts a bar once that fails both rules. universe: the symbols of a full output; without them every output is one. Two small files tell about it: manifests/runs/RUN.json what this run did, manifests/RUN.json what the dataset then holds. With resume, symbols of an earlier run are skipped; strict raises before anything is written if there is a conflict, an inconsistency, a day over the cap or an invalid bar. Symbols whose archives hold no bars have no report.
    """
    bars_per_day(interval)
    units = units.where(F.col("interval") == interval)
    if resume:
        units = units.join(done_symbols(spark, root).select("symbol").distinct(), "symbol", "left_anti")
    bars = parse_lines(read_zip_lines(spark, units)).withColumnRenamed("line_no", "order")
    got = stored(resolve_archives(bars, ["symbol", "open_time"], VALUES).select("duplicates", "conflicts", "inconsistent", "winner.*"), "resolved")
    marked = with_quarantine(with_calendar(got))
    n = lambda x: F.count(F.when(x, 1))
    good = ~F.col("quarantined")
    each = marked.groupBy("symbol").agg(
        n(good).alias("row_count"), F.count_distinct(F.when(good, F.col("year"))).alias("files"), F.min(F.when(good, F.col("date"))).alias("date_min"), F.max(F.when(good, F.col("date"))).alias("date_max"),
        F.min(F.when(good, F.col("year"))).alias("year_min"), F.max(F.when(good, F.col("year"))).alias("year_max"), F.sum("duplicates").alias("duplicates"), F.sum("conflicts").alias("conflicts"), F.sum("inconsistent").alias("inconsistent"),
        n(F.col("ohlc_bad")).alias("ohlc_bad"), n(F.col("time_bad")).alias("time_bad"), n(F.col("quarantined")).alias("quarantined"),
    )
    days = over_cap(marked).groupBy("symbol").agg(F.count(F.lit(1)).alias("over_cap_days"))
    report = stored(each.join(days, "symbol", "left").withColumn("over_cap_days", F.coalesce("over_cap_days", F.lit(0))), "report")
    totals = _totals(report)
    if strict and any(totals[k] for k in ("conflicts", "inconsistent", "over_cap_days", "quarantined")):
        raise StrictError(json.dumps(totals))
    quarantined = write_seed(got.select(*BAR.fieldNames()), root)
    run = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{time.time_ns() % 10**9:09d}"
    if totals["quarantined"]:
        quarantined.drop("year").write.mode("append").json(f"{root}/reports/quarantine/{run}")
    report.coalesce(1).write.mode("overwrite").json(f"{root}/manifests/symbols/run={run}")
    done = done_symbols(spark, root)
    lacking = 0 if universe is None else spark.createDataFrame([(s.upper(),) for s in universe], "symbol string").join(done.select("symbol"), "symbol", "left_anti").count()
    fixed = {"dataset_id": f"bars.{interval}", "query_engine": "spark", "output_format": "parquet", "generated_csv_file_count": 0, "failed_symbol_count": 0, "scope": "SAMPLE_OUTPUT" if lacking else "FULL_OUTPUT"}
    whole = _totals(done) | fixed | {"interval": interval, "run": run}
    files = Files(spark, root)
    for where, said in ((["runs", f"{run}.json"], totals | {"interval": interval, "run": run, "resumed": resume}), ([f"{run}.json"], whole)):
        if not files.write_new(json.dumps(said), "manifests", *where):
            raise RuntimeError(f"there is a manifest of run {run} already")
    return totals


def _totals(report: DataFrame) -> dict:
    kinds = ["duplicates", "conflicts", "inconsistent", "over_cap_days", "ohlc_bad", "time_bad", "quarantined", "row_count", "files"]
    return report.agg(F.count(F.lit(1)).alias("symbols"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds], F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max"), F.min("year_min").alias("year_min"), F.max("year_max").alias("year_max")).first().asDict()


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    """The latest manifest of a dataset: totals over all its symbols, whichever run wrote each; None if nothing was materialised yet."""
    files = Files(spark, root)
    names = [n for n in files.names("manifests") if n.endswith(".json")]
    return json.loads(files.read_text("manifests", names[-1])) if names else None
