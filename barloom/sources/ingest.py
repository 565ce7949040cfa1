"""From a listing of archives to verified files: discovery, the plan of downloads, the downloads and their manifests."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.catalog import classify, discovery_summary, missing_from, period_of, process_summary, with_checksums
from barloom.schema import KEY
from barloom.session import ship, stored
from barloom.sources.archives import ListingSource, archive_symbols, download, read_jsonl, verify_files
from barloom.storage import Files

CATALOG = "symbol string, interval string, archive_package_source string, archive_period string, zip_name string, checksum_name string, source_path string, source_checksum_path string, local_zip_path string, local_checksum_path string, remote_size long, has_remote_checksum boolean, discovered_at string, covered_by_monthly boolean, daily_status string, download_decision string"
KINDS = ("monthly", "daily")


def listing(spark: SparkSession, endpoint: str, prefixes: list[str]) -> DataFrame:
    """(prefix, key, size) of all objects and folders under the prefixes, a task a prefix."""
    ship(spark)
    spark.dataSource.register(ListingSource)
    return spark.read.format("object_listing").option("endpoint", endpoint).option("prefixes", ",".join(prefixes)).load()


def discover(spark: SparkSession, endpoint: str, base: str, interval: str, raw: str, out: str, symbols: list[str] | None = None, full_history: bool = False) -> dict:
    """Lists the archives of an interval under base/KIND/SYMBOL/INTERVAL/, judges which daily ones the monthly ones cover, and writes the catalog as JSON lines to out/catalog; returns its counts. Without symbols those of both listings' folders are taken. The driver holds the names of symbols, a folder each, never those of archives."""
    if not symbols or symbols == ["all"]:
        tops = listing(spark, endpoint, [f"{base}/{k}/" for k in KINDS]).where("size is null")
        symbols = [r[0] for r in archive_symbols(tops, tops.limit(0)).collect()]
    wanted = [f"{base}/{k}/{s}/{interval}/" for k in KINDS for s in symbols]
    found = stored(listing(spark, endpoint, wanted).where("size is not null"), "listing") if wanted else spark.createDataFrame([], "prefix string, key string, size long")
    zips = with_checksums(found)
    at = lambda i: F.element_at(F.split("key", "/"), F.lit(-i))
    name, symbol, kind = at(1), at(3), at(4)
    period = period_of(name, symbol, F.lit(interval))
    period = F.when(period.isNull(), F.raise_error(F.concat(F.lit("unexpected archive name: "), name))).otherwise(period)
    local = lambda n: F.concat_ws("/", F.lit(raw.rstrip("/")), kind, symbol, n)
    sums = F.concat(name, F.lit(".CHECKSUM"))
    records = zips.select(symbol.alias("symbol"), F.lit(interval).alias("interval"), kind.alias("archive_package_source"), period.alias("archive_period"), name.alias("zip_name"), sums.alias("checksum_name"), F.col("key").alias("source_path"), F.concat("key", F.lit(".CHECKSUM")).alias("source_checksum_path"), local(name).alias("local_zip_path"), local(sums).alias("local_checksum_path"), F.col("size").alias("remote_size"), F.col("has_checksum").alias("has_remote_checksum"), F.lit(time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())).alias("discovered_at"))
    classify(records, ["symbol", "interval"], full_history).write.mode("overwrite").json(f"{out}/catalog")
    return plan(spark, out)


def read_catalog(spark: SparkSession, out: str) -> DataFrame:
    return read_jsonl(spark, f"{out}/catalog", CATALOG)


def plan(spark: SparkSession, out: str) -> dict:
    """The counts of the catalog: what there is, and what would be downloaded."""
    rows = discovery_summary(read_catalog(spark, out), []).collect()
    return rows[0].asDict() if rows else {}


def fetch(spark: SparkSession, base_url: str, out: str, dataset: str, interval: str) -> dict:
    """Downloads what the catalog decides on, verifies it, and writes the file manifest (out/files, JSON lines), the coverage report, the access list for readers and the run's manifest beside it; returns the summary of the run."""
    done = stored(download(read_catalog(spark, out), base_url), "downloads")
    done.write.mode("overwrite").json(f"{out}/files")
    summary = process_summary(done).first().asDict()
    said = {
        "dataset_id": dataset, "dataset_variant_id": f"{dataset}.{interval}", "interval": interval, "primary_key": KEY, "checksum_failed_count": summary["checksum_failed"],
        "daily_delta_policy": {"default": "daily archives of months without a monthly one"}, "include_full_daily_history": not done.where("daily_status = 'skipped_by_default'").limit(1).count(),
        "file_manifest": f"{out}/files", "coverage_report": f"{out}/coverage", "research_access": f"{out}/access",
    }
    coverage(done).write.mode("overwrite").json(f"{out}/coverage")
    access(done).write.mode("overwrite").json(f"{out}/access")
    files = Files(spark, out)
    if files.exists("manifest.json"):
        files.delete("manifest.json")
    files.write_new(json.dumps(said | {"summary": summary}, default=str), "manifest.json")
    return summary


def coverage(files: DataFrame) -> DataFrame:
    """(symbol, interval, archives, verified, missing, first_period, last_period, complete) of a file manifest."""
    n = lambda x: F.count(F.when(x, 1))
    ok, skipped = F.col("checksum_status").isin("passed", "skipped_existing_verified"), F.col("download_status") == "skipped_daily_overlap"
    out = files.groupBy("symbol", "interval").agg(F.count(F.lit(1)).alias("archives"), n(ok).alias("verified"), n(~ok & ~skipped).alias("missing"), F.min(F.when(ok, F.col("archive_period"))).alias("first_period"), F.max(F.when(ok, F.col("archive_period"))).alias("last_period"))
    return out.withColumn("complete", F.col("missing") == 0)


def access(files: DataFrame) -> DataFrame:
    """(symbol, interval, archive_package_source, archive_period, local_zip_path) of the verified archives, what readers may use."""
    return files.where(F.col("checksum_status").isin("passed", "skipped_existing_verified")).select("symbol", "interval", "archive_package_source", "archive_period", "local_zip_path")


def verify(spark: SparkSession, out: str) -> dict:
    """The archives of the file manifest checked against their checksums anew: counts by status, and the archives of the catalog that no file stands for."""
    schema = CATALOG + ", download_status string, checksum_status string, file_size long, retry_count int"
    files = read_jsonl(spark, f"{out}/files", schema)
    got = {r[0]: r[1] for r in verify_files(spark, files.where("download_status <> 'skipped_daily_overlap'")).groupBy("checksum_status").count().collect()}
    return {"checksums": got, "unlisted": missing_from(read_catalog(spark, out).select("zip_name"), files, ["zip_name"]).count()}
