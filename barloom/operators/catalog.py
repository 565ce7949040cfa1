"""Archive listings: periods, coverage of daily by monthly archives, summaries, missing files and checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of an archive record.
DOWNLOAD, SKIP = "download", "skip"
REQUIRED_DELTA, SKIPPED, INCLUDED = "required_delta", "skipped_by_default", "included_by_explicit_full_daily_history"
VERIFIED = ["passed", "skipped_existing_verified"]
DOWNLOADED = ["downloaded", "skipped_existing_verified"]
GAPS = ["failed", "missing_zip", "missing_checksum", "download_failed"]


def period_of(zip_name: Column, symbol: Column, interval: Column) -> Column:
    """What follows SYMBOL-INTERVAL- in an archive's name; null for another name."""
    head = F.concat(symbol, F.lit("-"), interval, F.lit("-"))
    ok = F.startswith(zip_name, head) & F.endswith(zip_name, F.lit(".zip"))
    return F.when(ok, F.substring(zip_name, F.length(head) + 1, F.length(zip_name) - F.length(head) - 4))


def period_start(period: Column) -> Column:
    """The first day of a month or day period as text."""
    return F.when(F.length(period) == 7, F.concat(period, F.lit("-01"))).otherwise(period)


def period_end(period: Column) -> Column:
    """The last day of a month or day period as text."""
    last = F.date_format(F.last_day(F.try_to_timestamp(F.concat(period, F.lit("-01")), F.lit("yyyy-MM-dd"))), "yyyy-MM-dd")
    return F.when(F.length(period) == 7, last).otherwise(period)


def classify(records: DataFrame, key: list[str], full_history: bool = False) -> DataFrame:
    """records with covered_by_monthly, daily_status and download_decision: a daily archive is covered when its month is among the monthly ones of the same key. Monthly archives are always downloaded and have null for the other two. Columns of these names are replaced."""
    records = records.drop("covered_by_monthly", "daily_status", "download_decision")
    months = records.where("archive_package_source = 'monthly' and archive_period is not null").select(*[F.col(k).alias(f"_m_{k}") for k in key], F.substring("archive_period", 1, 7).alias("_month")).distinct().withColumn("_hit", F.lit(True))
    on = F.substring("archive_period", 1, 7) == F.col("_month")
    for k in key:
        on = on & (F.col(k) == F.col(f"_m_{k}"))
    out = records.join(months, on, "left")
    monthly = F.col("archive_package_source") == "monthly"
    covered = F.when(~monthly, F.coalesce("_hit", F.lit(False)))
    status = F.when(~covered, REQUIRED_DELTA).when(covered, INCLUDED if full_history else SKIPPED)
    out = out.withColumns({"covered_by_monthly": covered, "daily_status": status})
    return out.withColumn("download_decision", F.when(F.col("daily_status") == SKIPPED, SKIP).otherwise(DOWNLOAD)).drop("_month", "_hit", *[f"_m_{k}" for k in key])


def discovery_summary(records: DataFrame, by: list[str]) -> DataFrame:
    """Counts of classified records: files, monthly and daily ones, their symbols, states, planned downloads, first and last day."""
    n = lambda x: F.count(F.when(x, 1))
    m, d = F.col("archive_package_source") == "monthly", F.col("archive_package_source") != "monthly"
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), n(m).alias("monthly_files"), n(d).alias("daily_files"),
        F.count_distinct(F.when(m, F.col("symbol"))).alias("monthly_symbols"), F.count_distinct(F.when(d, F.col("symbol"))).alias("daily_symbols"),
        n(F.col("daily_status") == REQUIRED_DELTA).alias("required_delta"), n(F.col("daily_status") == SKIPPED).alias("skipped_by_default"), n(F.col("daily_status") == INCLUDED).alias("included_full_history"),
        n(F.col("download_decision") == DOWNLOAD).alias("planned_downloads"), F.min(period_start(F.col("archive_period"))).alias("date_min"), F.max(period_end(F.col("archive_period"))).alias("date_max"),
    )


def process_summary(files: DataFrame, gap_cap: int = 100) -> DataFrame:
    """One row over a file manifest: counts by status, bytes, sources, days, and the first gap_cap gaps by symbol and period with a line for the rest."""
    n = lambda x: F.count(F.when(x, 1))
    ds, cs = F.col("download_status"), F.col("checksum_status")
    one = files.agg(
        F.count(F.lit(1)).alias("files"), n(ds == "downloaded").alias("downloaded"), n(ds == "skipped_existing_verified").alias("skipped_existing"), n(ds == "skipped_daily_overlap").alias("skipped_overlap"), n(ds == "failed").alias("failed"),
        n(cs.isin(VERIFIED)).alias("verified"), n(cs == "failed").alias("checksum_failed"), n(cs.isin("missing_zip", "missing_checksum")).alias("missing"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"), F.sort_array(F.collect_set("archive_package_source")).alias("sources"),
        F.min(period_start(F.col("archive_period"))).alias("date_min"), F.max(period_end(F.col("archive_period"))).alias("date_max"), n(cs.isin(GAPS)).alias("gaps"),
    )
    line = F.concat("symbol", F.lit(" "), "archive_period", F.lit(" ("), "archive_package_source", F.lit("): "), "checksum_status")
    first = files.where(cs.isin(GAPS)).orderBy("symbol", "archive_package_source", "archive_period").limit(gap_cap).agg(F.sort_array(F.collect_list(line)).alias("known_gaps"))
    more = F.when(F.col("gaps") > gap_cap, F.array(F.concat(F.lit("... and "), (F.col("gaps") - gap_cap).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>"))
    both = one.withColumn("_k", F.lit(1)).join(first.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    return both.withColumn("known_gaps", F.concat("known_gaps", more))


def gap_files(files: DataFrame) -> DataFrame:
    """Records of a file manifest that count as missing."""
    return files.where(F.col("checksum_status").isin(GAPS) | (F.col("download_status") == "failed"))


def verified_archives(files: DataFrame) -> DataFrame:
    """Records whose archive was downloaded and whose checksum holds."""
    return files.where(F.col("download_status").isin(DOWNLOADED) & F.col("checksum_status").isin(VERIFIED))


def missing_from(wanted: DataFrame, there: DataFrame, on: list[str]) -> DataFrame:
    """Distinct rows of wanted without a match in there, on the given columns."""
    return wanted.distinct().join(there.select(*on).distinct(), on, "left_anti")


def with_checksums(files: DataFrame) -> DataFrame:
    """Adds has_checksum to listed objects (key, size): whether key + '.CHECKSUM' is listed too. Only the zips are returned."""
    sums = files.where(F.col("key").endswith(".zip.CHECKSUM")).select(F.regexp_replace("key", r"\.CHECKSUM$", "").alias("_key")).distinct().withColumn("_hit", F.lit(True))
    return files.where(F.col("key").endswith(".zip")).join(sums, F.col("key") == F.col("_key"), "left").withColumn("has_checksum", F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")


def checksum_holds(content: Column, checksum_text: Column) -> Column:
    """Whether the sha256 of content is the first word of a checksum file."""
    return F.sha2(content, 256) == F.lower(F.split(F.trim(checksum_text), r"\s+")[0])
