"""Layout of a partitioned dataset: audit of year-only and year-and-month files, prechecks, and the plan of a migration in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import taipei_time

# States of a symbol's files.
NONE, YEAR_ONLY, MIXED = "no_migration_needed", "year_only_needs_migration", "mixed_layout_needs_migration"
#: Substrings of directories that a migration leaves behind.
MARKERS = ["__stage_migrate", "__backup_migrate"]


def symbol_of(path: Column) -> Column:
    """The symbol of a file by its symbol= directory; null for one with a dot or a migration marker in it."""
    s = F.regexp_extract(path, r"symbol=([^/]+)/", 1)
    bad = (s == "") | s.contains(".")
    for m in MARKERS:
        bad = bad | s.contains(m)
    return F.when(~bad, F.upper(F.url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))))


def has_month(path: Column) -> Column:
    return path.rlike(r"/month=[^/]*/")


def audit(files: DataFrame) -> DataFrame:
    """(symbol, year_only_files, year_month_files, mixed) for files (symbol, path)."""
    n = lambda x: F.count(F.when(x, 1))
    out = files.groupBy("symbol").agg(n(~has_month(F.col("path"))).alias("year_only_files"), n(has_month(F.col("path"))).alias("year_month_files"))
    return out.withColumn("mixed", (F.col("year_only_files") > 0) & (F.col("year_month_files") > 0))


def year_only(files: DataFrame) -> DataFrame:
    """The files (symbol, path) that lie in year partitions without a month, what a migration would rewrite."""
    return files.where("symbol is not null").where(~has_month(F.col("path")) & F.col("path").rlike(r"/year=[^/]*/"))


def precheck(rows: DataFrame) -> DataFrame:
    """A row a symbol over rows (symbol, path, open_time): status, files of each kind, row_count, duplicates, partitions wanted, min and max open_time.

    Distinct open_times and partitions are counted in two steps of partial sums, so a symbol may have any number of rows."""
    files = rows.select("symbol", "path").distinct()
    layout = audit(files)
    keys = rows.groupBy("symbol", "open_time").agg(F.count(F.lit(1)).alias("n"))
    month = F.date_format(taipei_time(F.col("open_time")), "yyyy-MM")
    months = keys.groupBy("symbol", month.alias("month")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("open_time").alias("a"), F.max("open_time").alias("b"))
    per = months.groupBy("symbol").agg(F.sum("n").alias("row_count"), (F.sum("n") - F.sum("k")).alias("duplicates"), F.count(F.lit(1)).alias("partitions"), F.min("a").alias("min_open_time"), F.max("b").alias("max_open_time"))
    status = F.when(F.col("mixed"), MIXED).when(F.col("year_only_files") > 0, YEAR_ONLY).otherwise(NONE)
    return layout.join(per, "symbol").withColumn("status", status).drop("mixed")


#: Order of migration: symbols without duplicates first, then by rows, partitions and name.
def ranking() -> list[Column]:
    return [F.when(F.col("duplicates") > 0, 1).otherwise(0), F.col("row_count"), F.col("partitions"), F.col("symbol")]


def candidates(checks: DataFrame, include_mixed: bool = False, max_rows: int = 0, limit: int = 0) -> DataFrame:
    """Prechecks of symbols that may be migrated, the first `limit` by rank if given."""
    ok = F.col("status").isin([YEAR_ONLY] + ([MIXED] if include_mixed else []))
    out = checks.where(ok & (F.lit(max_rows <= 0) | (F.col("row_count") <= max_rows)))
    return out.orderBy(*ranking()).limit(limit) if limit else out


def quote_asset(symbol: Column, quotes: list[str]) -> Column:
    """The first of quotes that the part before an underscore ends with."""
    base = F.upper(F.split_part(symbol, F.lit("_"), F.lit(1)))
    out = F.lit(None).cast("string")
    for q in reversed(quotes):
        out = F.when(F.endswith(base, F.lit(q)), F.lit(q)).otherwise(out)
    return out


def is_delivery(symbol: Column) -> Column:
    return symbol.rlike(r"_[0-9]{6}\z")


def is_ascii(symbol: Column) -> Column:
    return ~symbol.rlike(r"[^\x00-\x7F]")


def with_reason(found: DataFrame, default: list[str], explicit: list[str], quotes: list[str], wanted_quotes: list[str], delivery: bool = True, settled: bool = True, non_ascii: bool = True) -> DataFrame:
    """found with reason: the first reason in a fixed order for which a symbol is left out, or null."""
    s = F.col("symbol")
    quote = quote_asset(s, quotes)
    cases = [(s.isin(default) if default else F.lit(False), "default_excluded_symbol"), (s.isin(explicit) if explicit else F.lit(False), "explicit_excluded_symbol"), (F.col("status") == MIXED, "mixed_layout"), (F.lit(delivery) & is_delivery(s), "delivery_contract"), (F.lit(settled) & s.contains("SETTLED"), "settled"), (F.lit(non_ascii) & ~is_ascii(s), "non_ascii"), (F.lit(bool(wanted_quotes)) & ~F.coalesce(quote.isin(wanted_quotes), F.lit(False)) if wanted_quotes else F.lit(False), "quote_asset_mismatch")]
    reason = F.lit(None).cast("string")
    for cond, name in reversed(cases):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    return found.withColumn("reason", reason)


def batches(found: DataFrame, size: int, most: int) -> DataFrame:
    """(symbol, batch_no, row_count, partitions) of the first size * most candidates without a reason, by rank."""
    kept = found.where("reason is null").orderBy(*ranking()).limit(size * most).withColumn("_n", F.row_number().over(Window.orderBy(*ranking())))
    return kept.select("symbol", (F.call_function("div", F.col("_n") - 1, F.lit(size)) + 1).alias("batch_no"), "row_count", "partitions")


def batch_totals(planned: DataFrame) -> DataFrame:
    return planned.groupBy("batch_no").agg(F.count(F.lit(1)).alias("symbols"), F.sum("row_count").alias("total_rows"), F.sum("partitions").alias("total_partitions"), F.max("row_count").alias("most_rows"), F.max("partitions").alias("most_partitions"))
