"""Reports: checks with a verdict as rows, their counters, and the patterns of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK = "rule_id string, severity string, status string, message string, file string, dataset_id string, field string, location string, details map<string,string>"

# Patterns that a whole name must match.
NAMES = {
    "dataset_id": r"[a-z0-9]+(?:[._-][a-z0-9]+)*",
    "field": r"[a-z][a-z0-9_]*",
    "version": r"v[0-9]+\.[0-9]+\.[0-9]+",
    "owner": r"[a-z0-9][a-z0-9._-]*",
    "schema_ref": r"[A-Z_]+\.md#[a-z0-9]+(?:-[a-z0-9]+)*",
    "doc_path": r"[a-z0-9_]+\.md",
    "data_path": r"[a-z0-9_]+(?:\.[a-z0-9_]+)+",
}


def matches(c: Column, kind: str) -> Column:
    """Whether a whole name fits its pattern; a trailing line break doesn't. False for null."""
    return F.coalesce(c.rlike(rf"\A(?:{NAMES[kind]})\z"), F.lit(False))


def counters(checks: DataFrame) -> DataFrame:
    """One row: checks, passed, failed, warnings, skipped, distinct files and datasets, and whether any failed check is an error."""
    n = lambda x: F.count(F.when(x, 1))
    s = F.col("status")
    return checks.agg(F.count(F.lit(1)).alias("checks"), n(s == "passed").alias("passed"), n(s == "failed").alias("failed"), n(s == "warning").alias("warnings"), n(s == "skipped").alias("skipped"), F.count_distinct("file").alias("files"), F.count_distinct("dataset_id").alias("datasets"), (n((s == "failed") & (F.col("severity") == "error")) > 0).alias("has_failures"))


def as_checks(failures: DataFrame, rule: Column, message: Column, field: Column, location: Column, dataset: str) -> DataFrame:
    """Failures of any rule as failed checks."""
    return failures.select(rule.alias("rule_id"), F.lit("error").alias("severity"), F.lit("failed").alias("status"), message.alias("message"), F.lit(None).cast("string").alias("file"), F.lit(dataset).alias("dataset_id"), field.alias("field"), location.alias("location"), F.create_map().cast("map<string,string>").alias("details"))


def verdicts(checks: DataFrame, rules: list[str]) -> DataFrame:
    """(rule_id, failures, status) of each rule: passed when no check of it failed."""
    spark = checks.sparkSession
    all_ = spark.createDataFrame([(r,) for r in rules], "rule_id string")
    n = checks.where("status = 'failed'").groupBy("rule_id").agg(F.count(F.lit(1)).alias("failures"))
    return all_.join(n, "rule_id", "left").select("rule_id", F.coalesce("failures", F.lit(0)).alias("failures"), F.when(F.col("failures") > 0, "failed").otherwise("passed").alias("status"))


def missing_upstreams(registry: DataFrame) -> DataFrame:
    """(dataset_id, upstream) of lineage entries that no dataset of the registry (dataset_id, upstreams array) has."""
    up = registry.select("dataset_id", F.explode("upstreams").alias("upstream")).distinct()
    return up.join(registry.select(F.col("dataset_id").alias("_id")).distinct(), F.col("upstream") == F.col("_id"), "left_anti")
