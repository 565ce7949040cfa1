"""Validation of a dataset against its manifest: all counts from one scan, every verdict a row of checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.intervals import INTERVALS
from barloom.operators.catalog import verified_archives
from barloom.operators.quality import duplicate_keys, fused_counts, over_cap
from barloom.report import CHECK, matches
from barloom.schema import KEY
from barloom.session import ship
from barloom.storage import Files, arrow_place

#: Columns that readers rely on. Fixed values.
LOGICAL = ["symbol", "year", "interval", "open_time", "open_time_utc", "open_time_taipei", "date", "month", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", "source_archive", "archive_source", "archive_period"]


def dataset_checks(spark: SparkSession, bars: DataFrame, files: DataFrame, manifest: dict, dataset_id: str) -> DataFrame:
    """Checks of a dataset: bars as lake.read_bars() gives them, files as lake.list_files(), manifest with interval, row_count, files and symbols. A sample output passes its scope as a warning."""
    out: list[tuple] = []

    def check(rule: str, ok: bool, message: str, severity: str = "error", status: str | None = None, **details) -> None:
        out.append((rule, severity, status or ("passed" if ok else "failed"), message, None, dataset_id, None, None, {k: str(v) for k, v in details.items()}))

    missing = sorted(set(LOGICAL) - set(bars.columns))
    check("PQ-LOGICAL-SCHEMA", not missing, "all columns are there" if not missing else "columns are missing", missing=",".join(missing))
    if not missing:
        c = fused_counts(bars, []).first().asDict()
        twice = duplicate_keys(bars, ["symbol", "interval", "open_time"], []).first()
        symbols = bars.select("symbol").distinct().count()
        listed = files.where("symbol is not null").count()
        check("PQ-ROW-COUNT-MATCH", c["rows"] == manifest["row_count"], "rows as in the manifest", found=c["rows"], expected=manifest["row_count"])
        check("PQ-FILE-COUNT-MATCH", listed == manifest["files"], "files as in the manifest", found=listed, expected=manifest["files"])
        check("PQ-SYMBOL-COUNT", symbols == manifest["symbols"], "symbols as in the manifest", found=symbols, expected=manifest["symbols"])
        intervals = [r[0] for r in bars.select("interval").distinct().limit(2).collect()]
        check("PQ-INTERVAL-MATCH", intervals in ([], [manifest["interval"]]), "one interval, that of the manifest")
        for rule, key, text in (("PQ-NO-NULL", "null_rows", "no nulls"), ("PQ-OHLC-RULE", "ohlc_bad", "prices fit"), ("PQ-DATE-POLICY", "date_bad", "dates are those of UTC+8"), ("PQ-OPEN-TIME-ALIGNMENT", "misaligned", "open_time on the grid"), ("PQ-CLOSE-TIME-RULE", "close_bad", "close_time ends the bar")):
            check(rule, c[key] == 0, text, violations=c[key])
        check("PQ-UNIQUE-KEY", twice["duplicated"] == 0, "keys are unique", violations=twice["duplicated"])
        many = over_cap(bars).count()
        check("PQ-SYMBOL-DATE-LIMIT", many == 0, "no day has more bars than fit", violations=many)
        full = manifest.get("scope", "FULL_OUTPUT") == "FULL_OUTPUT"
        check("PQ-OUTPUT-SCOPE", full, "output is full" if full else "output is a sample", "info" if full else "warning", None if full else "warning")
    return spark.createDataFrame(out, CHECK)


class _Report:
    """Collects checks of one document."""

    def __init__(self, dataset: str | None = None, file: str | None = None):
        self.rows: list[tuple] = []
        self.dataset, self.file = dataset, file

    def check(self, rule: str, ok: bool | None, message: str, field: str | None = None, severity: str = "error", status: str | None = None, **details) -> bool:
        """ok None: skipped."""
        said = status or ("skipped" if ok is None else "passed" if ok else "failed")
        self.rows.append((rule, "info" if said == "skipped" else severity, said, message, self.file, self.dataset, field, None, {k: str(v) for k, v in details.items()}))
        return bool(ok)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, CHECK)


def manifest_checks(spark: SparkSession, root: str, manifest: dict | None, interval: str, universe: list[str] | None = None) -> DataFrame:
    """Checks of a dataset's manifest, and of the files under root, against what a complete dataset is: the interval is supported and the manifest's, the manifest is there and names its dataset and format, no text files were made or lie in the tree, it has symbols, rows and files, no symbol failed, and the scope. With universe, the symbols that a full output has, those that lack files are named. Files are only listed."""
    from barloom.sources.lake import list_files

    r = _Report(f"bars.{interval}", f"{root}/manifests")
    r.check("PQ-INTERVAL-SUPPORTED", interval in INTERVALS, f"interval is one of {' '.join(INTERVALS)}", "interval", value=interval)
    if not r.check("PQ-MANIFEST-EXISTS", manifest is not None, "the dataset has a manifest"):
        return r.frame(spark)
    for rule, field, want in (("PQ-DATASET-ID", "dataset_id", f"bars.{interval}"), ("PQ-INTERVAL-MATCH", "interval", interval), ("PQ-QUERY-ENGINE", "query_engine", "spark"), ("PQ-OUTPUT-FORMAT", "output_format", "parquet"), ("PQ-NO-GENERATED-CSV", "generated_csv_file_count", 0), ("PQ-FAILED-SYMBOLS", "failed_symbol_count", 0)):
        r.check(rule, manifest.get(field) == want, f"{field} is {want}", field, value=manifest.get(field))
    for rule, field in (("PQ-SYMBOL-COUNT", "symbols"), ("PQ-ROW-COUNT", "row_count")):
        r.check(rule, (manifest.get(field) or 0) > 0, f"{field} is positive", field, value=manifest.get(field))
    scope = manifest.get("scope")
    r.check("PQ-OUTPUT-SCOPE", scope == "FULL_OUTPUT", f"scope is {scope}", "scope", "warning" if scope == "SAMPLE_OUTPUT" else "error", "warning" if scope == "SAMPLE_OUTPUT" else None)
    if not r.check("PQ-OUTPUT-ROOT", Files(spark, root).exists(""), "the dataset's folder is there", value=root):
        return r.frame(spark)
    texts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(root).select("path")
    n_texts = texts.count()
    r.check("PQ-NO-CSV", n_texts == 0, "no CSV files in the tree", files=n_texts)
    files = list_files(spark, root).where("symbol is not null")
    n = files.count()
    r.check("PQ-PARQUET-EXISTS", n > 0, "there are Parquet files", files=n)
    r.check("PQ-FILE-COUNT-MATCH", n == manifest.get("files"), "files as in the manifest", "files", found=n, expected=manifest.get("files"))
    if universe is None:
        r.check("PQ-FULL-SYMBOL-COVERAGE", None, "no universe to hold the symbols against")
    else:
        wanted = spark.createDataFrame([(s.upper(),) for s in universe], "symbol string")
        lost = wanted.join(files.select("symbol").distinct(), "symbol", "left_anti")
        n_lost = lost.count()
        first = [x[0] for x in lost.orderBy("symbol").limit(5).collect()]
        full = scope == "FULL_OUTPUT"
        r.check("PQ-FULL-SYMBOL-COVERAGE", n_lost == 0 if full else None, "every symbol of the universe has files", "symbols", missing=n_lost, first=",".join(first))
    return r.frame(spark)


def archive_checks(spark: SparkSession, path: str, interval: str, dataset: str, ignored: str | None = None) -> DataFrame:
    """Checks of a manifest of downloaded archives: a JSON file at path with interval, dataset_id, dataset_variant_id, primary_key, checksum_failed_count, daily_delta_policy, include_full_daily_history and the places of its file manifest (JSON lines), coverage report and research access. Every verified archive of the file manifest must be there; they are looked up where tasks run. ignored: the text of a list of ignored paths, which must name local_data/."""
    import json

    r = _Report(dataset, path)
    r.check("KL-INTERVAL-SUPPORTED", interval in INTERVALS, f"interval is one of {' '.join(INTERVALS)}", "interval", value=interval)
    if ignored is not None:
        r.check("KL-LOCAL-DATA-GITIGNORE", any(line.strip().strip("/") == "local_data" for line in ignored.splitlines()), "local data is not tracked")
    folder, _, name = path.rpartition("/")
    files, manifest = Files(spark, folder), None
    if files.exists(name):
        try:
            manifest = json.loads(files.read_text(name))
        except ValueError:
            manifest = None
    if not r.check("KL-MANIFEST-EXISTS", isinstance(manifest, dict), "the manifest is there and is JSON"):
        return r.frame(spark)
    for rule, field, want in (("KL-INTERVAL-MATCH", "interval", interval), ("KL-DATASET-ID", "dataset_id", dataset), ("KL-VARIANT-ID", "dataset_variant_id", f"{dataset}.{interval}"), ("KL-PRIMARY-KEY", "primary_key", KEY), ("KL-CHECKSUM-FAILED", "checksum_failed_count", 0)):
        r.check(rule, manifest.get(field) == want, f"{field} is {want}", field, value=manifest.get(field))
    r.check("KL-DAILY-POLICY", isinstance(manifest.get("daily_delta_policy"), dict) and "include_full_daily_history" in manifest, "the policy on daily archives is recorded", "daily_delta_policy")

    def there(p) -> bool:
        return isinstance(p, str) and p != "" and Files(spark, p.rpartition("/")[0] or ".").exists(p.rpartition("/")[2])

    for rule, field in (("KL-FILE-MANIFEST", "file_manifest"), ("KL-COVERAGE-REPORT", "coverage_report"), ("KL-RESEARCH-ACCESS", "research_access")):
        r.check(rule, there(manifest.get(field)), f"{field} is there", field, value=manifest.get(field))
    listed = manifest.get("file_manifest")
    if not there(listed):
        r.check("KL-REQUIRED-FILES", None, "no file manifest to look the archives up by")
        return r.frame(spark)
    ok = verified_archives(spark.read.schema("local_zip_path string, download_status string, checksum_status string").json(listed))
    found = files_there(ok.select("local_zip_path"), "local_zip_path").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("there"), 1)).alias("lost"), F.min(F.when(~F.col("there"), F.col("local_zip_path"))).alias("first")).first()
    r.check("KL-REQUIRED-FILES", found["n"] > 0 and found["lost"] == 0, "every verified archive is there", "file_manifest", verified=found["n"], missing=found["lost"], first=found["first"])
    return r.frame(spark)


def files_there(paths: DataFrame, column: str) -> DataFrame:
    """paths with there: whether the file of each row exists, looked up in parallel. A null is not there."""
    from barloom.sources.archives import spread

    def run(batches):
        from pyarrow import fs

        for b in batches:
            out = []
            for p in b[column]:
                try:
                    system, place = arrow_place(p) if isinstance(p, str) and p else (None, None)
                    out.append(system is not None and system.get_file_info(place).type != fs.FileType.NotFound)
                except OSError:
                    out.append(False)
            yield b.assign(there=out)

    ship(paths.sparkSession)
    return spread(paths, column).mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in paths.dtypes) + ", there boolean")


#: Registry entries as naming_checks() reads them.
REGISTRY = "registry_version string, datasets array<struct<dataset_id: string, version: string, schema_ref: string, created_at: string, updated_at: string, snapshot: struct<snapshot_id: string>>>"


def _utc(c: Column) -> Column:
    """Whether a text is a point in time of ISO 8601 with the offset zero."""
    whole = c.rlike(r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?)(?:Z|[+-]00:?00(?::?00)?)\z")
    day = F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))
    clock = F.coalesce(F.regexp_extract(c, r"[T ]([01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d)?)?(?:[.,]\d+)?(?:Z|[+-])", 1) != "", F.lit(False))
    return F.coalesce(whole & day.isNotNull() & clock, F.lit(False))


def naming_checks(registry: DataFrame, file: str) -> DataFrame:
    """Checks of the names in a dataset registry, a row of REGISTRY a document: its version and, of every entry, identifier, version, reference to its schema, two points in time, and the path of its snapshot, which is skipped where none is published."""
    head = registry.select(F.lit("NAMING-REGISTRY-VERSION").alias("rule_id"), matches(F.col("registry_version"), "version").alias("ok"), F.lit(None).cast("string").alias("dataset_id"), F.lit("registry_version").alias("field"), F.lit(None).cast("string").alias("location"), F.col("registry_version").alias("value"))
    each = registry.select(F.posexplode("datasets").alias("i", "e"))
    snap = F.col("e.snapshot.snapshot_id")
    part = lambda p: matches(p, "dataset_id") | matches(p, "data_path")
    safe = F.forall(F.filter(F.split(snap, "/"), lambda p: p != ""), part) & ~F.startswith(snap, F.lit("/"))
    rules = [
        ("NAMING-DATASET-ID", "dataset_id", matches(F.col("e.dataset_id"), "dataset_id"), F.col("e.dataset_id")),
        ("NAMING-DATASET-VERSION", "version", matches(F.col("e.version"), "version"), F.col("e.version")),
        ("NAMING-METADATA-REF", "schema_ref", matches(F.col("e.schema_ref"), "schema_ref"), F.col("e.schema_ref")),
        ("NAMING-TIMESTAMP", "created_at", _utc(F.col("e.created_at")), F.col("e.created_at")),
        ("NAMING-TIMESTAMP", "updated_at", _utc(F.col("e.updated_at")), F.col("e.updated_at")),
        ("NAMING-SNAPSHOT-PATH", "snapshot.snapshot_id", F.when(F.nullif(snap, F.lit("")).isNotNull(), safe), snap),
    ]
    body = each.select("i", F.col("e.dataset_id").alias("dataset_id"), F.explode(F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(f).alias("field"), ok.alias("ok"), v.alias("value")) for r, f, ok, v in rules])).alias("c"))
    body = body.select("c.rule_id", "c.ok", "dataset_id", "c.field", F.format_string("datasets[%d]", "i").alias("location"), "c.value")
    both = head.unionByName(body)
    status = F.when(F.col("ok").isNull(), "skipped").when(F.col("ok"), "passed").otherwise("failed")
    return both.select("rule_id", F.when(status == "skipped", "info").otherwise("error").alias("severity"), status.alias("status"), F.concat("field", F.when(F.col("ok"), " is named as it should be").when(F.col("ok").isNull(), " is not published").otherwise(" is not named as it should be")).alias("message"), F.lit(file).alias("file"), "dataset_id", "field", "location", F.when(status == "failed", F.create_map(F.lit("value"), F.coalesce("value", F.lit("")))).otherwise(F.create_map().cast("map<string,string>")).alias("details"))
