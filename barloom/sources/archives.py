"""Archives of bars: zipped CSV files read in parallel, object listings, manifests, and checks of files against their checksums."""

from __future__ import annotations

import io
import time
import urllib.error
import urllib.parse
import urllib.request
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barloom.operators.catalog import verified_archives
from barloom.schema import BAR, CSV
from barloom.session import ship
from barloom.storage import arrow_place

#: Bytes of CSV that are handed on at a time, and the most tasks that files are spread over.
BLOCK, TASKS = 8 << 20, 20_000
#: Archives a task, as a task costs a Python worker more than reading a small one; so many tasks get one each before any gets more.
EACH, LEAST = 32, 64


def _lines(content: bytes) -> Iterator[list[str]]:
    """Blocks of lines of the first .csv member; nothing if there is none."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        name = next((n for n in z.namelist() if n.lower().endswith(".csv")), None)
        if name is None:
            return
        with z.open(name) as f:
            rest = b""
            while block := f.read(BLOCK):
                *whole, rest = (rest + block).split(b"\n")
                if whole:
                    yield [x.decode("utf-8", "replace") for x in whole]
            yield [rest.decode("utf-8", "replace")]


def read_zip_lines(spark: SparkSession, specs: DataFrame) -> DataFrame:
    """(symbol, interval, archive_source, archive_period, source_archive, line_no, line, error) of the archives in specs (symbol, interval, archive_source, archive_period, path). A member is unpacked in blocks, so its size doesn't matter; an archive that can't be read gives one row with an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in b.itertuples(index=False):
                head = {"symbol": s.symbol, "interval": s.interval, "archive_source": s.archive_source, "archive_period": s.archive_period, "source_archive": s.path}
                at = 0
                try:
                    system, place = arrow_place(s.path)
                    with system.open_input_stream(place) as f:
                        content = f.read()
                    for lines in _lines(content):
                        yield pd.DataFrame({**head, "line_no": range(at, at + len(lines)), "line": lines, "error": None})
                        at += len(lines)
                except Exception as e:  # noqa: BLE001 - the reason is the result
                    yield pd.DataFrame([head | {"line_no": at, "line": None, "error": f"{type(e).__name__}: {e}"[:300]}])

    ship(spark)
    shape = "symbol string, interval string, archive_source string, archive_period string, source_archive string, line_no long, line string, error string"
    cols = specs.select("symbol", "interval", "archive_source", "archive_period", "path")
    return spread(cols, "path", EACH).mapInPandas(run, shape)


def spread(rows: DataFrame, key: str, each: int = 1) -> DataFrame:
    """Rows that each stand for a file, over as many tasks as their counted number asks for, whatever their few bytes: `each` rows a task (fewer while that makes under LEAST tasks) up to TASKS, then alike many in each."""
    n = rows.count()
    return rows.repartition(max(1, min(n, max(LEAST, -(-n // each)), TASKS)), F.xxhash64(key)) if n > 1 else rows


def parse_lines(lines: DataFrame, keep_errors: bool = False) -> DataFrame:
    """Bars (schema.BAR and line_no) of CSV lines. Blank lines and those whose first cell isn't a whole number, wherever they stand, are headers and left out; a line with fewer than eleven cells, or with one that can't be read, is an error: it raises when run, or with keep_errors stays as a row with error and null fields."""
    cells = F.split("line", ",", -1)
    df = lines.withColumn("_c", cells)
    first = F.trim(F.try_element_at("_c", F.lit(1))).try_cast("long")
    df = df.where(F.col("error").isNotNull() | (F.coalesce(F.trim("line") != "", F.lit(False)) & first.isNotNull()))
    types = {f.name: f.dataType for f in BAR.fields}
    values = {c: F.trim(F.try_element_at("_c", F.lit(i + 1))).try_cast(types[c]) for i, c in enumerate(CSV)}
    error = F.coalesce(F.col("error"), F.when(F.size("_c") < 11, "fewer than 11 fields"))
    for c, v in values.items():
        error = F.coalesce(error, F.when(v.isNull(), F.concat(F.lit(f"cannot read {c} in line "), F.col("line_no").cast("string"))))
    df = df.withColumns(values).withColumn("error", error).drop("_c")
    cols = [*BAR.fieldNames(), "line_no"]
    if keep_errors:
        return df.select(*cols, "error")
    check = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.col("source_archive"), F.lit(": "), F.col("error")))).otherwise(F.col("open_time"))
    return df.withColumn("open_time", check).select(*cols)


def work_units(spark: SparkSession, files_jsonl: str, raw_root: str) -> DataFrame:
    """(symbol, interval, archive_source, archive_period, path) of the verified records of a file manifest in JSON lines; a record without a local path is looked for under raw_root by source and symbol."""
    schema = "symbol string, interval string, archive_package_source string, archive_period string, zip_name string, local_zip_path string, download_status string, checksum_status string"
    ok = verified_archives(spark.read.schema(schema).json(files_jsonl))
    path = F.coalesce(F.nullif("local_zip_path", F.lit("")), F.concat_ws("/", F.lit(raw_root.rstrip("/")), "archive_package_source", "symbol", "zip_name"))
    return ok.select("symbol", "interval", F.col("archive_package_source").alias("archive_source"), "archive_period", path.alias("path"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by a given schema; blank lines are left out. A catalog without source_checksum_path gets source_path + .CHECKSUM."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if {"source_path", "source_checksum_path"} <= set(df.columns):
        df = df.withColumn("source_checksum_path", F.coalesce("source_checksum_path", F.concat("source_path", F.lit(".CHECKSUM"))))
    return df


def verify_files(spark: SparkSession, records: DataFrame) -> DataFrame:
    """records (local_zip_path, local_checksum_path, ...) with checksum_status: passed, failed, missing_zip or missing_checksum, and file_size. Files are hashed as streams where they lie, never held whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        for b in batches:
            status, sizes = [], []
            for zp, cp in zip(b["local_zip_path"], b["local_checksum_path"], strict=True):
                size = None
                try:
                    system, place = arrow_place(zp)
                    info = system.get_file_info(place)
                    if info.type == fs.FileType.NotFound:
                        status.append("missing_zip")
                        sizes.append(None)
                        continue
                    size = info.size
                    system2, place2 = arrow_place(cp)
                    if system2.get_file_info(place2).type == fs.FileType.NotFound:
                        status.append("missing_checksum")
                        sizes.append(size)
                        continue
                    h = hashlib.sha256()
                    with system.open_input_stream(place) as f:
                        while block := f.read(1 << 20):
                            h.update(block)
                    with system2.open_input_stream(place2) as f:
                        words = f.read().decode().split()
                    status.append("passed" if words and words[0].lower() == h.hexdigest() else "failed")
                except OSError:
                    status.append("failed")
                sizes.append(size)
            yield b.assign(checksum_status=status, file_size=pd.array(sizes, dtype="Int64"))

    ship(spark)
    rows = records.drop("checksum_status", "file_size")
    shape = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", checksum_status string, file_size long"
    return spread(rows, "local_zip_path", EACH).mapInPandas(run, shape)


# -- listings


class TransientError(RuntimeError):
    """A listing that failed for now."""


def http_get(url: str, timeout: int = 30, retries: int = 3, opener: Callable | None = None, sleep: Callable = time.sleep) -> bytes:
    """The bytes at a URL. 404 raises FileNotFoundError at once; other failures are tried again after 2, 4, 8, 8 ... seconds."""
    for attempt in range(retries + 1):
        try:
            with (opener or urllib.request.urlopen)(urllib.request.Request(url, headers={"User-Agent": "barloom"}), timeout=timeout) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            if e.code == 404:
                raise FileNotFoundError(url) from e
            reason = e
        except (urllib.error.URLError, TimeoutError, OSError) as e:
            reason = e
        if attempt < retries:
            sleep(min(2.0 ** (attempt + 1), 8.0))
    raise TransientError(f"{url}: {reason}")


def list_pages(endpoint: str, prefix: str, get: Callable[[str], bytes] = http_get) -> Iterator[tuple[str, int | None]]:
    """(key, size) of the objects under a prefix, and (prefix, None) of the folders, of an S3-style XML listing, page by page."""
    marker = ""
    while True:
        root = ET.fromstring(get(f"{endpoint}?{urllib.parse.urlencode({'delimiter': '/', 'prefix': prefix, 'marker': marker})}"))
        ns = root.tag.partition("}")[0] + "}" if root.tag.startswith("{") else ""
        last = ""
        for node in root.iter(f"{ns}Contents"):
            last = node.findtext(f"{ns}Key", "")
            yield last, int(node.findtext(f"{ns}Size", "0"))
        for node in root.iter(f"{ns}CommonPrefixes"):
            yield node.findtext(f"{ns}Prefix", ""), None
        marker = root.findtext(f"{ns}NextMarker", "") or last
        if root.findtext(f"{ns}IsTruncated", "false") != "true" or not marker:
            return


class _Prefix(InputPartition):
    def __init__(self, prefix: str):
        self.prefix = prefix


class _ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.endpoint = options["endpoint"]
        self.prefixes = [p for p in options.get("prefixes", "").split(",") if p]

    def partitions(self):
        return [_Prefix(p) for p in self.prefixes]

    def read(self, partition):
        from barloom.sources.archives import http_get, list_pages

        for key, size in list_pages(self.endpoint, partition.prefix, http_get):
            yield partition.prefix, key, size


class ListingSource(DataSource):
    """spark.read.format("object_listing").option("endpoint", ...).option("prefixes", "a/,b/"): a task a prefix."""

    @classmethod
    def name(cls):
        return "object_listing"

    def schema(self):
        return "prefix string, key string, size long"

    def reader(self, schema):
        return _ListingReader(self.options)


def catalog_records(listed: DataFrame, source: str, symbol: str, interval: str, raw_root: str, discovered_at: str) -> DataFrame:
    """The archive records of one symbol from its listing (key, size): zips with their period, checksum object and local paths. A zip whose name doesn't follow SYMBOL-INTERVAL-PERIOD.zip raises when run."""
    from barloom.operators.catalog import period_of, with_checksums

    zips = with_checksums(listed.where("size is not null"))
    name = F.regexp_extract("key", r"([^/]+)$", 1)
    period = period_of(name, F.lit(symbol), F.lit(interval))
    period = F.when(period.isNull(), F.raise_error(F.concat(F.lit("unexpected archive name: "), name))).otherwise(period)
    local = lambda n: F.concat_ws("/", F.lit(raw_root.rstrip("/")), F.lit(source), F.lit(symbol), n)
    sums = F.concat(name, F.lit(".CHECKSUM"))
    return zips.select(F.lit(symbol).alias("symbol"), F.lit(interval).alias("interval"), F.lit(source).alias("archive_package_source"), period.alias("archive_period"), name.alias("zip_name"), sums.alias("checksum_name"), F.col("key").alias("source_path"), F.concat("key", F.lit(".CHECKSUM")).alias("source_checksum_path"), local(name).alias("local_zip_path"), local(sums).alias("local_checksum_path"), F.col("size").alias("remote_size"), F.col("has_checksum").alias("has_remote_checksum"), F.lit(discovered_at).alias("discovered_at"))


def split_symbols(text: str) -> list[str]:
    """Symbols from a text: a JSON array, or words between commas and white space with # comments; upper case, each once, in order. 'all' stays as the only one."""
    import json
    import re

    if text.lstrip().startswith("["):
        words = [str(x) for x in json.loads(text)]
    else:
        words = re.split(r"[,\s]+", "\n".join(line.partition("#")[0] for line in text.splitlines()))
    out = list(dict.fromkeys(w.strip().upper() for w in words if w.strip()))
    return ["all"] if out == ["ALL"] else out


def archive_symbols(monthly: DataFrame, daily: DataFrame, limit: int = 0) -> DataFrame:
    """The symbols of two listings of folders (key like .../SYMBOL/), each once, in order; the first `limit` if given."""
    name = F.regexp_extract("key", r"([^/]+)/$", 1).alias("symbol")
    out = monthly.select(name).union(daily.select(name)).where("symbol <> ''").distinct().orderBy("symbol")
    return out.limit(limit) if limit else out


def download(records: DataFrame, base: str, retries: int = 3) -> DataFrame:
    """Fetches the archives of catalog records and their checksums in parallel; returns the records with download_status, checksum_status, file_size and retry_count.

    A record decided as skip is skipped_daily_overlap; an archive whose file is there and fits its checksum is not fetched again (skipped_existing_verified). local_zip_path and local_checksum_path lie on a file system that all executors share (spark.checkpoint.dir names one), in any notation Arrow reads. Files are put in place by a rename after the checksum held, so a task that runs twice does no harm. A missing archive or checksum, and one that doesn't fit, are statuses, not errors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import uuid

        from pyarrow import fs

        def there(p: str) -> bytes | None:
            system, place = arrow_place(p)
            if system.get_file_info(place).type == fs.FileType.NotFound:
                return None
            with system.open_input_stream(place) as f:
                return f.read()

        def put(p: str, content: bytes) -> None:
            system, place = arrow_place(p)
            system.create_dir(place.rpartition("/")[0], recursive=True)
            tmp = f"{place}.{uuid.uuid4().hex}.tmp"
            with system.open_output_stream(tmp) as f:
                f.write(content)
            system.move(tmp, place)

        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                z, c = r.local_zip_path, r.local_checksum_path
                if r.download_decision == "skip":
                    rows.append(("skipped_daily_overlap", "not_attempted", None, 0))
                    continue
                if (said := there(c)) is not None and (data := there(z)) is not None:
                    words = said.decode().split()
                    if words and hashlib.sha256(data).hexdigest() == words[0].lower():
                        rows.append(("skipped_existing_verified", "skipped_existing_verified", len(data), 0))
                        continue
                tries = [0]
                status = "missing_zip"
                try:
                    pause = lambda s: (tries.__setitem__(0, tries[0] + 1), time.sleep(s))  # noqa: E731,B023
                    data = http_get(f"{base.rstrip('/')}/{urllib.parse.quote(r.source_path)}", retries=retries, sleep=pause)
                    status = "missing_checksum"
                    text = http_get(f"{base.rstrip('/')}/{urllib.parse.quote(r.source_checksum_path)}", retries=retries, sleep=pause).decode()
                    if (text.split() or [""])[0].lower() != hashlib.sha256(data).hexdigest():
                        rows.append(("failed", "failed", len(data), tries[0]))
                        continue
                    put(z, data)
                    put(c, text.encode())
                    rows.append(("downloaded", "passed", len(data), tries[0]))
                except FileNotFoundError:
                    rows.append(("failed", status, None, tries[0]))
                except TransientError:
                    rows.append(("failed", "download_failed", None, tries[0]))
            out = pd.DataFrame(rows, columns=["download_status", "checksum_status", "file_size", "retry_count"], index=b.index).astype({"file_size": "Int64"})
            yield pd.concat([b, out], axis=1)

    ship(records.sparkSession)
    rows = records.drop("download_status", "checksum_status", "file_size", "retry_count")
    shape = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", download_status string, checksum_status string, file_size long, retry_count int"
    return spread(rows, "source_path").mapInPandas(run, shape)
