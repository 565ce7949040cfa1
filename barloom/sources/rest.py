"""A paged bars API as a data source, with its answers to errors."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barloom.intervals import interval_ms


class StopRequests(RuntimeError):
    """The server banned this client; no further request may be sent."""


@dataclass
class Page:
    status: str
    rows: list = field(default_factory=list)
    http_status: int | None = None
    error: str | None = None


def page_url(base: str, path: str, symbol: str, interval: str, start: int | None, end: int | None, limit: int) -> str:
    interval_ms(interval)
    if symbol.lower() == "all":
        raise ValueError("'all' must be resolved to symbols first")
    ask = {"symbol": symbol.upper(), "interval": interval, "limit": limit} | ({"startTime": start} if start is not None else {}) | ({"endTime": end} if end is not None else {})
    return f"{base.rstrip('/')}{path}?{urllib.parse.urlencode(ask)}"


def fetch(url: str, timeout: float = 15, retries: int = 5, base_s: float = 1, most_s: float = 60, opener: Callable | None = None, sleep: Callable = time.sleep) -> Page:
    """One page. 418 raises StopRequests; 429, 5xx and network failures are tried again after base_s * 2^n seconds, at most most_s; 400 and 404 that name the symbol say it isn't available; anything else is an error."""
    for attempt in range(retries + 1):
        try:
            with (opener or urllib.request.urlopen)(urllib.request.Request(url, headers={"User-Agent": "barloom"}), timeout=timeout) as r:
                rows = json.loads(r.read())
            return Page("ok", rows, 200) if isinstance(rows, list) else Page("error", http_status=200, error="the answer is not a list")
        except urllib.error.HTTPError as e:
            body = e.read().decode("utf-8", "replace") if e.fp else ""
            if e.code == 418:
                raise StopRequests(body) from e
            last = Page("retry_exhausted", http_status=e.code, error=body or str(e))
            if not (e.code == 429 or 500 <= e.code <= 599):
                gone = e.code in (400, 404) and "symbol" in body.lower()
                return Page("symbol_unavailable" if gone else "error", http_status=e.code, error=body or str(e))
        except (urllib.error.URLError, TimeoutError, OSError) as e:
            last = Page("retry_exhausted", error=str(e))
        if attempt < retries:
            sleep(min(most_s, base_s * 2**attempt))
    return last


def pages(base: str, path: str, symbol: str, interval: str, start: int, end: int, limit: int = 1500, **how) -> Iterator[Page]:
    """Pages from start to end by open_time: the next begins after the last row. Ends after a short page or one that isn't ok."""
    at, ms = start, interval_ms(interval)
    while at <= end:
        page = fetch(page_url(base, path, symbol, interval, at, end, limit), **how)
        yield page
        if page.status != "ok" or len(page.rows) < limit:
            return
        at = max(int(r[0]) for r in page.rows) + ms


class _Range(InputPartition):
    def __init__(self, symbol: str, interval: str, start: int, end: int):
        self.symbol, self.interval, self.start, self.end = symbol, interval, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.base, self.path = options["base"], options.get("path", "/v1/bars")
        self.limit = int(options.get("limit", "1500"))
        self.ranges = json.loads(options["ranges"])

    def partitions(self):
        return [_Range(*r) for r in self.ranges]

    def read(self, p):
        from barloom.sources.rest import pages

        for page in pages(self.base, self.path, p.symbol, p.interval, p.start, p.end, self.limit):
            if page.status != "ok":
                yield p.symbol, p.interval, None, page.status, page.error
            for row in page.rows:
                yield p.symbol, p.interval, json.dumps(row), "ok", None


class BarsApi(DataSource):
    """spark.read.format("bars_api").option("base", url).option("ranges", json of [symbol, interval, start, end] lists): a task a range, a row a bar, its payload for ticks.parse_rest(). A failed page gives a row without payload."""

    @classmethod
    def name(cls):
        return "bars_api"

    def schema(self):
        return "symbol string, interval string, payload string, status string, error string"

    def reader(self, schema):
        return _Reader(self.options)


def ranges_of(plan) -> str:
    """The option `ranges` for a backfill plan (continuity.backfill_plan), a row a series."""
    rows = plan.where("status = 'missing'").select("symbol", "interval", "start", "end").collect()
    return json.dumps([[r[0], r[1], r[2], r[3]] for r in rows])
