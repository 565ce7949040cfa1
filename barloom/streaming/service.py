"""What a live service does on start and in between: bring the dataset up, plan, fetch what is missing, and fall back on the API for silent streams."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.continuity import backfill_plan, stale_streams
from barloom.session import ship
from barloom.sources.lake import ensure_current, read_bars
from barloom.sources.rest import BarsApi, ranges_of
from barloom.streaming.router import Router, backfill


def fetch_answers(spark: SparkSession, plan: DataFrame, base: str, limit: int = 1500) -> DataFrame:
    """Rows of the API for every series of a plan that lacks bars."""
    ship(spark)
    spark.dataSource.register(BarsApi)
    return spark.read.format("bars_api").option("base", base).option("limit", str(limit)).option("ranges", ranges_of(plan)).load()


def run_once(spark: SparkSession, root: str, seed: str | None, wanted: DataFrame, interval: str, now_ms: int, batch: int, base: str, lag_ms: int = 2000, fetch: Callable = fetch_answers) -> dict:
    """One start: missing symbols from the seed first, then the plan, then the pages and their merge. A ban by the server (418) stops it; bars fetched so far stay unmerged until the next start."""
    current = f"{root}/current/{interval}"
    wanted = wanted.where(F.col("interval") == interval)
    state = {}
    if seed is not None:
        state["init"] = ensure_current(spark, seed, current, [r[0] for r in wanted.select("symbol").distinct().collect()])
    router = Router(spark, root, "rest", lag_ms)
    plan = backfill_plan(wanted, router.state().where(F.col("interval") == interval), read_bars(spark, current), now_ms, lag_ms)
    state["plan"] = {r[0]: r[1] for r in plan.groupBy("status").count().collect()}
    if state["plan"].get("missing"):
        state["pages"] = backfill(spark, root, fetch(spark, plan, base), now_ms, batch)
    return state


def stale_fallback(spark: SparkSession, root: str, wanted: DataFrame, interval: str, now_ms: int, batch: int, base: str, multiplier: int = 3, fetch: Callable = fetch_answers) -> dict:
    """run_once() for the series whose stream has been silent for multiplier intervals, by the latest bars of the router."""
    latest = Router(spark, root, "websocket").latest()
    if latest is None:
        seen = spark.createDataFrame([], "symbol string, interval string, message_ms long")
    else:
        seen = latest.select("symbol", "interval", F.col("open_time").alias("message_ms"))
    stale = stale_streams(wanted.where(F.col("interval") == interval), seen, now_ms, multiplier)
    names = [tuple(r) for r in stale.select("symbol", "interval").collect()]
    if not names:
        return {"stale": 0}
    return {"stale": len(names)} | run_once(spark, root, None, spark.createDataFrame(names, "symbol string, interval string"), interval, now_ms, batch, base, fetch=fetch)


def stream_groups(symbols: list[str], interval: str, most: int = 1024) -> list[list[str]]:
    """Names of streams in groups of at most `most` for one connection each."""
    names = [f"{s.lower()}@kline_{interval}" for s in dict.fromkeys(symbols)]
    return [names[i : i + most] for i in range(0, len(names), most)]


def connection_due(connected_ms: int, now_ms: int, hours: float = 23) -> bool:
    """Whether a connection is old enough to be made anew."""
    return now_ms - connected_ms >= hours * 3_600_000


def repair(spark: SparkSession, root: str, seed: str | None, wanted: DataFrame, interval: str, now_ms: int, base: str, fetch: Callable = fetch_answers) -> dict:
    """One round of the service: what a start does, then the series whose stream is silent. Batches of the API are numbered by the clock, so a round that is run again after a crash has a number of its own."""
    batch = int(now_ms)
    out = run_once(spark, root, seed, wanted, interval, now_ms, batch, base, fetch=fetch)
    return out | {"fallback": stale_fallback(spark, root, wanted, interval, now_ms, batch + 1, base, fetch=fetch)}


def reconnecting(connect: Callable[[], object], attempts: int = 5, base_s: float = 1, most_s: float = 60, sleep: Callable = time.sleep):
    """What connect() gives; a failed attempt is made again after base_s * 2^n seconds, at most most_s."""
    for n in range(attempts):
        try:
            return connect()
        except OSError:
            if n == attempts - 1:
                raise
            sleep(min(most_s, base_s * 2**n))


def serve(spark: SparkSession, root: str, seed: str | None, wanted: DataFrame, interval: str, base: str, inbox, server, rounds: int = 0, every: float = 10, fetch: Callable = fetch_answers, clock: Callable[[], int] | None = None) -> dict:
    """The live service: the server's webhooks fill the inbox, every `every` seconds it is flushed and streamed into the datasets, then gaps and silent series are repaired through the API. The stream and the repairs take turns in this thread, so the datasets have one writer. rounds: how many; 0 for no end. Returns the counts of the last round."""
    now = clock or (lambda: int(time.time() * 1000))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    out: dict = {}
    n = 0
    try:
        while not rounds or n < rounds:
            inbox.flush()
            router = Router(spark, root, "webhook")
            rows = spark.readStream.schema("payload string, received_ms long, arrival long").json(f"{root}/in")
            router.run(rows).awaitTermination()
            out = repair(spark, root, seed, wanted, interval, now(), base, fetch)
            n += 1
            if not rounds or n < rounds:
                time.sleep(every)
    finally:
        server.shutdown()
        inbox.flush()
    return {"rounds": n, "last": out}
