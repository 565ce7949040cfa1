"""Live bars from a stream into the current dataset: buffers, latest bars, rejects and the keyed upsert, a batch at a time."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.conflicts import last_wins
from barloom.operators.continuity import flush_state
from barloom.operators.quality import live_errors
from barloom.schema import BAR
from barloom.sources.lake import upsert_current
from barloom.storage import Files
from barloom.streaming.ticks import parse_messages, parse_rest

STATE = "symbol string, interval string, last_closed_open_time long, merged_bars long"


class Router:
    """Routes parsed payloads under one folder: buffer/ (every payload), latest/ (the last arrival of each series, valid or not), rejects/, closed/ and current/ (of each interval the keyed dataset), and state/.

    arrival orders the payloads of a batch; batches come in order of their numbers.

    Each batch first writes its logs into folders named after it, overwriting them if it runs again after a failure; upserts repeat harmlessly, since of each key the last received bar stays. Late bars are never dropped: they are put into the partition they belong to. A batch that is done is recorded, so a repeated one isn't counted twice in the state.
    """

    def __init__(self, spark: SparkSession, root: str, channel: str, lag_ms: int = 2000, strict: bool = True, monotone: bool = True):
        self.spark, self.root, self.channel, self.lag, self.strict, self.monotone = spark, root.rstrip("/"), channel, lag_ms, strict, monotone
        self.files = Files(spark, self.root)

    def parse(self, rows: DataFrame) -> DataFrame:
        """rows (payload, received_ms, arrival[, symbol, interval]) with bar, errors and status: rejected, open or closed."""
        now = F.col("received_ms")
        df = parse_rest(rows, now, self.lag) if self.channel == "rest" else parse_messages(rows, self.channel, now, self.lag)
        errors = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(live_errors(self.strict, F.col("is_closed")))
        df = df.withColumn("errors", errors)
        return df.withColumn("status", F.when(F.size("errors") > 0, "rejected").when(F.col("is_closed"), "closed").otherwise("open"))

    def _log(self, df: DataFrame, kind: str, batch: int) -> None:
        day = F.coalesce("archive_period", F.date_format(F.timestamp_millis("received_ms"), "yyyy-MM-dd"))
        cols = ["received_ms", "arrival", "status", "errors", "payload", F.struct(*BAR.fieldNames(), "is_closed").alias("record")]
        df.select(*cols, day.alias("date")).hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").json(f"{self.root}/{kind}/batch={batch}")

    def state(self) -> DataFrame:
        names = [int(n.partition("=")[2]) for n in self.files.names("state") if n.startswith("v=")]
        return self.spark.read.schema(STATE).json(f"{self.root}/state/v={max(names)}") if names else self.spark.createDataFrame([], STATE)

    def latest(self) -> DataFrame | None:
        names = [int(n.partition("=")[2]) for n in self.files.names("latest") if n.startswith("v=")]
        return self.spark.read.parquet(f"{self.root}/latest/v={max(names)}") if names else None

    def process(self, rows: DataFrame, batch: int) -> None:
        """One batch. Nothing is done for one that is recorded as done."""
        if self.files.exists("done", f"{batch}.json"):
            return
        parsed = self.parse(rows).persist()
        try:
            self._log(parsed, "buffer", batch)
            self._log(parsed.where("status = 'rejected'"), "rejects", batch)
            closed = parsed.where("status = 'closed'")
            self._log(closed, "closed", batch)
            bars = parsed.where("error is null").select(*BAR.fieldNames(), "is_closed", "errors", "arrival").withColumn("batch", F.lit(batch).cast("long"))
            old = self.latest()
            new = last_wins(bars if old is None else old.unionByName(bars), ["symbol", "interval"], ["batch", "arrival"])
            new.write.mode("overwrite").parquet(f"{self.root}/latest/v={batch}")
            merged = []
            for (interval,) in closed.select("interval").distinct().collect():
                part = closed.where(F.col("interval") == interval).select(*BAR.fieldNames(), "arrival")
                merged += [(r["symbol"], interval, r["max_open_time"], r["input_rows"]) for r in upsert_current(self.spark, f"{self.root}/current/{interval}", part)]
            done = self.spark.createDataFrame(merged, "symbol string, interval string, max_open_time long, input_rows long")
            flush_state(self.state(), done, self.monotone).coalesce(1).write.mode("overwrite").json(f"{self.root}/state/v={batch}")
            counts = {r[0]: r[1] for r in parsed.groupBy("status").count().collect()}
            self.files.write_new(json.dumps(counts), "done", f"{batch}.json")
        finally:
            parsed.unpersist()

    def run(self, stream: DataFrame, available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
        """The query that feeds the router. No watermark: late bars must not be dropped."""
        w = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.root}/checkpoint")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)).start()


def backfill(spark: SparkSession, root: str, answers: DataFrame, received_ms: int, batch: int) -> dict[str, int]:
    """Rows of a bars API (symbol, interval, payload, status) through the REST channel as one batch; failed pages are counted and change nothing, the bars of the others are merged."""
    ok = answers.where("status = 'ok'").select("symbol", "interval", "payload", F.lit(received_ms).cast("long").alias("received_ms"), F.monotonically_increasing_id().alias("arrival"))
    Router(spark, root, "rest").process(ok, batch)
    return {r[0]: r[1] for r in answers.groupBy("status").count().collect()}


def rebuild(spark: SparkSession, root: str, interval: str, target: str) -> list[dict]:
    """The current dataset of an interval made anew from the log of closed bars: the last received of each key."""
    log = spark.read.option("basePath", f"{root}/closed").json(f"{root}/closed/batch=*").where(F.col("record.interval") == interval)
    cols = [F.col(f"record.{f.name}").cast(f.dataType).alias(f.name) for f in BAR.fields]
    one = last_wins(log.select(*cols, F.col("batch").cast("long").alias("batch"), "arrival"), ["symbol", "interval", "open_time"], ["batch", "arrival"])
    return upsert_current(spark, target, one)
