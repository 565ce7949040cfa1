"""Commands: python -m barloom.cli COMMAND ... Prints JSON. Exit codes: 0 done, 1 the data failed, 2 a wrong command."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import functions as F

from barloom.intervals import UnknownInterval, expand_intervals
from barloom.operators import continuity, instruments, layout, quality, validation
from barloom.report import counters
from barloom.session import default_cpus, scope, session
from barloom.sources import archives, ingest, lake, snapshots
from barloom.sources.materialize import StrictError, materialize, read_manifest
from barloom.streaming import endpoint, service
from barloom.streaming.router import Router


def _rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _materialize(spark, a) -> tuple[dict, int]:
    """Verified archives of a file manifest to a seed dataset."""
    try:
        return materialize(spark, archives.work_units(spark, a.files, a.raw), a.out, a.interval, a.strict, a.resume), 0
    except StrictError as e:
        return {"strict": json.loads(str(e))}, 1


def _validate(spark, a) -> tuple[dict, int]:
    bars = lake.read_bars(spark, a.root, current=a.current)
    counts = _rows(quality.fused_counts(bars, ["interval"]))
    twice = _rows(quality.duplicate_keys(bars, ["symbol", "interval", "open_time"], ["interval"]).where("duplicated > 0"))
    failed = bool(twice) or any(r[k] for r in counts for k in ("null_rows", "ohlc_bad", "date_bad", "misaligned", "close_bad"))
    return {"counts": counts, "duplicates": twice, "ok": not failed}, int(failed)


def _continuity(spark, a) -> tuple[dict, int]:
    out = continuity.continuity(lake.read_bars(spark, a.root, archives.split_symbols(a.symbols) or None), a.now_ms or int(time.time() * 1000))
    rows = _rows(out)
    return {"overall_status": "empty" if not rows else "gap_detected" if any(r["status"] == "gap_detected" for r in rows) else "ok", "series": rows}, 0


def _audit(spark, a) -> tuple[dict, int]:
    rows = _rows(layout.audit(lake.list_files(spark, a.root).where("symbol is not null")))
    return {"symbols": rows, "status": "mixed_layout_detected" if any(r["mixed"] for r in rows) else "ok"}, 0


def _migrate(spark, a) -> tuple[dict, int]:
    done = [lake.migrate_symbol(spark, a.root, s, a.execute) for s in archives.split_symbols(a.symbols)]
    return {"symbols": done}, int(any(d["status"] in ("verification_failed", "promotion_failed", "restored", "source_parquet_unreadable") for d in done))


def _init(spark, a) -> tuple[dict, int]:
    return {"status": lake.ensure_current(spark, a.seed, a.root, archives.split_symbols(a.symbols) or None)}, 0


def _probe(spark, a) -> tuple[dict, int]:
    bad = _rows(lake.probe_files(spark, a.root).where("not readable"))
    return {"unreadable": bad}, int(bool(bad))


def _verdict(checks) -> tuple[dict, int]:
    rows, n = _rows(checks.where("status <> 'passed'").orderBy("rule_id", "field")), counters(checks).first().asDict()
    return {"counters": n, "not_passed": rows}, int(n["has_failures"])


def _discover(spark, a) -> tuple[dict, int]:
    """Lists the archives of an interval and writes their catalog."""
    return ingest.discover(spark, a.endpoint, a.base, a.interval, a.raw, a.out, archives.split_symbols(a.symbols) or None, a.full_history), 0


def _plan(spark, a) -> tuple[dict, int]:
    """What a catalog would download."""
    return ingest.plan(spark, a.out), 0


def _download(spark, a) -> tuple[dict, int]:
    """Downloads and verifies what a catalog decides on."""
    out = ingest.fetch(spark, a.url, a.out, a.dataset, a.interval)
    return out, int(out["failed"] > 0)


def _verify(spark, a) -> tuple[dict, int]:
    """Checks downloaded archives anew."""
    out = ingest.verify(spark, a.out)
    return out, int(any(k not in ("passed",) for k in out["checksums"]) or out["unlisted"] > 0)


def _check_archives(spark, a) -> tuple[dict, int]:
    """Rules about the manifest of downloaded archives."""
    return _verdict(validation.archive_checks(spark, a.manifest, a.interval, a.dataset))


def _check_dataset(spark, a) -> tuple[dict, int]:
    """Rules about a materialised dataset: its manifest, its files and its rows."""
    m = read_manifest(spark, a.root)
    checks = validation.manifest_checks(spark, a.root, m, a.interval, archives.split_symbols(a.symbols) or None)
    if m is not None:
        checks = checks.unionByName(validation.dataset_checks(spark, lake.read_bars(spark, a.root, current=False), lake.list_files(spark, a.root), m, m["dataset_id"]))
    return _verdict(checks)


def _check_names(spark, a) -> tuple[dict, int]:
    """Rules about the names in a dataset registry."""
    registry = spark.read.schema(validation.REGISTRY).option("multiLine", "true").json(a.registry)
    return _verdict(validation.naming_checks(registry, a.registry))


def _universe(spark, a) -> tuple[dict, int]:
    """An exchange's answer, from a file, kept as a snapshot and made instrument records, which are judged by all rules."""
    with open(a.answer, encoding="utf-8") as f:
        name = snapshots.store(spark, f"{a.root}/raw", json.load(f), a.at)
    records = instruments.normalize_snapshot(snapshots.load(spark, f"{a.root}/raw", name), a.exchange, a.exchange)
    records.coalesce(1).write.mode("overwrite").json(f"{a.root}/records")
    ranked = records.withColumns({"record": F.monotonically_increasing_id(), "ingestion_time": F.lit(a.at)})
    rules = _rows(instruments.universe_verdicts(ranked))
    return {"snapshot": name, "records": records.count(), "rules": rules}, int(any(r["failures"] for r in rules))


def _precheck(spark, a) -> tuple[dict, int]:
    """The layout of each symbol of a dataset, which of them need a migration, and in which batches."""
    files = lake.list_files(spark, a.root).where("symbol is not null")
    raw = spark.read.option("recursiveFileLookup", "true").parquet(a.root).select("open_time", F.col("_metadata.file_path").alias("path"))
    checks = layout.precheck(raw.select(layout.symbol_of(F.col("path")).alias("symbol"), "path", "open_time"))
    todo = layout.with_reason(layout.candidates(checks, include_mixed=True), archives.split_symbols(a.leave_out), [], [], [])
    planned = layout.batches(todo, a.batch_size or 5, a.batches or 4)
    return {"files": files.count(), "symbols": _rows(checks), "left_out": _rows(todo.where("reason is not null").select("symbol", "reason")), "batches": _rows(planned), "totals": _rows(layout.batch_totals(planned))}, 0


def _wanted(spark, a):
    return spark.createDataFrame([(s, a.interval) for s in archives.split_symbols(a.symbols)], "symbol string, interval string")


def _live_once(spark, a) -> tuple[dict, int]:
    """One round of the live service: start, gap repair and silent streams through the API."""
    return service.repair(spark, a.root, a.seed or None, _wanted(spark, a), a.interval, a.now_ms or int(time.time() * 1000), a.api), 0


def _live_plan(spark, a) -> tuple[dict, int]:
    """What a start of the live service would fetch."""
    state = Router(spark, a.root, "rest").state().where(F.col("interval") == a.interval)
    out = continuity.backfill_plan(_wanted(spark, a), state, lake.read_bars(spark, f"{a.root}/current/{a.interval}"), a.now_ms or int(time.time() * 1000))
    return {"plan": _rows(out)}, 0


def _serve(spark, a) -> tuple[dict, int]:
    """Takes webhooks into a stream, repairs gaps in between, until the given rounds are over (0: never)."""
    inbox = endpoint.Inbox(f"{a.root}/in")
    server = endpoint.serve(inbox, port=a.port or 0)
    return service.serve(spark, a.root, a.seed or None, _wanted(spark, a), a.interval, a.api, inbox, server, a.rounds or 0, a.every or 10), 0


COMMANDS = {
    "discover": (_discover, ["--endpoint!", "--base!", "--interval!", "--raw!", "--out!", "--symbols", "--full-history?"]),
    "plan": (_plan, ["--out!"]),
    "download": (_download, ["--url!", "--out!", "--dataset!", "--interval!"]),
    "verify": (_verify, ["--out!"]),
    "check-archives": (_check_archives, ["--manifest!", "--interval!", "--dataset!"]),
    "check-dataset": (_check_dataset, ["--root!", "--interval!", "--symbols"]),
    "check-names": (_check_names, ["--registry!"]),
    "universe": (_universe, ["--answer!", "--root!", "--at!", "--exchange!"]),
    "precheck-layout": (_precheck, ["--root!", "--leave-out", "--batch-size#", "--batches#"]),
    "live-plan": (_live_plan, ["--root!", "--interval!", "--symbols!", "--now-ms#"]),
    "live-once": (_live_once, ["--root!", "--interval!", "--symbols!", "--api!", "--seed", "--now-ms#"]),
    "serve": (_serve, ["--root!", "--interval!", "--symbols!", "--api!", "--seed", "--port#", "--rounds#", "--every#"]),
    "materialize": (_materialize, ["--interval!", "--files!", "--raw!", "--out!", "--strict?", "--resume?"]),
    "validate": (_validate, ["--root!", "--current?"]),
    "continuity": (_continuity, ["--root!", "--symbols", "--now-ms#"]),
    "audit-layout": (_audit, ["--root!"]),
    "migrate-layout": (_migrate, ["--root!", "--symbols!", "--execute?"]),
    "init-current": (_init, ["--seed!", "--root!", "--symbols"]),
    "probe": (_probe, ["--root!"]),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="barloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        c = sub.add_parser(name, help=f.__doc__)
        for o in options:
            if o.endswith("?"):
                c.add_argument(o[:-1], action="store_true")
            elif o.endswith("#"):
                c.add_argument(o[:-1], type=int)
            else:
                c.add_argument(o.rstrip("!"), required=o.endswith("!"), default=None if o.endswith("!") else "")
    return p


def main(argv: list[str] | None = None) -> int:
    try:
        a = parser().parse_args(argv)
        if getattr(a, "interval", None):
            expand_intervals(a.interval)
    except (SystemExit, UnknownInterval) as e:
        return 2 if not isinstance(e, SystemExit) or e.code else 0
    spark = session("cli", default_cpus())
    with scope(spark):  # a command's results are collected or written when it ends
        out, code = COMMANDS[a.command][0](spark, a)
    print(json.dumps(out, default=str, ensure_ascii=False))
    return code


if __name__ == "__main__":
    sys.exit(main())
