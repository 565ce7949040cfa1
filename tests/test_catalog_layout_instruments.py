import hashlib
import json

import pytest
from pyspark.sql import functions as F

from barloom import report
from barloom.operators import catalog, instruments, layout, resample


def test_classify_and_summaries(spark):
    shape = "symbol string, archive_package_source string, archive_period string, download_status string, checksum_status string, file_size long"
    rows = [("A", "monthly", "2024-02", "downloaded", "passed", 5), ("A", "daily", "2024-02-03", "skipped_daily_overlap", "not_attempted", None), ("A", "daily", "2024-03-01", "downloaded", "failed", 7), ("B", "daily", "2024-02-03", "failed", "download_failed", None)]
    df = spark.createDataFrame(rows, shape)
    c = catalog.classify(df, ["symbol"])
    assert {(r.symbol, r.archive_period): (r.covered_by_monthly, r.daily_status, r.download_decision) for r in c.collect()} == {("A", "2024-02"): (None, None, "download"), ("A", "2024-02-03"): (True, "skipped_by_default", "skip"), ("A", "2024-03-01"): (False, "required_delta", "download"), ("B", "2024-02-03"): (False, "required_delta", "download")}
    assert catalog.classify(df, ["symbol"], full_history=True).where("download_decision = 'skip'").count() == 0
    s = catalog.discovery_summary(c, ["symbol"]).where("symbol = 'A'").first()
    assert (s.files, s.monthly_files, s.required_delta, s.date_min, s.date_max) == (3, 1, 1, "2024-02-01", "2024-03-01")
    p = catalog.process_summary(df, gap_cap=1).first()
    assert (p.files, p.verified, p.checksum_failed, p.total_bytes, p.gaps) == (4, 1, 1, 12, 2) and p.known_gaps == ["A 2024-03-01 (daily): failed", "... and 1 more"] and p.date_max == "2024-03-01"
    assert catalog.gap_files(df).count() == 2 and catalog.verified_archives(df).count() == 1
    keys = spark.createDataFrame([("a/x.zip", 1), ("a/x.zip.CHECKSUM", 1), ("a/y.zip", 1), ("a/", None)], "key string, size long")
    assert {r.key: r.has_checksum for r in catalog.with_checksums(keys).collect()} == {"a/x.zip": True, "a/y.zip": False}
    assert catalog.missing_from(df.select("symbol"), df.select("symbol").where("symbol = 'A'"), ["symbol"]).collect()[0][0] == "B"
    ok = spark.createDataFrame([(bytearray(b"abc"), hashlib.sha256(b"abc").hexdigest().upper() + "  x.zip\n")], "c binary, t string")
    assert ok.select(catalog.checksum_holds(F.col("c"), F.col("t"))).first()[0]


def test_layout(spark):
    rows = [("A", "x/symbol=A/year=2024/part-0.parquet", 0), ("A", "x/symbol=A/year=2024/part-0.parquet", 0), ("B", "x/symbol=B/year=2024/month=01/p.parquet", 1), ("B", "x/symbol=B/year=2024/p.parquet", 2), ("C", "x/symbol=C/year=2024/month=01/p.parquet", 3), ("D_240329", "x/symbol=D_240329/year=2024/p.parquet", 3)]
    df = spark.createDataFrame(rows, "symbol string, path string, open_time long")
    checks = layout.precheck(df)
    assert {r.symbol: (r.status, r.row_count, r.duplicates) for r in checks.collect()} == {"A": ("year_only_needs_migration", 2, 1), "B": ("mixed_layout_needs_migration", 2, 0), "C": ("no_migration_needed", 1, 0), "D_240329": ("year_only_needs_migration", 1, 0)}
    found = layout.with_reason(layout.candidates(checks, include_mixed=True), [], [], ["USDT"], [])
    assert {r.symbol: r.reason for r in found.collect()} == {"A": None, "B": "mixed_layout", "D_240329": "delivery_contract"}
    assert layout.batches(found, 1, 3).collect()[0].symbol == "A"
    assert [r.symbol for r in layout.candidates(checks, limit=1).collect()] == ["D_240329"]
    paths = spark.createDataFrame([("r/symbol=ab/year=1/x",), ("r/symbol=a.__backup_migrate_1/x",), ("r/other/x",), ("r/symbol=%E7%81%B5/x",)], "p string")
    assert [r[0] for r in paths.select(layout.symbol_of(F.col("p"))).collect()] == ["AB", None, None, "灵"]


META = "meta_row_id long, instrument_id string, symbol string, exchange string, base_asset string, quote_asset string, market_type string, contract_type string, status string, listed_at string, delisted_at string, successor_id string, tick_size string, step_size string, contract_size string"


def meta(i, name, **over):
    row = {"symbol": "S", "exchange": "x", "base_asset": "B", "quote_asset": "Q", "market_type": "perpetual", "contract_type": "linear", "status": "active", "listed_at": "2024-01-01T00:00:00Z", "delisted_at": None, "successor_id": None, "tick_size": "0.1", "step_size": "1", "contract_size": "1"} | over
    return (i, name, *row.values())


def test_instrument_rules(spark):
    rows = [meta(1, "a"), meta(2, "b", status="active", delisted_at="2023-01-01T00:00:00Z"), meta(3, "c", market_type="spot"), meta(4, "d", tick_size="Infinity", step_size="-1"), meta(5, None, status="gone", successor_id="z")]
    got = {(r.id, r.rule_id, r.field) for r in instruments.record_rules(spark.createDataFrame(rows, META), "meta_row_id").collect()}
    assert got == {(2, "UM-Q3", "delisted_at"), (2, "UM-Q4", "delisted_at"), (3, "UM-Q5", "contract_type"), (3, "UM-Q5", "contract_size"), (4, "UM-Q5", "step_size"), (5, "UM-Q1", "instrument_id"), (5, "UM-Q3", "status"), (5, "UM-Q3", "delisted_at"), (5, "UM-Q3", "successor_id")}


def test_graph_and_eras(spark):
    t = "2024-06-01T00:00:00Z"
    rows = [meta(1, "a", successor_id="b", status="renamed", delisted_at=t), meta(2, "b", successor_id="c", listed_at=t), meta(3, "c"), meta(4, "x", successor_id="y"), meta(5, "y", successor_id="z"), meta(6, "z", successor_id="y"), meta(7, "q", successor_id="q"), meta(8, "r", successor_id="lost", status="renamed")]
    df = spark.createDataFrame(rows, META)
    assert {r.instrument_id: (r.last_id, r.steps, r.cycle) for r in instruments.successor_ends(df).collect()} == {"a": ("c", 2, False), "b": ("c", 1, False), "x": (None, None, True), "y": (None, None, True), "z": (None, None, True), "q": (None, None, True)}
    assert {(r.instrument_id, r.reason) for r in instruments.missing_successors(df).collect()} == {("q", "self-reference"), ("r", "missing successor")}
    assert {r[0] for r in instruments.rename_breaks(df).collect()} == {"r"}
    long = spark.createDataFrame([meta(i, f"n{i:04d}", successor_id=f"n{i + 1:04d}") for i in range(300)], META)
    assert instruments.successor_ends(long).where("instrument_id = 'n0000'").first().steps == 299
    assert instruments.successor_ends(df.limit(0)).count() == 0
    eras = spark.createDataFrame([meta(1, "a", delisted_at=t), meta(2, "b", listed_at="2024-03-01T00:00:00Z", delisted_at="2024-04-01T00:00:00Z"), meta(3, "c", listed_at=t), meta(4, "d", listed_at="2024-07-01T00:00:00Z")], META)
    assert {r.record for r in instruments.era_overlaps(eras, "meta_row_id").collect()} == {2, 4}
    assert instruments.universe_at(eras, 1_717_200_000_000).select("instrument_id").collect()[0][0] == "c"
    again = spark.createDataFrame([meta(1, "a"), meta(2, "a", symbol="T"), meta(3, "b", listed_at=t)], META)
    assert {(r.kind, r.record, r.first_record) for r in instruments.uniqueness(again, "meta_row_id").collect()} == {("instrument_id", 2, 1), ("active_symbol", 3, 1)}


def test_snapshot(spark):
    size = lambda t, k, v: {"filterType": t, "tickSize": v if k == "tickSize" else None, "stepSize": v if k == "stepSize" else None}
    s = [{"symbol": "ABUSDT", "contractType": "PERPETUAL", "status": "TRADING", "baseAsset": "AB", "quoteAsset": "USDT", "onboardDate": 1_704_067_200_000, "filters": [size("LOT_SIZE", "stepSize", "0.1"), size("PRICE_FILTER", "tickSize", "0.01")]}, {"symbol": "OLD", "contractType": "PERPETUAL", "status": "SETTLING", "baseAsset": "", "quoteAsset": "", "onboardDate": 0, "filters": []}, {"symbol": "AB-USDT", "contractType": "CURRENT_QUARTER", "status": "TRADING", "baseAsset": "", "quoteAsset": "USDT", "onboardDate": 1_704_067_200_000, "filters": []}]
    shape = "retrieved_at string, symbols array<struct<symbol:string,contractType:string,status:string,baseAsset:string,quoteAsset:string,onboardDate:long,filters:array<struct<filterType:string,tickSize:string,stepSize:string>>>>"
    df = spark.createDataFrame([("2024-06-01T00:00:00Z", s)], shape)
    got = {r.symbol: r for r in instruments.normalize_snapshot(df, "x", "x.futures").collect()}
    assert set(got) == {"ABUSDT", "AB-USDT"} and got["ABUSDT"].instrument_id == "x.futures.perpetual.abusdt.20240101" and (got["ABUSDT"].tick_size, got["ABUSDT"].step_size, got["AB-USDT"].tick_size) == ("0.01", "0.1", None) and got["AB-USDT"].base_asset is None
    assert [r[0] for r in instruments.tradable_symbols(df, "USDT").collect()] == ["ABUSDT"]
    with pytest.raises(Exception, match="listed after"):
        instruments.normalize_snapshot(spark.createDataFrame([("2023-06-01T00:00:00Z", s)], shape), "x", "x").collect()
    twin = spark.createDataFrame([("i", "灵A", "t1"), ("i", 'B"', "t0"), ("j", "C", "t")], "instrument_id string, symbol string, listed_at string")
    ids = {r.symbol: r.instrument_id for r in instruments.collision_suffixes(twin, ["listed_at"]).collect()}
    canon = json.dumps({"base_id": "i", "listed_at": "t1", "ordinal": 2, "symbol": "灵A"}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert ids["C"] == "j" and ids["灵A"] == "i.h" + hashlib.sha256(canon.encode()).hexdigest()[:8] and ids['B"'].startswith("i.h")


def test_resample(spark):
    ticks = spark.createDataFrame([("A", 5, 1, 3.0, 1.0), ("A", 5, 2, 4.0, 1.0), ("A", 59_000, 3, 1.0, 2.0), ("A", 60_000, 4, 9.0, 1.0), (None, 1, 1, 1.0, 1.0), ("A", -1, 1, 7.0, 1.0)], "symbol string, time_ms long, seq long, price double, size double")
    got = {r.open_time: (r.open, r.high, r.low, r.close, r.volume, r.trade_count) for r in resample.bars_from_ticks(ticks, "1m").collect()}
    assert got == {0: (3.0, 4.0, 1.0, 1.0, 4.0, 3), 60_000: (9.0,) * 4 + (1.0, 1), -60_000: (7.0,) * 4 + (1.0, 1)}
    five = resample.coarser(resample.bars_from_ticks(ticks, "1m"), "5m").where("open_time = 0").first()
    assert (five.open, five.close, five.parts, five.close_time) == (3.0, 9.0, 2, 299_999)


def test_report(spark):
    names = spark.createDataFrame([("good_id",), ("good_id\n",), ("Bad",), (None,)], "n string")
    assert [r[0] for r in names.select(report.matches(F.col("n"), "dataset_id")).collect()] == [True, False, False, False]
    failures = spark.createDataFrame([("R1", "f", "bad", "records[3]")], "rule string, field string, why string, at string")
    checks = report.as_checks(failures, F.col("rule"), F.col("why"), F.col("field"), F.col("at"), "d")
    assert {r.rule_id: r.status for r in report.verdicts(checks, ["R1", "R2"]).collect()} == {"R1": "failed", "R2": "passed"}
    assert report.counters(checks).first().has_failures and not report.counters(checks.limit(0)).first().has_failures
    reg = spark.createDataFrame([("a", ["b", "c"]), ("b", [])], "dataset_id string, upstreams array<string>")
    assert [tuple(r) for r in report.missing_upstreams(reg).collect()] == [("a", "c")]


@pytest.mark.parametrize(("change", "rule"), [({}, None), ({"instrument_id": "a"}, "UM-Q2"), ({"status": "active", "delisted_at": "2024-06-01T00:00:00Z"}, "UM-Q3"), ({"status": "delisted", "delisted_at": "2019-01-01T00:00:00Z"}, "UM-Q4"), ({"contract_size": "0"}, "UM-Q5"), ({"status": "merged", "delisted_at": "2024-06-01T00:00:00Z", "successor_id": "lost"}, "UM-Q6"), ({"symbol": "SA"}, "UM-PIT")])
def test_universe_file(spark, tmp_path, change, rule):
    rec = lambda n, **o: {"instrument_id": n, "symbol": f"S{n.upper()}", "exchange": "x", "base_asset": "B", "quote_asset": "Q", "market_type": "perpetual", "contract_type": "linear", "status": "active", "listed_at": "2024-01-01T00:00:00Z", "delisted_at": None, "successor_id": None, "tick_size": "0.1", "step_size": "1", "contract_size": "1"} | o
    b = rec("b") | change
    if rule == "UM-PIT":
        b |= {"listed_at": "2023-01-01T00:00:00Z", "status": "delisted", "delisted_at": "2024-03-01T00:00:00Z"}
    (tmp_path / "u.json").write_text(json.dumps({"ingestion_time": "2025-01-01T00:00:00Z", "records": [rec("a"), b]}))
    got = {r.rule_id: r.status for r in instruments.universe_verdicts(instruments.read_records(spark, str(tmp_path / "u.json"))).collect()}
    assert len(got) == 7 and {k for k, v in got.items() if v == "failed"} - ({"UM-Q2"} if rule == "UM-PIT" else set()) == ({rule} if rule else set()) or (rule == "UM-Q2" and got["UM-Q2"] == "failed")


def test_universe_file_shapes(spark, tmp_path):
    (tmp_path / "bare.json").write_text('[{"instrument_id": "a", "tick_size": 0.5}]')
    r = instruments.read_records(spark, str(tmp_path / "bare.json")).first()
    assert (r.record, r.instrument_id, r.tick_size, r.symbol) == (0, "a", "0.5", None)
    for text in ("{", "3", '{"x": 1}'):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(ValueError):
            instruments.read_records(spark, str(tmp_path / "bad.json"))
    files = spark.createDataFrame([("A", "r/symbol=A/year=1/p"), ("A", "r/symbol=A/year=1/month=01/p"), (None, "r/symbol=A.__backup_migrate_1/year=1/p")], "symbol string, path string")
    assert [r.path for r in layout.year_only(files).collect()] == ["r/symbol=A/year=1/p"]
