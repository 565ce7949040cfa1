from pyspark.sql import functions as F

from barloom.functions.calendar import millis_of, month_partitions, with_calendar
from barloom.operators import quality
from barloom.schema import BAR

T0 = 1_577_836_800_000


def bar(**over):
    row = {"symbol": "A", "interval": "1d", "open_time": T0, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0, "close_time": T0 + 86_399_999, "quote_volume": 15.0, "trade_count": 3, "taker_buy_base_volume": 5.0, "taker_buy_quote_volume": 7.5, "source_archive": "z", "archive_source": "daily", "archive_period": "2020-01-01"} | over
    return tuple(row[f] for f in BAR.fieldNames())


def test_calendar(spark):
    df = spark.createDataFrame([(0,), (-1,), (T0 + 57_600_000,), (1500,), (None,)], "open_time long")
    got = [(r.open_time_utc, r.date, r.year, r.month) for r in with_calendar(df, text=True).collect()]
    assert got[0] == ("1970-01-01T00:00:00", "1970-01-01", 1970, 1)
    assert got[1][0] == "1969-12-31T23:59:59.999000" and got[2][1] == "2020-01-02" and got[3][0] == "1970-01-01T00:00:01.500000" and got[4] == (None,) * 4
    assert month_partitions(T0, T0 + 86_400_000 * 31) == [(2020, 1), (2020, 2)] and month_partitions(5, 5) == []


def test_millis_without_zone(spark):
    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.9995' t union all select timestamp_ntz'2014-03-01 00:00:00.001' union all select null")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert [r[0] for r in df.select(millis_of(F.col("t"))).collect()] == [-1, 1_393_632_000_001, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quarantine_counts_both(spark):
    nan = float("nan")
    rows = [bar(), bar(high=0.1), bar(open_time=T0 + 1), bar(high=nan, close_time=5), bar(volume=None), bar(trade_count=-1), bar(interval="2h")]
    got = quality.with_quarantine(spark.createDataFrame(rows, BAR)).select("ohlc_bad", "time_bad", "quarantined").collect()
    assert [tuple(r) for r in got] == [(False, False, False), (True, False, True), (False, True, True), (True, True, True), (True, False, True), (True, False, True), (False, True, True)]


def test_live_errors(spark):
    nan = float("nan")
    df = spark.createDataFrame([bar(), bar(symbol="", open_time=-5, close_time=-9, high=0.0, volume=-1.0), bar(high=nan)], BAR)
    strict = [r[0] for r in df.select(quality.live_errors()).collect()]
    assert strict[0] == [] and strict[1][0] == "symbol is required" and strict[1][1] == "open_time must be non-negative" and strict[1][-1] == "closed Kline close_time must be >= open_time" and len(strict[1]) == 8
    loose = [r[0] for r in df.select(quality.live_errors(strict=False)).collect()]
    assert len(strict[2]) == 2 and loose[2] == []


def test_counts_and_samples(spark):
    df = with_calendar(spark.createDataFrame([bar(), bar(), bar(close=None), bar(open_time=T0 + 5)], BAR))
    r = quality.fused_counts(df, ["interval"]).first()
    assert (r["rows"], r.null_rows, r.ohlc_bad, r.misaligned, r.close_bad, r.date_bad) == (4, 1, 1, 1, 1, 0)
    assert quality.over_cap(df).first()["rows"] == 4
    assert tuple(quality.duplicate_keys(df, ["symbol", "open_time"], ["symbol"]).first()) == ("A", 2, 1)
    assert quality.first_samples(df, ["symbol"], ["open_time"], 2).count() == 2
    assert {r.field: r.nulls for r in quality.null_counts(df, ["close", "open"]).collect()} == {"close": 1, "open": 0}
    n = spark.createDataFrame([("1h", 100), ("4h", 25), ("1d", 25)], "interval string, rows long")
    got = {r.rule_id: r.status for r in quality.ratio_checks(n).collect()}
    assert got["PQ-1H-ROWS-GT-4H"] == "passed" and got["PQ-4H-ROWS-GT-1D"] == "failed" and got["PQ-1M-ROWS-GT-3M"] == "skipped"
    assert {r.status for r in quality.ratio_checks(n, full=False).collect()} == {"skipped"}


def test_empty(spark):
    df = with_calendar(spark.createDataFrame([], BAR))
    assert quality.fused_counts(df, ["interval"]).count() == 0
    assert quality.with_quarantine(df).count() == 0
    assert df.select(F.size(quality.live_errors())).count() == 0
