from pyspark.sql import functions as F

from barloom.functions.identity import canonical_archive, canonical_symbol, unit_factor
from barloom.intervals import UnknownInterval, expand_intervals, interval_ms, nearest_slot


def test_symbol(spark):
    given = ["novusdv", " NOV/USDV\t", "nov-usdv ", "NOVUSDV_240329", " ", "", None, "灵焰baxofo-usdv\t"]
    want = ["NOVUSDV", "NOVUSDV", "NOVUSDV", "NOVUSDV_240329", None, None, None, "灵焰BAXOFOUSDV"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(canonical_symbol(F.col("s"))).collect()] == want


def test_archive(spark):
    given = [("a/b/X-1m-2024-01-01.zip", None), ("mirror//a\\X-1m-2024-01-01.ZIP#x.csv", "daily"), (" LIVE_REST:/V1/BARS ", "live_rest"), (None, "Live_Rest "), ("  ", None), (None, None)]
    want = ["x-1m-2024-01-01.zip", "x-1m-2024-01-01.zip", "live_rest:/v1/bars", "live_rest", None, None]
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "i int, a string, c string")
    assert [r[0] for r in df.orderBy("i").select(canonical_archive(F.col("a"), F.col("c"))).collect()] == want


def test_against_the_patterns(spark):
    from barloom.functions.identity import BLANK, NOISE

    odd = ["a/b", "abc", "x.zip.zip", "d.zip/e.zip", "\u2003n\u00a0o\u3000v ", "a\\b.zip", "/", ".zip", "é-ß/\x1f", "\ufeffx\u2011y", "zip", "a.zip "]
    df = spark.createDataFrame([(i, o) for i, o in enumerate(odd)], "i int, s string").orderBy("i")
    noise = F.regexp_replace(F.upper("s"), NOISE, "")
    trim = F.lower(F.regexp_replace("s", f"^{BLANK}+|{BLANK}+$", ""))
    zipped = F.regexp_extract(trim, r"([^/\\]*?\.zip)", 1)
    want = df.select(F.nullif(noise, F.lit("")), F.when(zipped != "", zipped).when(trim != "", trim)).collect()
    assert df.select(canonical_symbol(F.col("s")), canonical_archive(F.col("s"), F.lit(None).cast("string"))).collect() == want


def test_instant_and_slot(spark):
    t = 1_393_633_200_000
    df = spark.createDataFrame([(0, t // 1000), (1, t), (2, t * 1000), (3, t * 1_000_000), (4, None), (5, -1), (6, 9_223_372_036_854_775_807)], "i int, t long")
    got = [r[0] for r in df.orderBy("i").select(unit_factor(F.col("t"), F.col("t"))).collect()]
    assert got == [t, t, t, t, None, -1000, 9_223_372_036_854]
    near = spark.createDataFrame([(x,) for x in (0, 29_999, 30_000, 59_999, -1, -30_001)], "x long").select(nearest_slot(F.col("x"), F.lit(60_000))).collect()
    assert [r[0] for r in near] == [0, 0, 60_000, 60_000, 0, -60_000]


def test_intervals():
    assert expand_intervals("all")[0] == "1d" and expand_intervals("1h, 1h,5m") == ["1h", "5m"]
    try:
        interval_ms("2h")
        raise AssertionError
    except UnknownInterval:
        pass
