import random

from barloom.operators import continuity

SHAPE = "symbol string, interval string, open_time long, close_time long"
M = 60_000


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(continuity, "CHUNK", 8)
    rnd = random.Random(8)
    rows = []
    for s in ("a", "b"):
        for i in sorted(rnd.sample(range(400), 150)):
            t = i * M + (rnd.choice([0, 0, 0, 7]))
            rows += [(s, "1m", t, t + M - 1)] * rnd.choice([1, 1, 2])
    rows.append(("a", "1m", None, None))
    got = {r.symbol: r for r in continuity.continuity(spark.createDataFrame(rows, SHAPE), 500 * M + 2000).collect()}
    for s in ("a", "b"):
        times = [r[2] for r in rows if r[0] == s and r[2] is not None]
        u = sorted(set(times))
        missing = sum(max(0, (b - a) // M - 1) for a, b in zip(u, u[1:], strict=False))
        r = got[s]
        assert (r["rows"], r.duplicates, r.missing, r.misaligned) == (len(times), len(times) - len(u), missing, sum(t % M != 0 for t in times))
        assert r.latest_closed == 499 * M and r.lag_bars == (499 * M - u[-1]) // M and r.status == "gap_detected"


def test_plan_and_states(spark):
    bars = spark.createDataFrame([("A", "1m", 0, M - 1), ("B", "1m", 5 * M, 0)], SHAPE)
    wanted = spark.createDataFrame([("A", "1m"), ("B", "1m"), ("C", "1m"), ("A", "1m")], "symbol string, interval string")
    state = spark.createDataFrame([("A", "1m", 3 * M)], "symbol string, interval string, last_closed_open_time long")
    got = {r.symbol: (r.source, r.missing, r.start, r.end, r.status) for r in continuity.backfill_plan(wanted, state, bars, 6 * M + 2000).collect()}
    assert got == {"A": ("state", 2, 4 * M, 5 * M, "missing"), "B": ("current_dataset", 0, None, None, "up_to_date"), "C": ("bootstrap_required", 0, None, None, "bootstrap_required")}
    empty = {r.symbol: r.status for r in continuity.continuity_of(bars, wanted, 6 * M).collect()}
    assert empty == {"A": "ok", "B": "gap_detected", "C": "empty"}
    assert continuity.overall(continuity.continuity_of(bars, wanted, 6 * M), ["interval"]).first().overall_status == "gap_detected"
    seen = spark.createDataFrame([("A", "1m", 1000), ("B", "1m", 200_000)], "symbol string, interval string, message_ms long")
    assert {r.symbol for r in continuity.stale_streams(wanted, seen, 200_000).collect()} == {"A", "C"}
    old = spark.createDataFrame([("A", "1m", 9 * M, 4)], "symbol string, interval string, last_closed_open_time long, merged_bars long")
    late = spark.createDataFrame([("A", "1m", 2 * M, 3)], "symbol string, interval string, max_open_time long, input_rows long")
    assert tuple(continuity.flush_state(old, late).first()) == ("A", "1m", 9 * M, 7)
    assert tuple(continuity.flush_state(old, late, monotone=False).first()) == ("A", "1m", 2 * M, 7)
    assert continuity.continuity(bars.limit(0), 0).count() == 0
