import random
from statistics import median

import numpy as np
from pyspark.sql import functions as F

from barloom.functions.quantiles import exact_median
from barloom.operators import spikes

SHAPE = "id long, s string, g string, ms long, slot long, instant long, open double, high double, low double, close_time long, trade_count long"


def test_exact_median(spark):
    rnd = random.Random(2)
    rows = [("hot", rnd.choice([1.0, 2.0, rnd.random()])) for _ in range(3001)] + [("two", 1.0), ("two", 4.0), ("none", None)] + [(f"k{i}", rnd.random()) for i in range(20)]
    got = {r.k: r.m for r in exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m").collect()}
    want = {k: float(np.median([v for kk, v in rows if kk == k])) for k in {r[0] for r in rows} - {"none"}}
    assert got == want


def brute(rows):
    """The rules of the docstring, row by row."""
    out = {}
    for s in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == s]
        w = [r[7] - r[8] for r in own if (r[10] or 0) > 0 and r[7] is not None and r[8] is not None]
        width = median(w) if w else None
        hull = {}
        for r in own:
            p = [x for x in r[6:9] if x is not None]
            if p:
                lo, hi = hull.get(r[4], (1e99, -1e99))
                hull[r[4]] = (min(lo, *p), max(hi, *p))
        order = sorted(hull)
        rank = {t: i for i, t in enumerate(order)}
        bars = {(rank[r[4]], *r[6:9]) for r in own if (r[10] or 0) > 0 and None not in r[6:9]}
        stuck = set()
        for b in bars:
            for k in range(6):
                run = [(b[0] - k + j, *b[1:]) for j in range(6)]
                if all(x in bars for x in run):
                    stuck.add(b)
        for r in own:
            x = 0.0
            if r[4] in rank and 0 < rank[r[4]] < len(order) - 1:
                n = [hull[order[rank[r[4]] + d]] for d in (-1, 1)]
                x = max([min(max(lo - v, v - hi, 0) for lo, hi in n) for v in r[6:9] if v is not None], default=0.0)
            o, h, low = r[6:9]
            bad = any(v is not None and v <= 0 for v in r[6:9]) or (h is not None and low is not None and h < low) or (o is not None and ((low is not None and o < low) or (h is not None and o > h)))
            late = r[9] is not None and (r[9] <= r[5] or abs(r[9] - r[5] + 1 - r[3]) > r[3] / 2)
            out[r[0]] = (width is not None and x > 8 * width, (rank.get(r[4]), o, h, low) in stuck and (r[10] or 0) > 0, bad, late)
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spikes, "CHUNK", 16)  # many borders
    rnd = random.Random(4)
    rows, n = [], 0
    for s in ("a", "b", "c"):
        level = 100.0
        for i in range(150):
            if rnd.random() < 0.1:
                continue
            level = level if 40 <= i < 52 else level + rnd.gauss(0, 0.3)
            o, h, low = level, level + 0.5, level - 0.5
            if rnd.random() < 0.06:
                h += rnd.choice([30.0, 3.0])
            if rnd.random() < 0.03:
                low = rnd.choice([-1.0, None, h + 1, float("nan")])
            for _ in range(rnd.choice([1, 1, 1, 2])):
                length = rnd.choice([59_999] * 20 + [-5, 10, 200_000, None])
                close = None if length is None else i * 60_000 + length
                rows.append((n, s, "1m", 60_000, i * 60_000, i * 60_000, o, h, low, close, rnd.choice([5, 5, 5, 5, 5, 0])))
                n += 1
    got = {r.id: (r.extreme, r.stuck, r.impossible, r.mistimed) for r in spikes.implausible(spark.createDataFrame(rows, SHAPE).withColumns({c: F.lit("clash") for c in ("x", "bar", "phase", "rank", "stuck", "width", "lo", "chunk")})).collect()}
    clean = [tuple(None if isinstance(v, float) and v != v else v for v in r) for r in rows]
    want = brute(clean)
    assert got == want
    assert any(v[0] for v in want.values()) and any(v[1] for v in want.values())


def test_cutoff_and_edges(spark):
    rnd = random.Random(6)
    rows = [(i, "a", "1h", 3_600_000, i * 3_600_000, i * 3_600_000, 10.0, 10.5 + abs(rnd.gauss(0, 0.1)), 9.5, i * 3_600_000 + 3_599_999, 1) for i in range(800)]
    r = list(rows[400])
    r[7] = 60.0
    rows[400] = tuple(r)
    got = {x.id: x for x in spikes.implausible(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got[400].spike and got[400].extreme and got[400].cut > 0
    assert sum(x.spike for x in got.values()) < 10
    odd = [(1, None, "1m", 60_000, 0, 0, 1.0, 1.0, 1.0, 1, 1), (2, "a", "1m", 60_000, 0, 0, None, None, None, None, None), (2, "a", "1m", 60_000, 0, 0, None, None, None, None, None)]
    out = spikes.implausible(spark.createDataFrame(odd, SHAPE)).collect()
    assert len(out) == 2 and not any(x.spike or x.extreme or x.stuck or x.impossible or x.mistimed for x in out)
    assert spikes.implausible(spark.createDataFrame([], SHAPE)).count() == 0


def planted(seed, series=10):
    """Series whose bars are three times as wide in two hours of the day, with known spikes of 3 to 7 median widths in quiet hours; (rows, planted ids)."""
    rnd = random.Random(seed)
    rows, spiked, n = [], set(), 0
    for s in range(series):
        for i in range(960):
            wide = 3.0 if i % 24 in (13, 14) else 1.0
            level = 100 + rnd.gauss(0, 0.4) * wide
            o, h, low = level, level + wide * (0.5 + abs(rnd.gauss(0, 0.1))), level - wide * (0.5 + abs(rnd.gauss(0, 0.1)))
            if wide == 1.0 and rnd.random() < 0.01:
                h += rnd.uniform(3.5, 7)
                spiked.add(n)
            rows.append((n, f"s{s}", "1h", 3_600_000, i * 3_600_000, i * 3_600_000, o, h, low, i * 3_600_000 + 3_599_999, 1))
            n += 1
    return rows, spiked


def test_the_fit_decides(spark):
    """Planted spikes below eight widths: the plain rule finds none of them, the fitted tail most, and the risk moves the cutoff."""
    rows, spiked = planted(8)
    df = spark.createDataFrame(rows, SHAPE)
    got = {risk: {r.id: r for r in spikes.implausible(df, risk=risk).collect()} for risk in (1e-2, 1e-3, 1e-9)}
    flagged = {risk: {i for i, r in g.items() if r.spike} for risk, g in got.items()}
    assert len(flagged[1e-2]) > len(flagged[1e-3]) > len(flagged[1e-9])
    assert len(flagged[1e-3] & spiked) > 0.7 * len(spiked) and len(flagged[1e-3] & spiked) > 0.8 * len(flagged[1e-3])
    assert len({i for i, r in got[1e-3].items() if r.extreme} & spiked) < 0.1 * len(spiked)
    assert flagged[1e-9] <= flagged[1e-3] <= flagged[1e-2]


def test_spikes_do_not_lift_the_cutoff(spark):
    """The cutoff of clean data holds up when a fiftieth of the readings become spikes."""
    rows, spiked = planted(9)
    clean = [tuple(r[8] + 1.1 if k == 7 and r[0] in spiked else v for k, v in enumerate(r)) for r in rows]
    wild = [tuple(v + 300 if k == 7 and r[0] % 50 == 0 else v for k, v in enumerate(r)) for r in clean]
    cuts = []
    for data in (clean, wild):
        df = spark.createDataFrame(data, SHAPE)
        cuts.append(max(r.cut for r in spikes.implausible(df, risk=0.02).collect() if r.cut is not None))
    assert cuts[1] < 2 * cuts[0]
    found = [r for r in spikes.implausible(spark.createDataFrame(wild, SHAPE)).collect() if r.id % 50 == 0 and 0 < r.id % 960 < 959]
    assert all(r.spike and r.extreme for r in found)


def test_narrow_brackets_and_large_tables(spark, monkeypatch):
    """The branches that a large run takes: no broadcast, brackets narrowed."""
    from barloom import session
    from barloom.functions import quantiles

    rows, _ = planted(10, 3)
    df = spark.createDataFrame(rows, SHAPE)
    want = sorted(tuple(r) for r in spikes.implausible(df).select("id", "spike", "extreme", "stuck").collect())
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(quantiles, "BOUND", 4)
    monkeypatch.setattr(quantiles, "GRID", 4)
    assert sorted(tuple(r) for r in spikes.implausible(df).select("id", "spike", "extreme", "stuck").collect()) == want
    rnd = random.Random(11)
    vals = [("a", rnd.choice([1.0, rnd.random()])) for _ in range(999)] + [("b", float(i)) for i in range(500)]
    got = {r.k: r.m for r in exact_median(spark.createDataFrame(vals, "k string, v double"), ["k"], "v", "m").collect()}
    assert got == {k: float(np.median([v for kk, v in vals if kk == k])) for k in ("a", "b")}
