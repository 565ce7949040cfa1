import itertools

import pytest

from barloom.operators import conflicts
from barloom.operators.conflicts import last_wins, resolve_archives, upsert, upsert_counts
from barloom.schema import VALUES

SHAPE = "k long, `order` long, archive_source string, archive_period string, v double, w long"


def fold(rows):
    """One row after the other against the winner so far."""
    rows = sorted(rows, key=lambda r: ({"monthly": 1, "daily": 2}.get(r[2], 0), r[3] or "", r[1]))
    win, dup, conf, bad = rows[0], 0, 0, 0
    for r in rows[1:]:
        if r[4:] == win[4:] and r[4] == r[4]:
            dup += 1
        elif r[2] != win[2]:
            conf += 1
            win = r if r[2] == "daily" else win
        else:
            bad += 1
    return win[1], dup, conf, bad


@pytest.mark.parametrize("few", [conflicts.FEW, 3, 0])
def test_all_short_sequences(spark, monkeypatch, few):
    """Folded as arrays, by sums, and both side by side."""
    monkeypatch.setattr(conflicts, "FEW", few)
    kinds = [("monthly", "2024-01"), ("daily", "2024-01-01")]
    rows, k = [], 0
    for n in range(1, 5):
        for sources in itertools.product(kinds, repeat=n):
            for values in itertools.product((1.0, 2.0, 3.0), repeat=n):
                rows += [(k, i, *sources[i], values[i], 7) for i in range(n)]
                k += 1
    got = {r.k: (r.winner.order, r.duplicates, r.conflicts, r.inconsistent) for r in resolve_archives(spark.createDataFrame(rows, SHAPE), ["k"], ["v", "w"]).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got == {k: fold(v) for k, v in by.items()}


@pytest.mark.parametrize("few", [conflicts.FEW, 0])
def test_nulls_nan_and_copies(spark, monkeypatch, few):
    monkeypatch.setattr(conflicts, "FEW", few)
    nan = float("nan")
    rows = [(1, 0, "daily", "p", nan, 1), (1, 1, "daily", "p", nan, 1), (2, 0, "monthly", None, None, None), (2, 1, "daily", None, None, None), (3, 5, "monthly", "p", 1.0, 1), (3, 5, "monthly", "p", 1.0, 1), (None, 0, "daily", "p", 1.0, 1)]
    got = {r.k: (r.duplicates, r.conflicts, r.inconsistent) for r in resolve_archives(spark.createDataFrame(rows, SHAPE), ["k"], ["v", "w"]).collect()}
    assert got == {1: (0, 0, 1), 2: (1, 0, 0), 3: (1, 0, 0), None: (0, 0, 0)}
    assert resolve_archives(spark.createDataFrame([], SHAPE), ["k"], ["v", "w"]).count() == 0
    assert len(VALUES) == 10


def test_upsert(spark):
    shape = "symbol string, interval string, open_time long, v int, at long"
    old = spark.createDataFrame([("A", "1m", 0, 1, 9), ("A", "1m", 60, 1, 9)], shape)
    new = spark.createDataFrame([("A", "1m", 60, 2, 1), ("A", "1m", 60, 3, 2), ("B", "1m", 0, 4, 3), ("B", "1m", 0, 5, 4)], shape)
    key = ["symbol", "interval", "open_time"]
    assert {(r.symbol, r.open_time): r.v for r in upsert(old, new, key, "at").collect()} == {("A", 0): 1, ("A", 60): 3, ("B", 0): 5}
    got = {r.symbol: tuple(r)[1:] for r in upsert_counts(old, new, key, ["symbol"]).collect()}
    assert got == {"A": (2, 2, 2, 2, 0, 60), "B": (2, 0, 1, 1, 0, 0)}
    assert upsert(old.limit(0), new.limit(0), key, "at").count() == 0
    assert last_wins(old.unionByName(old), key, ["at"]).count() == 2
