import math
import random

from pyspark.sql import functions as F

from barloom.operators.gridfill import promised_slots, regular_grid

READ = "s string, g string, slot long, `order` long, value double"
DAY = 86_400_000


def test_promised_slots(spark):
    rows = [("A", "4h", "A-4h-2024-02.zip", None), ("A", "4h", "A-4h-2024-02.zip", "2024-02"), ("A", "4h", "A-4h-2024-02-03.zip", "2024-02-03"), ("B", "1d", "odd name", "2023-12-31"), ("B", "1d", "odd", None), ("B", "7d", "B-7d-2024-01.zip", None), ("C", "1h", "C-1h-2024-13-77.zip", None)]
    df = spark.createDataFrame(rows, "symbol string, interval string, zip_name string, archive_period string")
    got = promised_slots(df).collect()
    assert len(got) == len({tuple(r) for r in got}) == 29 * 6 + 1
    assert min(r.slot for r in got if r.symbol == "A") == 1_706_745_600_000
    assert promised_slots(df.limit(0)).count() == 0


def test_low_rank_values_come_back(spark):
    rnd = random.Random(5)
    sources, slots = 12, 40
    u = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(sources)]
    v = [(rnd.gauss(0, 0.1), rnd.gauss(0, 0.1)) for _ in range(slots)]
    true = {(f"s{i}", t): math.exp(3 + sum(a * b for a, b in zip(u[i], v[t], strict=True))) for i in range(sources) for t in range(slots)}
    seen = {k: x for k, x in true.items() if rnd.random() < 0.8}
    rows = [(s, "g", t * 60, n, x) for n, ((s, t), x) in enumerate(seen.items())]
    grid = spark.createDataFrame([(s, "g", t * 60) for s, t in true], "s string, g string, slot long")
    got = regular_grid(spark.createDataFrame(rows, READ), grid, rank=2, steps=12, ridge=1e-6).collect()
    assert len(got) == len(true)
    errors = []
    for r in got:
        key = (r.s, r.slot // 60)
        if key in seen:
            assert r.status == "observed" and r.value == seen[key]
        elif r.status == "filled":
            errors.append(abs(math.log(r.value / true[key])))
    errors.sort()
    assert len(errors) > 50 and errors[len(errors) // 2] < 0.03


def test_statuses_and_dirt(spark):
    rows = [("a", "g", 0, 1, 2.0), ("a", "g", 0, 2, float("nan")), ("a", "g", 0, 2, float("nan")), ("a", "g", 60, 3, None), ("b", "g", 0, 4, -1.0), (None, "g", 0, 5, 1.0), ("a", "g", None, 6, 1.0), ("x", "g", 999, 7, 1.0)]
    grid = spark.createDataFrame([("a", "g", 0), ("a", "g", 60), ("a", "g", 120), ("b", "g", 0)], "s string, g string, slot long")
    extra = {c: F.lit("clash") for c in ("status", "n_readings", "un", "t", "y", "mean")}
    got = {(r.s, r.slot): (r.status, r.value, r.n_readings) for r in regular_grid(spark.createDataFrame(rows, READ).withColumns(extra), grid.withColumns(extra | {"value": F.lit("clash")})).collect()}
    assert got == {("a", 0): ("observed", 2.0, 3), ("a", 60): ("observed", None, 1), ("a", 120): ("unsupported", None, 0), ("b", 0): ("observed", None, 1)}
    empty = regular_grid(spark.createDataFrame([], READ), grid)
    assert {r.status for r in empty.collect()} == {"unsupported"}
    assert regular_grid(spark.createDataFrame(rows, READ), grid.limit(0)).count() == 0


def test_without_broadcasts(spark, monkeypatch):
    """The branch that a large run takes gives the same grid."""
    from barloom import session

    rnd = random.Random(12)
    rows = [(f"s{s}", "1h", t * 3_600_000, t, 50.0 + s + t / 10) for s in range(6) for t in range(60) if rnd.random() < 0.8]
    df = spark.createDataFrame(rows, "s string, g string, slot long, `order` long, value double")
    slots = spark.createDataFrame([(f"s{s}", "1h", t * 3_600_000) for s in range(6) for t in range(60)], "s string, g string, slot long")
    show = lambda: sorted((r.s, r.slot, r.status, round(r.value, 6) if r.value else None) for r in regular_grid(df, slots).collect())
    want = show()
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    assert show() == want and {w[2] for w in want} == {"observed", "filled"}
