import random

from pyspark.sql import functions as F

from barloom.operators import asknown

V = "entity string, valid_from long, valid_to long, state string"
E = "id long, entity string, time long"


def brute(versions, e, t):
    hit = [v for v in versions if v[0] == e and v[1] is not None and v[1] <= t and (v[2] is None or t < v[2])]
    return hit[-1][3] if hit else None


def test_against_brute_force(spark):
    rnd = random.Random(1)
    versions = []
    for e in "abcde":
        t = rnd.randrange(10**12)
        for i in range(150 if e == "a" else 4):  # a changes far more often than max_log allows in a long period
            end = t + rnd.randrange(1, 50_000 if e == "a" else 10**11)
            versions.append((e, t, end if i % 7 else end, f"{e}{i}"))
            t = end + rnd.choice([0, 0, rnd.randrange(10**5)])
        versions.append((e, t, None, f"{e}open"))
    times = [x for v in versions for x in (v[1], (v[2] or v[1]) - 1, v[2] or v[1] + 5)]
    events = [(i, rnd.choice("abcdef"), rnd.choice(times)) for i in range(500)] + [(1000 + i, v[0], v[1]) for i, v in enumerate(versions)]
    df = spark.createDataFrame(events, E).withColumns({c: F.lit("clash") for c in ("state", "log", "p", "at_start", "_ak_p", "valid_from", "at")})
    got = {r.id: r.state for r in asknown.as_known(df, spark.createDataFrame(versions, V), max_log=8).collect()}
    assert got == {i: brute(versions, e, t) for i, e, t in events}


def test_busy_entities_and_large_tables(spark, monkeypatch):
    """A busy entity shortens its own period only; the same states come without broadcasts."""
    from barloom import session

    versions = [("busy", 1000 * i, 1000 * (i + 1), f"s{i}") for i in range(300)] + [("calm", 0, 10**11, "one"), ("calm", 10**11, None, "two")]
    log = asknown.change_log(spark.createDataFrame(versions, V))
    lengths, n = asknown.busy_lengths(log, 8)
    assert n == 1 and lengths.first().entity == "busy" and lengths.first().length < asknown.LONGEST
    rnd = random.Random(3)
    events = [(i, rnd.choice(["busy", "calm"]), rnd.choice([rnd.randrange(310_000), 10**11 - 1, 10**11])) for i in range(300)]
    want = {i: brute(versions, e, t) for i, e, t in events}
    for size in (session.BROADCAST_BYTES, 0):
        monkeypatch.setattr(session, "BROADCAST_BYTES", size)
        got = {r.id: r.state for r in asknown.as_known(spark.createDataFrame(events, E), spark.createDataFrame(versions, V), max_log=8).collect()}
        assert got == want


def test_edges(spark):
    v = spark.createDataFrame([("a", 10, 20, "x"), ("a", 20, None, "y"), ("a", 5, 5, "nothing"), (None, 1, None, "q"), ("b", None, 3, "q")], V)
    ev = spark.createDataFrame([(1, "a", 9), (2, "a", 10), (3, "a", 20), (4, None, 10), (5, "a", None), (5, "a", None), (6, "b", 2)], E)
    assert sorted((r.id, r.state) for r in asknown.as_known(ev, v).collect() if r.state) == [(2, "x"), (3, "y")]
    assert asknown.as_known(ev, v).count() == 7
    assert asknown.as_known(ev, v.limit(0)).where("state is not null").count() == 0
    assert asknown.as_known(ev.limit(0), v).count() == 0


def test_iso(spark):
    given = ["2024-01-01T00:00:00Z", "2024-01-01 08:00:00+08:00", "2023-12-31T19:00:00.000-05:00", "2024-01-01", "2024-01-01T00:00:00", " ", None, "soon"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, s string").orderBy("i")
    assert [r[0] for r in df.select(asknown.iso_millis(F.col("s"))).collect()] == [1_704_067_200_000] * 5 + [None] * 3
