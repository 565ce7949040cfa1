import itertools
import math
import random

from barloom.llm import fusion
from barloom.llm.fusion import fuse

SHAPE = "item string, copy string, source string, `order` long, v double, clash string"


def conflict(values):
    some = [v for v in values if v is not None and v == v]
    if some and len(some) < len(values):
        return True
    return any(abs(a - b) > 1e-6 * max(abs(a), abs(b)) for a, b in itertools.combinations(some, 2))


def test_conflicts_against_brute_force(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(300):
        true = rnd.choice([rnd.uniform(-5, 500), 0.0])
        for n in range(rnd.randint(1, 6)):
            v = rnd.choice([true, true, true, true * (1 + 4e-7), true * 1.001, None, float("nan")])
            rows.append((f"i{i}", rnd.choice(["a", "b", "c", None]), rnd.choice(["x", "y"]), n, v, "q"))
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = {i: conflict([r[4] for r in rs]) for i, rs in by.items() if len({r[1] for r in rs}) >= 2}
    got = {r.item: r.v_conflict for r in fuse(spark.createDataFrame(rows, SHAPE), ["v"]).collect()}
    assert got == want and any(want.values()) and not all(want.values())


def test_posterior_of_one_round(spark):
    """Three sources, no copying yet: the posterior by the formula."""
    rows = [("i", "c0", "s0", 0, 1.0, ""), ("i", "c1", "s1", 0, 1.0, ""), ("i", "c2", "s2", 0, 2.0, "")]
    r = fuse(spark.createDataFrame(rows, SHAPE), ["v"], rounds=0).first()
    w = math.log(fusion.FALSE_VALUES * 0.8 / 0.2)
    z = math.exp(2 * w) + math.exp(w) + fusion.FALSE_VALUES + 1 - 2
    assert r.v == 1.0 and r.v_source == "s0" and abs(r.v_belief - math.exp(2 * w) / z) < 1e-9


def world(copier, seed=13, n=900):
    rnd = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        truth[f"i{i}"] = t = 100.0 + i
        false = lambda: t + rnd.randint(1, 40)  # noqa: E731,B023
        good = [t if rnd.random() < 0.85 else false() for _ in range(2)]
        bad = t if rnd.random() < 0.45 else false()
        claims = {"g1": good[0], "g2": good[1], "bad": bad}
        if copier:
            claims |= {f"copy{k}": bad if rnd.random() < 0.95 else false() for k in range(2)}
        rows += [(f"i{i}", s, s, 0, v, "") for s, v in claims.items()]
    return rows, truth


def test_copied_votes_are_discounted(spark):
    rows, truth = world(copier=True)
    got = {r.item: r.v for r in fuse(spark.createDataFrame(rows, SHAPE), ["v"], rounds=5).collect()}
    right = sum(got[i] == t for i, t in truth.items())
    votes = 0
    for i, t in truth.items():
        own = [r[4] for r in rows if r[0] == i]
        votes += max(set(own), key=lambda v: (own.count(v), -v)) == t
    assert right > 0.85 * len(truth) and right > votes + 0.1 * len(truth)


def test_dirt(spark):
    rows = [("i", None, None, 1, 1.0, ""), ("i", "b", "y", 1, None, ""), (None, "b", "y", 1, 3.0, ""), ("j", "a", "x", 1, None, ""), ("j", "b", "x", 2, float("nan"), ""), ("k", "a", "x", 1, 5.0, ""), ("k", "a", "x", 1, 5.0, "")]
    got = {r.item: (r.v, r.v_belief > 0, r.v_conflict) for r in fuse(spark.createDataFrame(rows, SHAPE), ["v"]).collect()}
    assert got == {"i": (1.0, True, True), "j": (None, False, False)}
    assert fuse(spark.createDataFrame([], SHAPE), ["v"]).count() == 0


def test_many_sources_and_archives(spark):
    """Forty sources, and a source whose archives disagree: each archive's claim can win."""
    rows = [(f"i{k}", f"c{s}", f"s{s:02}", 1, float(k) if s % 10 else float(k) + 7, "") for k in range(30) for s in range(40)]
    got = {r.item: (r.v, r.n_copies) for r in fuse(spark.createDataFrame(rows, SHAPE), ["v"]).collect()}
    assert got == {f"i{k}": (float(k), 40) for k in range(30)}
    own = [("j", "a-1", "a", 1, 5.0, ""), ("j", "a-2", "a", 2, 6.0, ""), ("j", "b-1", "b", 3, 5.0, "")]
    r = fuse(spark.createDataFrame(own, SHAPE), ["v"], rounds=0).first()
    assert (r.v, r.v_source, r.n_copies, r.v_conflict) == (5.0, "a", 3, True)


def test_equal_claims_meet_across_cells(spark):
    """Values within SAME are one claim wherever the grid's borders lie; an outlier with one vote never beats two such."""
    rnd = random.Random(17)
    rows = []
    for k in range(400):
        t = rnd.choice([-1, 1]) * 10 ** rnd.uniform(-8, 8)
        rows += [(f"i{k}", "a", "a", 1, t, ""), (f"i{k}", "b", "b", 2, t * (1 + rnd.uniform(-0.9e-6, 0.9e-6)), ""), (f"i{k}", "0", "0", 3, t * 1.5, "")]
    got = fuse(spark.createDataFrame(rows, SHAPE), ["v"], rounds=0).collect()
    truth = {r[0]: r[4] for r in rows if r[1] == "a"}
    split = [r.item for r in got if abs(r.v - truth[r.item]) > 2e-6 * abs(truth[r.item])]
    assert not split


def test_hot_item_and_no_broadcast(spark, monkeypatch):
    """An item with a third of all rows, exact copies and different values, without broadcasts."""
    from barloom import session

    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    rows = [("hot", f"c{k % 90}", f"s{k % 9}", k, 1.0 if k % 9 else 2.0 + k, "") for k in range(900)]
    rows += [(f"i{k % 60}", f"c{k % 7}", f"s{k % 7}", k, float(k % 60), "") for k in range(1800)]
    got = {r.item: (r.v, r.v_conflict) for r in fuse(spark.createDataFrame(rows, SHAPE), ["v"]).collect()}
    assert got.pop("hot") == (1.0, True) and got == {f"i{k}": (float(k), False) for k in range(60)}
