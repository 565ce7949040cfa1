import math
import random

from barloom.llm.mixing import mix, shares

DOCS, TARGETS = "doc_id long, text string, source string", "source string, target_share double, max_repeats int"


def corpus(spark, n=1500, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.choices(["log", "Note ", "book", "spare", None], [60, 20, 5, 10, 5])[0]
        rows.append((i, " ".join(["word"] * int(5 + rnd.paretovariate(1.3) * 10)), s))
    return rows, spark.createDataFrame(rows + [(9000, "", "log"), (9001, None, "book")], DOCS)


def test_shares_are_met(spark):
    rows, docs = corpus(spark)
    targets = spark.createDataFrame([("log", 0.3, 1), ("note", 0.4, 2), ("BOOK", 0.2, 3), ("absent", 0.1, 2), ("zero", 0.0, 2), (None, 0.1, 1)], TARGETS)
    draw, there = mix(docs, targets)
    report = {r.source: r for r in shares(draw, there, targets).collect()}
    for s, want in (("log", 3 / 9), ("note", 4 / 9), ("book", 2 / 9)):
        assert abs(report[s].actual_share - want) < 0.004
    assert report["absent"].actual_share == 0 and report["spare"].tokens == 0 and report["spare"].tokens_there > 0
    got = draw.collect()
    caps = {"log": 1, "note": 2, "book": 3}
    assert all(1 <= r.copies <= caps[r.source] for r in got) and len({r.doc_id for r in got}) == len(got)
    # The total is as large as the caps allow: the scarcest source is used up.
    own = {s: sum(len(t.split()) for _, t, x in rows if x and x.strip().lower() == s) for s in caps}
    assert any(report[s].tokens > 0.985 * own[s] * caps[s] for s in caps)


def test_rates_are_exponential(spark):
    rows, docs = corpus(spark)
    targets = spark.createDataFrame([("log", 0.5, 4), ("note", 0.5, 4)], TARGETS)
    draw, _ = mix(docs, targets, total_tokens=3000)
    own = [len(t.split()) for _, t, s in rows if s == "log"]
    mean, lo, hi = sum(own) / len(own), -100.0, 100.0
    for _ in range(200):  # the dual by plain bisection
        mid = (lo + hi) / 2
        f = sum(n * min(4, math.exp(min(50, mid * n / mean))) for n in own)
        lo, hi = (mid, hi) if f < 1500 else (lo, mid)
    for r in draw.where("source = 'log'").collect():
        want = min(4.0, math.exp(min(50, lo * r.n_tokens / mean)))
        assert abs(r.rate - want) < 2e-3 * want + 1e-6


def test_edges(spark):
    _, docs = corpus(spark, 30)
    none = spark.createDataFrame([], TARGETS)
    draw, there = mix(docs, none)
    assert draw.count() == 0 and shares(draw, there, none).count() == there.count()
    targets = spark.createDataFrame([("log", 1.0, 2)], TARGETS)
    assert mix(docs.limit(0), targets)[0].count() == 0
    twice = mix(docs.unionByName(docs), targets)[0].collect()
    assert all(r.copies == 2 for r in twice)
    few = mix(docs, spark.createDataFrame([("log", 0.5, 1), ("log", 0.5, 3)], TARGETS))[0].collect()
    assert max(r.copies for r in few) == 3
