import random

import pytest

from barloom.operators.history import history

SHAPE = "entity string, time long, got long, a string, b string, other string"


def brute(rows):
    held = {}
    for r in rows:
        if r[0] is None or r[1] is None:
            continue
        k = (r[0], r[1])
        key = (r[2] if r[2] is not None else -1, r[3] or "", r[4] or "")
        if k not in held or key > held[k][0]:
            held[k] = (key, r)
    out, state = [], {}
    for (e, t), (_, r) in sorted(held.items()):
        s = state.get(e)
        if s is None:
            state[e] = {"from": t, "a": r[3], "b": r[4]}
            continue
        if any(new is not None and s[n] is not None and new != s[n] for n, new in (("a", r[3]), ("b", r[4]))):
            out.append((e, s["from"], t, s["a"], s["b"]))
            s["from"] = t
        for n, new in (("a", r[3]), ("b", r[4])):
            s[n] = new if new is not None else s[n]
    return sorted(out + [(e, s["from"], None, s["a"], s["b"]) for e, s in state.items()], key=str)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_against_brute_force(spark, parts):
    rnd = random.Random(parts)
    rows = []
    for i in range(700):
        e = "hot" if rnd.random() < 0.4 else rnd.choice("abcdefgh")
        a = rnd.choice(["1", "1", "1", "2", None]) if e != "hot" else ("1" if i % 300 else None)
        rows.append((e, rnd.randrange(400) if e == "hot" else rnd.randrange(60), rnd.randrange(1000) * 1000 + i, a, rnd.choice(["x", "x", "x", "x", "y", None]), "clash"))
    got = sorted((tuple(r) for r in history(spark.createDataFrame(rows, SHAPE), ["a", "b"], ["got"], parts).collect()), key=str)
    assert got == brute(rows)


def test_one_version_over_all_tasks(spark):
    rows = [("hot", t, 1, "1" if t else None, None, "") for t in range(200)]
    assert [tuple(r) for r in history(spark.createDataFrame(rows, SHAPE), ["a", "b"], ["got"], 8).collect()] == [("hot", 0, None, "1", None)]


def test_edges(spark):
    df = spark.createDataFrame([(None, 1, 1, "1", "1", ""), ("a", None, 1, "1", "1", ""), ("a", 1, 5, "2", "1", ""), ("a", 1, 5, "2", "1", ""), ("a", 1, 9, "1", "1", "")], SHAPE)
    assert [tuple(r) for r in history(df, ["a", "b"], ["got"], 2).collect()] == [("a", 1, None, "1", "1")]
    assert history(df.limit(0), ["a", "b"], ["got"], 2).count() == 0


def test_runs_and_blocks(spark, monkeypatch):
    """More snapshots than runs, deliveries of one key in many ranges, many plain copies."""
    from barloom.operators import history as H

    monkeypatch.setattr(H, "RUNS", 5)
    rnd = random.Random(31)
    rows = [("hot", 7, rnd.randrange(10**6) * 1000 + i, rnd.choice("123"), rnd.choice(["x", None]), "") for i in range(300)]
    rows += [(rnd.choice(["a", "b", "hot"]), rnd.randrange(30), rnd.randrange(10**6) * 1000 + i, rnd.choice(["1", "1", "2", None]), "x", "") for i in range(300)]
    for data in (rows, rows + rows[:1] * 900):
        got = sorted((tuple(r) for r in history(spark.createDataFrame(data, SHAPE), ["a", "b"], ["got"], 7).collect()), key=str)
        assert got == brute(data)


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_merge_reads_in_order(tmp_path, monkeypatch, block):
    """The merge of sorted runs, in blocks of any size, gives every key once, in order, with the last row of its run."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from barloom.operators import history as H

    monkeypatch.setattr(H, "BLOCK", block)
    rnd = random.Random(5)
    want = {}
    for run in range(4):
        rows = sorted((rnd.choice("abcd"), run + 4 * rnd.randrange(50)) for _ in range(150))
        for i, k in enumerate(rows):
            want[k] = f"{run}-{i}"
        folder = tmp_path / f"_run={run}"
        folder.mkdir()
        pq.write_table(pa.table({"entity": [k[0] for k in rows], "time": [k[1] for k in rows], "a": [f"{run}-{i}" for i in range(len(rows))]}), folder / "part-0.parquet")
    blocks = list(H.merged(str(tmp_path), ["a"]))
    got = [(r.entity, r.time, r.a) for b in blocks for r in b.itertuples()]
    assert got == [(e, t, a) for (e, t), a in sorted(want.items())]
    assert [g for b in H.merged(str(tmp_path), ["a"], "c") for g in b["entity"]] == ["c"] * sum(k[0] == "c" for k in want)
    assert list(H.merged(str(tmp_path / "none"), ["a"])) == []
