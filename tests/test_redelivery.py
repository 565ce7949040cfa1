import random

import pytest
from pyspark.sql import functions as F

from barloom.operators.redelivery import MessageTable


def table(spark, root, cluster=False):
    return MessageTable(spark, str(root), {"k": F.lower("k"), "t": F.col("t")}, ["k", "t"], "n", F.col("day"), cluster)


SHAPE = "n long, k string, t long, day string, extra string"


def winners(rows):
    best = {}
    for r in rows:
        if r[1] is None or r[2] is None:
            continue
        key = (r[1].lower(), r[2])
        best[key] = min(best.get(key, r[0]), r[0])
    return best


@pytest.mark.parametrize("cluster", [False, True])
def test_against_brute_force(spark, tmp_path, cluster):
    rnd = random.Random(3)
    rows = []
    for n in range(600):  # a third of the rows are copies of one message
        k, t = ("hot", 1) if rnd.random() < 0.34 else (rnd.choice(["a", "B", "b", "c", None]), rnd.choice([*range(40), None]))
        rows.append((n, k, t, f"d{n // 100}", None))
    rnd.shuffle(rows)
    m = table(spark, tmp_path, cluster)
    for i in range(3):
        m.merge(spark.createDataFrame(rows[i::3], SHAPE))
    best = winners(rows)
    free = {r[0] for r in rows if r[1] is None or r[2] is None}
    assert {r.n for r in m.read().collect()} == set(best.values()) | free
    assert m.read().count() == len(best) + len(free)
    gone = [r.n for r in m.removed().collect()]
    assert sorted(gone) == sorted(r[0] for r in rows if r[0] not in free and r[0] not in best.values())
    m.vacuum()
    assert m.read().count() == len(best) + len(free)


def test_only_affected_partitions(spark, tmp_path):
    m = table(spark, tmp_path)
    m.merge(spark.createDataFrame([(10, "a", 1, "d1", "x"), (11, "b", 1, "d2", "x"), (12, "c", 1, "d3", "x")], SHAPE))
    done = m.merge(spark.createDataFrame([(20, "A", 1, "d9", "late copy"), (21, "z", 1, "d2", "new"), (3, "c", 1, "d0", "earlier than the winner")], SHAPE))
    assert done.looked_up == ["pd1", "pd3"] and done.rewritten == ["pd1", "pd2", "pd3"] and done.removed_rows == 2
    assert {(r.n, r.day) for r in m.read().collect()} == {(10, "d1"), (11, "d2"), (21, "d2"), (3, "d0")}
    again = m.merge(spark.createDataFrame([(30, "q", 1, "d5", "")], SHAPE))
    assert again.rewritten == [] and {r.n for r in m.removed().collect()} == {20, 12}


def test_edges(spark, tmp_path):
    m = table(spark, tmp_path / "a")
    m.merge(spark.createDataFrame([], SHAPE))
    assert m.read() is None and m.removed().count() == 0
    same = [(1, "a", 1, None, "x")] * 3 + [(2, None, 1, "d", "y")] * 2
    m.merge(spark.createDataFrame(same, SHAPE))
    got = sorted((r.n, r.day) for r in m.read().collect())
    assert got == [(1, None), (2, "d"), (2, "d")]  # one of three equal deliveries; rows without identity all stay
    assert [r.n for r in m.removed().collect()] == [1, 1]
    with pytest.raises(ValueError):
        m.merge(spark.createDataFrame([(1, "a", 1, "d", "x", 1)], SHAPE + ", _mt_k int"))
    with pytest.raises(ValueError):
        table(spark, tmp_path / "b").removed()


def test_nulls_and_ties_of_the_order(spark, tmp_path):
    """A null order loses; an order value that two identifiers share takes only the loser's row; of ties one is kept and the others are counted."""
    m = table(spark, tmp_path)
    rows = [(1, "a", 1, "d", "x"), (None, "a", 1, "d", "x"), (None, "b", 1, "d", "x"), (None, "b", 1, "e", "x"), (5, "c", 1, "d", "x"), (3, "c", 1, "d", "x"), (5, "e", 1, "d", "x"), (7, "f", 1, "d", "x"), (7, "f", 1, "d", "x"), (7, "f", 1, "e", "x"), (9, "f", 1, "e", "x")]
    m.merge(spark.createDataFrame(rows[:6], SHAPE))
    m.merge(spark.createDataFrame(rows[6:], SHAPE))
    assert sorted((r.k, r.n if r.n is not None else -1) for r in m.read().collect()) == [("a", 1), ("b", -1), ("c", 3), ("e", 5), ("f", 7)]
    assert sorted(r.n if r.n is not None else -1 for r in m.removed().collect()) == [-1, -1, 5, 7, 7, 9]


def test_two_writers(spark, tmp_path):
    """Two writers start from one version: the second to publish fails, leaves what the first published as it is, and can merge again."""
    a, b = table(spark, tmp_path), table(spark, tmp_path)
    a.merge(spark.createDataFrame([(1, "a", 1, "d", "x")], SHAPE))
    old = b._manifest()
    a.merge(spark.createDataFrame([(2, "b", 1, "d", "first")], SHAPE))
    b._manifest = lambda: old
    late = spark.createDataFrame([(3, "c", 1, "d", "second")], SHAPE)
    with pytest.raises(RuntimeError, match="another writer"):
        b.merge(late)
    assert {r.extra for r in a.read().collect()} == {"x", "first"}
    del b._manifest
    b.merge(late)
    assert {r.extra for r in a.read().collect()} == {"x", "first", "second"}
    a.vacuum()
    assert a.read().count() == 3 and not a.files.write_new("{}", "_manifest", "00000001.json")


def test_index_grows_and_is_read_with_the_batch(spark, tmp_path):
    """A batch opens only the buckets of its own identifiers, and few deltas stand beside each other."""
    m = MessageTable(spark, str(tmp_path), {"k": F.col("k"), "t": F.col("t")}, ["k", "t"], "n", F.col("day"), bucket=F.expr("_mt_t div 10"))
    read = []
    for i in range(6):
        rows = [(100 * i + j, "a", 100 * i + j, f"d{i}", "") for j in range(100)]
        m.merge(spark.createDataFrame(rows, SHAPE))
        one = m.merge(spark.createDataFrame([(10_000 + i, "a", 5, "late", "")], SHAPE))
        read.append(one.index_files)
        assert one.looked_up == ["pd0"] and one.removed_rows == 1
    assert len(m._manifest()["index"]) <= 5 and max(read) <= 4
    files = len(m._index(m._manifest()["index"]).inputFiles())
    assert files >= 60  # of which a batch of one identifier read at most four


def test_work_folders_are_released(spark):
    from barloom.session import release, stored, work_dir
    from barloom.storage import Files

    release(spark)
    keep = work_dir(spark, "x")
    df = stored(spark.range(3), "t")
    folder = df.inputFiles()[0].rpartition("/")[0]
    assert df.count() == 3 and release(spark, [keep]) == 1 and not Files(spark, folder).exists("")
    assert release(spark) == 1
