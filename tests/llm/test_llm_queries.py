import os
from collections import Counter

import pytest

from barloom.llm import queries, tokens

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.partition('.')[0]} as select * from '{DATA}/{f}'")
    want = c.sql(queries.SQL[name])
    df = queries.QUERIES[name](spark, DATA)
    assert df.columns == want.columns and Counter(map(tuple, df.collect())) == Counter(want.fetchall())


def test_p9_found(spark):
    t = tokens.tokenizer(tokens.RANKS)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id for r in docs if r.text and len(t.enc.encode_ordinary(r.text)) > 2048}
    assert {r.doc_id for r in queries.QUERIES["p9_found"](spark, DATA).collect()} == want


@pytest.mark.parametrize("name", ["p3_fused", "p7_packed", "p7_containers", "p8_draw", "p8_shares", "p9_pieces"])
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_empty_and_null_tables(spark, tmp_path, kind):
    for f in os.listdir(DATA):
        df = spark.read.parquet(f"{DATA}/{f}")
        if not f.startswith("size_limits"):
            df = df.limit(0) if kind == "empty" else spark.createDataFrame([(None,) * len(df.columns)] * 5, df.schema)
        df.coalesce(1).write.parquet(str(tmp_path / f))
    for name, f in queries.QUERIES.items():
        rows = f(spark, str(tmp_path)).collect()
        assert [tuple(r) for r in rows] == ([(0,)] if name == "p7_within" else []), name


def test_fused_values_on_the_tables(spark):
    """The bars' own closes as truth, told by two good sources, a bad one and two that copy it: fusion is right more often than the majority."""
    from pyspark.sql import functions as F

    from barloom.functions.identity import with_identity
    from barloom.llm.fusion import fuse

    bars = with_identity(spark.read.parquet(f"{DATA}/klines.parquet")).where("_slot is not null and _symbol is not null and close > 0 and not isnan(close)")
    truth = bars.groupBy(F.concat_ws("|", "_symbol", "_interval", "_slot").alias("item")).agg(F.min("close").alias("true"))
    u = lambda k: F.pmod(F.xxhash64("item", F.lit(k)), F.lit(10_000)) / 10_000
    false = lambda k: F.col("true") * (1.01 + F.floor(u(100 + k) * 40) / 100)
    bad = F.when(u(3) < 0.45, F.col("true")).otherwise(false(3))
    told = {"g1": F.when(u(1) < 0.85, F.col("true")).otherwise(false(1)), "g2": F.when(u(2) < 0.85, F.col("true")).otherwise(false(2)), "bad": bad, "c1": F.when(u(4) < 0.95, bad).otherwise(false(4)), "c2": F.when(u(5) < 0.95, bad).otherwise(false(5))}
    claims = truth.select("item", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), v.alias("v")) for s, v in told.items()])).alias("c")).select("item", F.col("c.source").alias("copy"), "c.source", F.lit(1).alias("order"), "c.v")
    want = {r.item: r.true for r in truth.collect()}
    by = {}
    for r in claims.collect():
        by.setdefault(r.item, Counter())[round(r.v, 9)] += 1
    votes = sum(abs(max(c, key=c.get) - want[i]) < 1e-6 * want[i] for i, c in by.items())
    right = sum(abs(r.v - want[r.item]) < 1e-6 * want[r.item] for r in fuse(claims, ["v"], rounds=5).collect())
    assert right > 0.85 * len(want) and right > votes + 0.1 * len(want)
