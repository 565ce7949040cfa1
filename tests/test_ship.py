import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {repo!r})
from barloom.session import session
from barloom.operators.history import history
spark = session("ship", 2)
df = spark.createDataFrame([("e", 1, 1, "a"), ("e", 2, 1, "b")], "entity string, time long, got long, x string")
print("ROWS", history(df, ["x"], ["got"]).count())
"""


def test_workers_find_the_package_from_anywhere(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]


def test_empty_and_null_tables(spark, tmp_path):
    """Every query over tables without rows, and over rows of nulls."""
    import pytest

    import __spark_entry__ as entry

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test tables here")
    tables = [f.partition(".")[0] for f in os.listdir(data)]
    for kind in ("empty", "nulls"):
        for t in tables:
            df = spark.read.parquet(f"{data}/{t}.parquet")
            if t != "size_limits":
                df = df.limit(0) if kind == "empty" else spark.createDataFrame([(None,) * len(df.columns)] * 5, df.schema)
            df.coalesce(1).write.parquet(str(tmp_path / kind / f"{t}.parquet"))
        for name, f in entry.queries().items():
            if name.startswith("p") and not f.__module__.startswith("barloom.llm"):
                assert f(spark, str(tmp_path / kind)).count() == (5 if (kind, name) == ("nulls", "p1_kept") else 1 if name == "process_summary" else 0), (kind, name)
