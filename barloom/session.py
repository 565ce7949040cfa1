"""Sessions and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Above so many bytes nothing is broadcast by hint.
BROADCAST_BYTES = 24 << 20
_made: list[str] = []
_shipped: set[str] = set()


def session(app: str = "barloom", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session with this engine's settings."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session. Only where it is unset, as in local tests, a temporary one is made and set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="barloom-")
        atexit.register(shutil.rmtree, root, True)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, what: str) -> str:
    """A new folder in the shared one. release() deletes it with all others of this process; scope() with those of a block; what is left goes when the process ends."""
    if not _made:
        atexit.unregister(_release_quietly)
        atexit.register(_release_quietly, spark)
    path = f"{shared_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def release(spark: SparkSession, keep: list[str] | None = None) -> int:
    """Deletes the working folders that this process made, but for those in keep; how many. To be called when the results that read them are written."""
    gone = [p for p in _made if p not in (keep or [])]
    for p in gone:
        drop_path(spark, p)
        _made.remove(p)
    return len(gone)


def _release_quietly(spark: SparkSession) -> None:
    try:
        release(spark)
    except Exception:  # noqa: BLE001 - the session may be gone
        pass


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the working folders made inside: for a block that writes or collects what it computes."""
    before = list(_made)
    try:
        yield
    finally:
        release(spark, before)


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written as a table in the shared folder and read again: cuts the lineage, survives the loss of executors."""
    path = work_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """df with a broadcast hint if rows, counted by the caller, stay under BROADCAST_BYTES; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a context, so that their functions are found wherever the job was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="barloom-ship-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "barloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join("barloom", os.path.relpath(full, here)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def default_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", "8"))
