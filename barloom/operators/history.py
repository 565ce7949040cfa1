"""History of changing entity attributes from snapshots: the versions of each entity and the time each one held.

The snapshots are co-partitioned: all are cut at the same (entity, time) ranges, and what a snapshot has in a range is stored as one run sorted by entity. A task merges the runs of a range with an iterator each, a block of rows a run at a time, and hands the merged rows on in order; versions leave as soon as the next payload closes them. No entity's history is held in memory, only a block of each run and one open version. Ranges are cut by time and delivery as well as by entity, so an entity with a third of all rows is spread over many tasks; the open version at each cut comes from a first pass over the entities that lie across one, which sends one row a task to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import ship, work_dir
from barloom.storage import arrow_place

#: Rows of a range, runs of a range at most (more snapshots share runs, the consecutive ones), and rows of a run's block.
RANGE_ROWS, RUNS, BLOCK = 500_000, 64, 8192


def _known(part: pd.DataFrame, attrs: list[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Last known value of each attribute at each row, and where it differs from the last known one before."""
    by = part["entity"]
    known = part.groupby(by, sort=False)[attrs].ffill()
    prev = known.groupby(by, sort=False).shift()
    return known, known.notna() & prev.notna() & (known != prev)


def _last(block: pd.DataFrame) -> tuple[str, int]:
    return block["entity"].iat[-1], int(block["time"].iat[-1])


def _before(block: pd.DataFrame, key: tuple[str, int]) -> int:
    """How many rows of a sorted block come no later than key."""
    e = block["entity"].to_numpy()
    lo, hi = np.searchsorted(e, key[0]), np.searchsorted(e, key[0], "right")
    return int(lo + np.searchsorted(block["time"].to_numpy()[lo:hi], key[1], "right"))


def _run(folder: str, name: str, attrs: list[str], only: str | None) -> Iterator[pd.DataFrame]:
    """The blocks of a run, each with all rows of its last key, of which the last one holds; of one entity if asked."""
    import pyarrow.parquet as pq

    system, place = arrow_place(f"{folder}/{name}")
    with system.open_input_file(place) as f:
        rest = None
        for batch in pq.ParquetFile(f).iter_batches(BLOCK, columns=["entity", "time", *attrs]):
            block = batch.to_pandas()
            if only is not None:
                block = block[(block["entity"] == only).to_numpy()]
            if rest is not None:
                block = pd.concat([rest, block], ignore_index=True)
            if block.empty:
                continue
            rest = block.iloc[-1:]
            n = len(block) - 1
            key = _last(block)
            while n and (block["entity"].iat[n - 1], int(block["time"].iat[n - 1])) == key:
                n -= 1
            if n:
                yield block.iloc[:n]
        if rest is not None:
            yield rest


def merged(folder: str, attrs: list[str], only: str | None = None, without: tuple[str, int] | None = None) -> Iterator[pd.DataFrame]:
    """The runs of a range merged by (entity, time), in blocks; of equal keys, which lie in one run, the last. only: of that entity; without: but for that key."""
    from pyarrow import fs

    system, place = arrow_place(folder)
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True, recursive=True))
    names = sorted(i.path[len(place) :].lstrip("/") for i in found if i.type == fs.FileType.File and i.path.endswith(".parquet"))
    runs = [_run(folder, n, attrs, only) for n in names]
    heads = [next(r, None) for r in runs]
    while any(h is not None for h in heads):
        # Up to the earliest end of a block, every run's rows are at hand.
        bound = min(_last(h) for h in heads if h is not None)
        taken = []
        for i, h in enumerate(heads):
            if h is None:
                continue
            n = _before(h, bound)
            if n:
                taken.append(h.iloc[:n])
                heads[i] = h.iloc[n:] if n < len(h) else next(runs[i], None)
        out = pd.concat(taken, ignore_index=True) if len(taken) > 1 else taken[0].reset_index(drop=True)
        out = out.sort_values(["entity", "time"], kind="stable", ignore_index=True)
        out = out[~out.duplicated(["entity", "time"], keep="last")]
        if without is not None:
            out = out[~((out["entity"] == without[0]) & (out["time"] == without[1]))]
        if len(out):
            yield out.reset_index(drop=True)


def _summary(attrs: list[str], blocks: Iterator[pd.DataFrame]) -> dict | None:
    """What an entity's rows in a range do to an open version."""
    s: dict = {}
    for part in blocks:
        if s:
            head = pd.DataFrame([{"entity": part["entity"].iat[0], "time": s["time"], **{a: s["last"][a] for a in attrs}}]).astype({a: object for a in attrs})
            known, changed = _known(pd.concat([head, part], ignore_index=True), attrs)
            times = pd.concat([head["time"], part["time"]], ignore_index=True)
        else:
            s = {"begin": int(part["time"].iloc[0]), "seen": {a: None for a in attrs}, "when": {a: None for a in attrs}, "last": {}, "change": None}
            known, changed = _known(part, attrs)
            times = part["time"]
        for a in attrs:
            if s["when"][a] is None and len(at := part[a].dropna()):
                s["seen"][a], s["when"][a] = at.iloc[0], int(part["time"].loc[at.index[0]])
            s["last"][a] = None if pd.isna(known[a].iloc[-1]) else known[a].iloc[-1]
        hit = times[changed.any(axis=1)]
        s["change"] = int(hit.iloc[-1]) if len(hit) else s["change"]
        s["time"] = int(times.iloc[-1])
    return s or None


def _open_versions(rows: list[dict], attrs: list[str]) -> tuple[dict[int, dict], set[int]]:
    """The version that is open before each range that goes on with the entity of the range before, and the ranges whose last entity goes on. rows: each range's number, first and last entity, and its summary where the last one goes on."""
    before, goes_on, state, prev = {}, set(), None, None
    for r in sorted(rows, key=lambda r: r["part"]):
        on = prev is not None and prev["last"] == r["first"]
        if on:
            before[r["part"]] = state
            goes_on.add(prev["part"])
        old = state if on and r["first"] == r["last"] else None
        if r.get("begin") is not None:
            start = r["begin"] if old is None else old["valid_from"]
            for a in attrs:
                if old is not None and old[a] is not None and r[f"w_{a}"] is not None and r[f"s_{a}"] != old[a]:
                    start = max(start, r[f"w_{a}"])
            if r["change"] is not None:
                start = max(start, r["change"])
            state = {"entity": r["last"], "valid_from": start} | {a: r[f"l_{a}"] if r[f"l_{a}"] is not None or old is None else old[a] for a in attrs}
        prev = r
    return before, goes_on


def _versions(attrs: list[str], blocks: Iterator[pd.DataFrame], state: dict | None, goes_on: bool) -> Iterator[pd.DataFrame]:
    for part in blocks:
        part = part.assign(valid_from=part["time"])
        if state is not None:  # the open version as a row before the block
            head = pd.DataFrame([{"entity": state["entity"], "time": state["valid_from"], "valid_from": state["valid_from"], **{a: state[a] for a in attrs}}])
            part = pd.concat([head.astype({a: object for a in attrs}), part], ignore_index=True)
        known, changed = _known(part, attrs)
        new_entity = part["entity"] != part["entity"].shift()
        start = new_entity | changed.any(axis=1)
        # The payload of a version is what is known at its end: a null filled by a later row belongs to it.
        number = start.cumsum()
        last = known.groupby(number).last()
        v = part.loc[start, ["entity", "valid_from"]].reset_index(drop=True)
        for a in attrs:
            v[a] = last[a].to_numpy()
        same = v["entity"] == v["entity"].shift(-1)
        v["valid_to"] = v["valid_from"].shift(-1).where(same).astype("Int64")
        tail = v.iloc[-1]
        state = {"entity": tail["entity"], "valid_from": int(tail["valid_from"])} | {a: None if pd.isna(last[a].iloc[-1]) else last[a].iloc[-1] for a in attrs}
        yield v.iloc[:-1][["entity", "valid_from", "valid_to", *attrs]]
    if state is not None and not goes_on:
        v = pd.DataFrame([state | {"valid_to": None}]).astype({"valid_to": "Int64"})
        yield v[["entity", "valid_from", "valid_to", *attrs]]


def _stored_runs(snapshots: DataFrame, attrs: list[str], received: list[str], parts: int | None) -> tuple[str, int]:
    """Writes the sorted runs of all ranges; their folder and the number of ranges."""
    order = [f"_r{i}" for i in range(len(received))]
    rows = snapshots.where("entity is not null and time is not null").select(F.col("entity").cast("string").alias("entity"), F.col("time").cast("long").alias("time"), *[F.col(c).alias(o) for c, o in zip(received, order, strict=True)], *[F.col(a).cast("string").alias(a) for a in attrs])
    n, different, cuts = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*rows.columns), 0.02), F.percentile_approx("time", [i / RUNS for i in range(1, RUNS)], 10_000)).first()
    if n > 1.25 * different:  # many plain copies: made one where they lie, before they are sent anywhere
        rows, n = rows.distinct(), different
    ranges = parts or max(1, math.ceil(n / RANGE_ROWS))
    cuts = sorted(set(cuts or []))
    run = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("time"))) if cuts else F.lit(0)
    key = ["entity", "time", *order, *attrs]
    path = work_dir(snapshots.sparkSession, "runs")
    cut = rows.repartitionByRange(ranges, *key).withColumns({"_range": F.spark_partition_id(), "_run": run})
    cut.sortWithinPartitions("_range", "_run", *key).drop(*order).write.partitionBy("_range", "_run").parquet(path)
    return path, ranges


def history(snapshots: DataFrame, attrs: list[str], received: list[str], parts: int | None = None) -> DataFrame:
    """(entity, valid_from, valid_to, *attrs): the versions of each entity; valid_to is the start of the next version, null for the last.

    snapshots: (entity, time, *attrs, *received); attrs as strings in one spelling for each meaning. Of several rows of an entity and time the one with the largest received columns holds, then that with the largest attributes; exact copies of it are one. A null attribute tells nothing: it changes nothing, and the version carries the last known value. Absence from a snapshot changes nothing. Rows without entity or time are left out. Empty input: no versions. Other columns are ignored. parts: the number of ranges; by default one for RANGE_ROWS rows.
    """
    spark = snapshots.sparkSession
    ship(spark)
    path, ranges = _stored_runs(snapshots, attrs, received, parts)
    before: dict[int, dict] = {}
    goes_on: set[int] = set()
    without: dict[int, tuple[str, int]] = {}
    if ranges > 1:
        stored = spark.read.schema(T.StructType([T.StructField("entity", T.StringType()), T.StructField("time", T.LongType()), T.StructField("_range", T.IntegerType())])).parquet(path)
        key = F.struct("entity", "time")
        ends = [r.asDict() for r in stored.groupBy(F.col("_range").alias("part")).agg(F.min(key).alias("a"), F.max(key).alias("b")).orderBy("part").collect()]
        # A key whose deliveries lie across a cut: the last range that has it holds.
        for one, two in zip(ends, ends[1:], strict=False):
            if one["b"] == two["a"]:
                without[one["part"]] = (one["b"]["entity"], one["b"]["time"])
        rows = [{"part": r["part"], "first": r["a"]["entity"], "last": r["b"]["entity"]} for r in ends if not (r["part"] in without and r["a"] == r["b"])]
        asked = [(one["part"], one["last"]) for one, two in zip(rows, rows[1:], strict=False) if one["last"] == two["first"]]
        if asked:
            s = [T.StructField(f"{k}_{a}", T.LongType() if k == "w" else T.StringType()) for k in "swl" for a in attrs]
            shape = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("begin", T.LongType()), T.StructField("change", T.LongType()), *s])

            def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for b in batches:
                    for part, entity in zip(b["part"], b["entity"], strict=True):
                        s = _summary(attrs, merged(f"{path}/_range={part}", attrs, entity, without.get(part)))
                        if s is not None:
                            row = {"part": part, "begin": s["begin"], "change": s["change"]}
                            yield pd.DataFrame([row | {f"s_{a}": s["seen"][a] for a in attrs} | {f"w_{a}": s["when"][a] for a in attrs} | {f"l_{a}": s["last"][a] for a in attrs}]).astype({"change": "Int64", **{f"w_{a}": "Int64" for a in attrs}})

            todo = spark.createDataFrame(asked, "part int, entity string").repartition(len(asked))
            got = {r["part"]: r.asDict() for r in todo.mapInPandas(sums, shape).collect()}
            rows = [r | got.get(r["part"], {}) for r in rows]
        before, goes_on = _open_versions(rows, attrs)

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in b["id"]:
                yield from _versions(attrs, merged(f"{path}/_range={part}", attrs, None, without.get(part)), before.get(part), part in goes_on)

    out = T.StructType([T.StructField("entity", T.StringType()), T.StructField("valid_from", T.LongType()), T.StructField("valid_to", T.LongType()), *[T.StructField(a, T.StringType()) for a in attrs]])
    return spark.range(0, ranges, 1, ranges).mapInPandas(close, out)
