"""Irregular readings onto a regular grid, with empty slots marked and, where other sources support it, filled.

The grid holds every slot that a catalog of periods promises for a source. Readings take the slot they lie nearest to. Values of empty slots are estimated by low-rank factorisation of the source-by-time matrix of each group (here: each interval): alternating least squares, whose normal equations are sums. Both halves of a step are therefore partially aggregated joins, so neither a source nor a slot that holds a third of all readings ends up in one task, and only the factors of sources, never those of slots, are stored between steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.intervals import ms_of
from barloom.session import small, stored

#: Slots that a task makes, and how many spreads from its source's median a value counts.
TASK_SLOTS, CLIP = 500_000, 4.0
OBSERVED, FILLED, UNSUPPORTED = "observed", "filled", "unsupported"


def promised_slots(catalog: DataFrame, group: str = "interval", source: str = "symbol") -> DataFrame:
    """(source, group, slot) of every slot in a listed period, each once.

    The period is the day or month at the end of zip_name, or else archive_period; a listing with neither, or with an unknown interval, promises nothing. Repeated listings count once, and a day whose month is listed too adds nothing. Columns that the catalog may have besides are ignored. Empty catalog: no slots."""
    period = F.coalesce(F.nullif(F.regexp_extract(F.col("zip_name"), r"-(\d{4}-\d{2}(?:-\d{2})?)\.zip$", 1), F.lit("")), F.col("archive_period"))
    listed = catalog.select(F.col(source), F.col(group), period.alias("period"), ms_of(F.col(group)).alias("ms")).where("period is not null and ms is not null").where(F.col(source).isNotNull()).distinct()
    is_day = F.length("period") == 10
    months = listed.where(~is_day).select(F.col(source).alias("_s"), F.col(group).alias("_g"), F.col("period").alias("_m"))
    days = listed.where(is_day)
    days = days.join(months, (F.col(source) == F.col("_s")) & (F.col(group) == F.col("_g")) & (F.substring("period", 1, 7) == F.col("_m")), "left_anti")
    first = F.try_to_timestamp(F.concat("period", F.when(F.length("period") == 7, "-01").otherwise("")), F.lit("yyyy-MM-dd"))
    each = days.unionByName(listed.where(~is_day)).withColumn("first", F.to_date(first)).where("first is not null")
    last = F.when(F.length("period") == 7, F.last_day("first")).otherwise(F.col("first"))
    # A row a day first, spread over as many tasks as the slots ask for, so that no task makes the slots of whole months.
    each = each.withColumn("last", last)
    slots = each.agg(F.sum((F.datediff("last", "first") + 1) * (86_400_000 / F.col("ms")))).first()[0] or 0
    by_day = each.select(source, group, "ms", F.explode(F.sequence("first", "last")).alias("day"))
    by_day = by_day.repartition(max(1, math.ceil(slots / TASK_SLOTS)), source, group, "day")
    start = F.unix_date("day").cast("long") * 86_400_000
    return by_day.select(source, group, F.explode(F.sequence(start, start + 86_400_000 - F.col("ms"), F.col("ms"))).alias("slot"))


def _solve(n: int, prefix: str) -> list[tuple[str, Column]]:
    """Steps of a Cholesky solution of the n by n system whose lower triangle is in columns a{i}{j} and right side in b{i}: (column, expression) in order; the result is in {prefix}{i}."""
    c, steps = F.col, []
    for i in range(n):
        for j in range(i + 1):
            rest = c(f"a{i}{j}")
            for k in range(j):
                rest = rest - c(f"l{i}{k}") * c(f"l{j}{k}")
            steps.append((f"l{i}{j}", F.sqrt(rest) if i == j else rest / c(f"l{j}{j}")))
    for i in range(n):
        rest = c(f"b{i}")
        for k in range(i):
            rest = rest - c(f"l{i}{k}") * c(f"y{k}")
        steps.append((f"y{i}", rest / c(f"l{i}{i}")))
    for i in reversed(range(n)):
        rest = c(f"y{i}")
        for k in range(i + 1, n):
            rest = rest - c(f"l{k}{i}") * c(f"{prefix}{k}")
        steps.append((f"{prefix}{i}", rest / c(f"l{i}{i}")))
    return steps


def _factors(cells: DataFrame, keys: list[str], given: str, out: str, rank: int, ridge: float) -> DataFrame:
    """For each of keys the least-squares factor out0.. against the factor given0.. of its cells, and its number of cells as {out}n."""
    sums = [F.sum(F.col(f"{given}{i}") * F.col(f"{given}{j}")).alias(f"s{i}{j}") for i in range(rank) for j in range(i + 1)]
    sums += [F.sum(F.col("y") * F.col(f"{given}{i}")).alias(f"b{i}") for i in range(rank)]
    df = cells.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias(f"{out}n"))
    df = df.select("*", *[(F.col(f"s{i}{j}") + (F.lit(ridge) if i == j else F.lit(0.0))).alias(f"a{i}{j}") for i in range(rank) for j in range(i + 1)])
    for name, expr in _solve(rank, out):
        df = df.withColumn(name, expr)
    return df.select(*keys, f"{out}n", *[f"{out}{i}" for i in range(rank)])


def factorise(cells: DataFrame, sources: DataFrame, n_sources: int, rank: int, steps: int, ridge: float) -> tuple[DataFrame, DataFrame]:
    """Alternating least squares over cells (g, s, t, y): factors u0.. of (g, s) and v0.. of (g, t). sources: the distinct (g, s), n_sources of them. The start is a fixed function of the source, so results repeat up to the order of sums."""
    start = [F.lit(1.0).alias("u0")] + [((F.pmod(F.xxhash64("g", "s", F.lit(i)), F.lit(2001)) - 1000) / 1000.0).alias(f"u{i}") for i in range(1, rank)]
    u = sources.select("g", "s", *start)
    width = 16 * (rank + 4)
    for _ in range(steps):
        v = _factors(cells.join(small(u, n_sources, width), ["g", "s"]), ["g", "t"], "u", "v", rank, ridge)
        u = stored(_factors(cells.join(v, ["g", "t"]), ["g", "s"], "v", "u", rank, ridge), "factors")
    v = _factors(cells.join(small(u, n_sources, width), ["g", "s"]), ["g", "t"], "u", "v", rank, ridge)
    return u, v


def regular_grid(readings: DataFrame, slots: DataFrame, rank: int = 2, steps: int = 3, ridge: float = 2.0) -> DataFrame:
    """One row (s, g, slot, value, status, n_readings) for each of slots.

    readings: (s, g, slot, order, value): source, group, the slot a reading lies in, a number that orders readings of one slot (the last valid one counts), and a positive value or null. slots: the promised (s, g, slot), each once.

    status: 'observed' where any reading lies in the slot, whatever its value; its value is exact, the last valid reading, or null if none is valid. 'filled': no reading, and the value is estimated. 'unsupported': no reading and no estimate, because fewer than two other sources have a reading in that slot or the source itself has no more than rank readings in slots that others share; value is null.
    Values are factorised as logarithms less the source's median, in units of its own spread (that of the middle half), at most CLIP of them, so the ridge means the same for calm and wild sources and a wrong value moves little. NaN, infinite, zero and negative values count as readings without value. Rows of readings with a null in s, g or slot fill no slot. Empty readings: every slot is unsupported; empty slots: no rows. Repeated readings, also exact copies, count once. Other columns of either input are ignored.
    """
    valid = F.when((F.col("value") > 0) & ~F.isnan("value") & (F.col("value") < float("inf")), F.col("value"))
    seen = readings.where("s is not null and g is not null and slot is not null").groupBy("s", "g", "slot").agg(F.count(F.lit(1)).alias("n_readings"), F.max_by(valid, F.when(valid.isNotNull(), F.col("order"))).alias("value"))
    seen = stored(seen, "seen")

    # Only slots that at least two sources share tell anything about the sources' relation.
    usable = seen.where("value is not null").select("g", "s", F.col("slot").alias("t"), F.log("value").alias("x"))
    shared = usable.groupBy("g", "t").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("g", "t")
    q = F.percentile_approx("x", [0.25, 0.5, 0.75], 1000)
    means = stored(usable.groupBy("g", "s").agg(q.alias("q")).select("g", "s", F.col("q")[1].alias("mean"), ((F.col("q")[2] - F.col("q")[0]) / 1.349).alias("scale")), "means")
    n_sources = means.count()
    y = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.when(F.col("scale") > 0, (F.col("x") - F.col("mean")) / F.col("scale")).otherwise(F.lit(0.0))))
    cells = stored(usable.join(shared, ["g", "t"], "left_semi").join(small(means, n_sources), ["g", "s"]).select("g", "s", "t", y.alias("y")), "cells")
    u, v = factorise(cells, means.select("g", "s"), n_sources, rank, steps, ridge)

    grid = slots.select("s", "g", "slot").join(seen, ["s", "g", "slot"], "left")
    sources = u.where(F.col("un") > rank).join(means, ["g", "s"])
    v = v.where("vn >= 2")
    est = F.exp(F.col("mean") + F.col("scale") * sum((F.col(f"u{i}") * F.col(f"v{i}") for i in range(1, rank)), F.col("u0") * F.col("v0")))
    empty = grid.where("n_readings is null").select("s", "g", "slot").join(small(sources, n_sources, 16 * (rank + 5)), ["g", "s"], "left").join(v.withColumnRenamed("t", "slot"), ["g", "slot"], "left")
    empty = empty.select("s", "g", "slot", est.alias("value"), F.when(est.isNotNull(), FILLED).otherwise(UNSUPPORTED).alias("status"), F.lit(0).cast("long").alias("n_readings"))
    there = grid.where("n_readings is not null").select("s", "g", "slot", "value", F.lit(OBSERVED).alias("status"), "n_readings")
    return there.unionByName(empty)
