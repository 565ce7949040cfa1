"""Attributes as known at event time: snapshots at regular times plus a log of changes, joined to events by equality.

For each entity and each period that events touch, the state at the period's start is materialised, and beside it the changes inside the period in order of time. An event then needs one equality join on (entity, period) and a replay of the few changes before its own time; nothing that became valid later can reach it. The period is an entity's own: the longest in which it has no more than max_log changes, so the log beside a snapshot stays short however often an entity changes, and a busy entity multiplies no other one's snapshots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import small, stored

#: The longest and the shortest period between snapshots, in ms; powers of two.
LONGEST, SHORTEST = 1 << 33, 1 << 14


def iso_millis(c: Column) -> Column:
    """Epoch ms of a point in time in ISO 8601, by its own offset, or UTC where it has none. Null for null, blank or unreadable text."""
    x = F.trim(c)
    x = F.when(x.rlike(r"(?i)(z|[+-]\d{2}(:?\d{2})?)$") & x.rlike(r"\d:\d"), x).when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(x, F.lit("T00:00:00Z"))).when(x != "", F.concat(x, F.lit("Z")))
    return F.unix_millis(F.try_to_timestamp(x))


def change_log(versions: DataFrame) -> DataFrame:
    """(entity, at, state) for versions (entity, valid_from, valid_to, state): state at its start, a null state at its end. One change for each entity and time: a start counts before an end, and of several starts the largest state. Versions without entity or valid_from, and those that end no later than they start, say nothing."""
    ok = versions.where("entity is not null and valid_from is not null").where("valid_to is null or valid_to > valid_from")
    on = ok.select("entity", F.col("valid_from").alias("at"), F.struct(F.lit(1).alias("rank"), "state").alias("c"))
    off = ok.where("valid_to is not null").select("entity", F.col("valid_to").alias("at"), F.struct(F.lit(0).alias("rank"), F.lit(None).cast(versions.schema["state"].dataType).alias("state")).alias("c"))
    return on.unionByName(off).groupBy("entity", "at").agg(F.max("c").alias("c")).select("entity", "at", F.col("c.state").alias("state"))


def busy_lengths(log: DataFrame, max_log: int) -> tuple[DataFrame, int]:
    """((entity, length), their number): the periods of the entities that have more than max_log changes in some period of LONGEST; all others keep that."""
    lengths = [LONGEST]
    while lengths[-1] // 16 >= SHORTEST:
        lengths.append(lengths[-1] // 16)
    often = log.groupBy("entity").count().where(F.col("count") > max_log).select("entity")
    each = log.join(often, "entity", "left_semi").select("entity", "at", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("length"))
    most = each.groupBy("entity", "length", _period(F.col("at"), F.col("length")).alias("p")).count().groupBy("entity", "length").agg(F.max("count").alias("most"))
    fits = F.max(F.when(F.col("most") <= max_log, F.col("length")))
    out = stored(most.groupBy("entity").agg(F.coalesce(fits, F.lit(lengths[-1])).alias("length")).where(F.col("length") < LONGEST), "lengths")
    return out, out.count()


def _period(t: Column, length: Column) -> Column:
    return F.call_function("div", t - F.pmod(t, length), length)


def as_known(events: DataFrame, versions: DataFrame, max_log: int = 64) -> DataFrame:
    """events (entity, time in ms, any other columns) with a column state: that of the version of the entity whose period [valid_from, valid_to) holds the time, or null.

    Events without entity or time get null. Events repeat as they are given. versions of one entity should not overlap; where they do, the latest change before the event counts. Empty versions: all states are null; empty events: no rows. Columns of events named state or _ak_... are replaced.
    """
    events = events.drop("state", "_ak_entity", "_ak_p", "_ak_start", "_ak_log", "_ak_length", "_ak_busy")
    log = stored(change_log(versions), "changes")
    lengths, n_busy = busy_lengths(log, max_log)
    # Where no entity is busy, nothing is joined.
    length = F.coalesce(F.col("_ak_length"), F.lit(LONGEST)) if n_busy else F.lit(LONGEST)
    busy = lengths.select(F.col("entity").alias("_ak_busy"), F.col("length").alias("_ak_length"))
    own = lambda df: df.join(small(busy, n_busy, 64), F.col("entity") == F.col("_ak_busy"), "left").drop("_ak_busy") if n_busy else df
    log = own(log).select("entity", "at", "state", _period(F.col("at"), length).alias("p"))
    asked = own(events.where("entity is not null and time is not null").select("entity", "time")).select("entity", _period(F.col("time"), length).alias("p")).distinct()
    # What each period with changes starts from, and its log.
    steps = log.groupBy("entity", "p").agg(F.array_sort(F.collect_list(F.struct("at", "state"))).alias("log"))
    # Each entity's periods in order, those that events touch and those with changes; the state at a start is the last change of an earlier period.
    both = asked.withColumn("asked", F.lit(True)).join(steps, ["entity", "p"], "full")
    before = Window.partitionBy("entity").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("log").isNotNull(), F.element_at("log", -1))
    snaps = both.withColumn("snapshot", F.last(ends, ignorenulls=True).over(before)).where("asked").select("entity", "p", F.col("snapshot.state").alias("at_start"), "log")
    snaps = stored(snaps.where("at_start is not null or log is not null"), "snapshots")
    n = snaps.count()
    width = 512 if n == 0 else 128 + 64 * (1 + (snaps.agg(F.avg(F.coalesce(F.size("log"), F.lit(0)))).first()[0] or 0))
    side = snaps.select(F.col("entity").alias("_ak_entity"), F.col("p").alias("_ak_p"), F.col("at_start").alias("_ak_start"), F.col("log").alias("_ak_log"))
    out = own(events).join(small(side, n, int(width)), (F.col("entity") == F.col("_ak_entity")) & (_period(F.col("time"), length) == F.col("_ak_p")), "left")
    done = F.filter(F.coalesce(F.col("_ak_log"), F.array().cast(snaps.schema["log"].dataType)), lambda c: c["at"] <= F.col("time"))
    state = F.when(F.size(done) > 0, F.try_element_at(done, F.lit(-1))["state"]).otherwise(F.col("_ak_start"))
    return out.withColumn("state", state).drop("_ak_entity", "_ak_p", "_ak_start", "_ak_log", "_ak_length")
