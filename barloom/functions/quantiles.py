"""Exact quantiles by key without bringing a key's values into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import small, stored

#: Values of a key that one task may order.
BOUND = 65_536
#: Cells that one step cuts a bracket into.
GRID = 128


def _counted(v: DataFrame, brackets: DataFrame, keys: list[str], n_keys: int) -> DataFrame:
    """(*keys, lo, hi, n, below, inside): how many values lie below and in each key's bracket."""
    x = v.join(small(brackets, n_keys, 96), keys)
    lo, hi = F.col("_lo"), F.col("_hi")
    return x.groupBy(*keys).agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("n").alias("n"), F.count(F.when(F.col("_v") < lo, 1)).alias("below"), F.count(F.when((F.col("_v") >= lo) & (F.col("_v") <= hi), 1)).alias("inside"))


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """(*keys, out, n): the exact median of value for each key, halfway between the middle two where their number is even; n is the number of values. Nulls don't count; a key without values has no row.

    An approximate sketch brackets the median (2 in 100 of the ranks, with an error of 1 in 1000). A key with more than BOUND values in its bracket gets a narrower one from a sketch of those values, checked by exact counts, until it has no more or all of them are equal; a bracket that proves wrong is not taken. Only then are the values in the brackets counted and ordered, so no key brings more than BOUND different values to a task."""
    v = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    q = F.percentile_approx("_v", [0.49, 0.51], 1000)
    brackets = v.groupBy(*keys).agg(q.alias("_q"), F.count(F.lit(1)).alias("n")).select(*keys, F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"), "n")
    brackets = stored(brackets, "brackets")
    n_keys, most = brackets.agg(F.count(F.lit(1)), F.max("n")).first()
    if (most or 0) * 0.02 > BOUND:
        brackets = _narrowed(v, brackets, keys, n_keys)
    placed = v.join(small(brackets, n_keys, 96), keys)
    inside = placed.withColumn("_v", F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).where("_v is null or _v <= _hi")
    counted = inside.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), F.max("n").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    at = counted.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    k1, k2 = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    hit = lambda k: F.max(F.when((F.col("_before") <= k) & (k < F.col("_before") + F.col("_c")), F.col("_v")))
    return at.groupBy(*keys).agg(((hit(k1) + hit(k2)) / 2).alias(out), F.max("n").alias("n"))


def _narrowed(v: DataFrame, brackets: DataFrame, keys: list[str], n_keys: int) -> DataFrame:
    """brackets with those of more than BOUND values made narrower, from the keys' values v."""
    done = None
    k1, k2 = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    wide = stored(_counted(v, brackets, keys, n_keys), "brackets")
    while True:
        big = (F.col("inside") > BOUND) & (F.col("_lo") < F.col("_hi"))
        rest = wide.where(~big).select(*keys, "_lo", "_hi", "n")
        done = rest if done is None else done.unionByName(rest)
        wide = wide.where(big)
        n_wide = wide.count()
        if not n_wide:
            return done
        steps = [i / GRID for i in range(GRID + 1)]
        x = v.join(small(wide.select(*keys, F.col("_lo").alias("_a"), F.col("_hi").alias("_b")), n_wide, 96), keys).where("_v between _a and _b")
        cells = x.groupBy(*keys).agg(F.percentile_approx("_v", steps, 10_000).alias("_q"))
        at = lambda k: F.floor((k - F.col("below")) / F.col("inside") * GRID).cast("int")
        pick = lambda i: F.element_at("_q", F.greatest(F.lit(1), F.least(F.lit(GRID + 1), i + 1)))
        tried = cells.join(wide, keys).select(*keys, pick(at(k1) - 1).alias("_lo"), pick(at(k2) + 2).alias("_hi"), "n", F.col("_lo").alias("_a"), F.col("_hi").alias("_b"), F.col("inside").alias("_old"))
        tried = stored(tried, "brackets")
        got = _counted(v, tried.select(*keys, "_lo", "_hi", "n"), keys, n_wide).join(tried.select(*keys, "_a", "_b", "_old"), keys)
        # A bracket counts only if the median lies in it; one that is no narrower is taken as it is.
        right = (F.col("below") <= k1) & (k2 < F.col("below") + F.col("inside"))
        got = stored(got.withColumn("_right", right), "brackets")
        lost = got.where(~F.col("_right") | (F.col("inside") >= F.col("_old")))
        done = done.unionByName(lost.select(*keys, F.col("_a").alias("_lo"), F.col("_b").alias("_hi"), "n"))
        wide = got.where(F.col("_right") & (F.col("inside") < F.col("_old"))).drop("_a", "_b", "_old", "_right")
