"""Implausible readings: spikes, frozen feeds and impossible values, each judged against its own series.

Spikes. A reading's excursion is how far its open, high or low lies from the bars of both the slot before and the slot after. Its seasonal residual is what is left in units of the series' median bar width when the hour's usual excursion is taken away and the hour's usual bar width is divided out. A generalised Pareto tail is fitted to the peaks of the residuals over the ninth decile of each series, and its quantile at a fixed risk is the series' cutoff. The fit takes two quantiles of the peaks instead of their moments, so spikes, which are peaks themselves, can't lift the cutoff while they are fewer than a third of the peaks; a series leans on the typical tail of its group, the more the fewer its peaks, and for the tail's shape most.
Frozen feeds are runs of unchanged bars, and impossible values follow from rules on one row.

Repeated readings of a slot are made one before anything else. Series are cut into chunks of slots: neighbours, positions and unchanged values inside a chunk come from windows over the chunk, all in one shuffle; what lies at its borders comes from a table with a row a chunk. So no window holds a whole series. Only the readings that stand out are joined back to the rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.quantiles import exact_median
from barloom.session import small, stored

#: Slots in a chunk of a series.
CHUNK = 1024
KEY = ["s", "g"]
BAR = ["open", "high", "low"]
#: Peaks are residuals above this quantile; of what they are above it these two quantiles give the tail, the second at the squared survival of the first.
PEAK, LOWER, UPPER = 0.9, 0.4, 0.64
#: Peaks at which a series' own threshold and scale, and its own shape, count as much as its group's (a shape takes many more peaks to know), and at which a group's shape counts as much as that of an exponential tail; readings at which an hour's own season counts half, and the least peaks of a series that tells about its group.
LEAN, LEAN_SHAPE, LEAN_GROUP, HOUR, TELLS = 200, 1000, 200, 20, 10
#: Bounds of the tail's shape.
SHAPES = (-0.5, 0.4)


def _div(x: Column, n: Column) -> Column:
    return F.call_function("div", x - F.pmod(x, n), n)


def bars_in_chunks(rows: DataFrame) -> DataFrame:
    """The distinct bars with a price of each slot, with n_traded readings that have trades, rn (the slot's number in its chunk), the hulls of the slots before and after in the chunk, null at its ends, and whether the bar may be part of a run: the same values stand in the slot before or after, or the slot lies at an end of the chunk."""
    lo, hi = F.least(*BAR), F.greatest(*BAR)
    bars = rows.where(F.coalesce(*BAR).isNotNull()).groupBy(*KEY, _div(F.col("slot"), F.col("ms") * CHUNK).alias("chunk"), "slot", *BAR).agg(F.count(F.when(F.col("traded"), 1)).alias("n_traded"))
    by = Window.partitionBy(*KEY, "chunk")
    bars = bars.repartition(*KEY, "chunk").withColumns({"lo": lo, "hi": hi, "rn": F.dense_rank().over(by.orderBy("slot"))})
    near = lambda d: by.orderBy("rn").rangeBetween(d, d)
    bars = bars.withColumns({f"{n}_{c}": f(c).over(near(d)) for n, d in (("before", -1), ("after", 1)) for c, f in (("lo", F.min), ("hi", F.max))})
    same = Window.partitionBy(*KEY, "chunk", *BAR).orderBy("rn")
    beside = (F.lag("rn").over(same) == F.col("rn") - 1) | (F.lead("rn").over(same) == F.col("rn") + 1)
    may = (F.col("n_traded") > 0) & (F.coalesce(beside, F.lit(False)) | F.col("before_lo").isNull() | F.col("after_lo").isNull())
    return bars.withColumn("may_run", may)


def with_borders(bars: DataFrame) -> DataFrame:
    """bars with the hulls that lie in the next chunks, and rank, the slot's number in the series."""
    at = lambda c, end: F.max_by(c, end * F.col("rn"))
    chunks = bars.where("before_lo is null or after_lo is null").groupBy(*KEY, "chunk", "rn").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    chunks = chunks.groupBy(*KEY, "chunk").agg(*[at(c, -1).alias(f"first_{c}") for c in ("lo", "hi")], *[at(c, 1).alias(f"last_{c}") for c in ("lo", "hi")], F.max("rn").alias("n"))
    w = Window.partitionBy(*KEY).orderBy("chunk")
    chunks = chunks.select(*KEY, "chunk", *[F.lag(f"last_{c}").over(w).alias(f"c_before_{c}") for c in ("lo", "hi")], *[F.lead(f"first_{c}").over(w).alias(f"c_after_{c}") for c in ("lo", "hi")], F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    chunks = stored(chunks, "chunks")
    got = bars.join(small(chunks, chunks.count(), 128), [*KEY, "chunk"])
    sides = {f"{n}_{c}": F.coalesce(f"{n}_{c}", f"c_{n}_{c}") for n in ("before", "after") for c in ("lo", "hi")}
    return got.withColumns(sides).withColumn("rank", F.col("offset") + F.col("rn")).drop("offset", *[f"c_{n}" for n in sides])


def excursion() -> Column:
    """How far the farthest of open, high and low lies from the hulls on both sides; 0 if none is outside both, or a side is missing."""
    away = lambda v, side: F.greatest(F.col(f"{side}_lo") - F.col(v), F.col(v) - F.col(f"{side}_hi"), F.lit(0.0))
    each = [F.when(F.col(v).isNotNull(), F.least(away(v, "before"), away(v, "after"))) for v in BAR]
    return F.when(F.col("before_lo").isNotNull() & F.col("after_lo").isNotNull(), F.coalesce(F.greatest(*each), F.lit(0.0))).otherwise(F.lit(0.0))


def frozen(bars: DataFrame, least: int) -> DataFrame:
    """(s, g, slot, open, high, low) of the bars that are part of a run of at least `least` successive ranks with the same three values. Runs are found in blocks of ranks with an overlap of least - 1 on either side, so one that crosses a border is seen whole enough."""
    bars = bars.where("open is not null and high is not null and low is not null").select(*KEY, "slot", "rank", *BAR)
    b, r, halo = _div(F.col("rank"), F.lit(CHUNK)), F.pmod("rank", F.lit(CHUNK)), least - 1
    blocks = F.array_compact(F.array(b, F.when(r < halo, b - 1), F.when(r >= CHUNK - halo, b + 1)))
    key = [*KEY, "block", *BAR]
    spread = bars.withColumn("home", b).withColumn("block", F.explode(blocks))
    isle = F.col("rank") - F.row_number().over(Window.partitionBy(*key).orderBy("rank"))
    runs = spread.withColumn("isle", isle).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key, "isle")))
    return runs.where((F.col("n") >= least) & (F.col("home") == F.col("block"))).select(*KEY, "slot", *BAR)


def seasons(bars: DataFrame) -> DataFrame:
    """(s, g, phase, usual, level): for each hour of a series how wide its bars are, against the series' width, and its usual excursion in widths. An hour with few readings leans on 1 and 0."""
    each = bars.groupBy(*KEY, "phase").agg(F.percentile_approx("bar", 0.5, 200).alias("bar"), F.percentile_approx("x", 0.5, 200).alias("x"), F.count(F.lit(1)).alias("n"), F.max("width").alias("width"))
    own = F.col("n") / (F.col("n") + HOUR)
    ratio = F.greatest(F.lit(0.125), F.least(F.lit(8.0), F.col("bar") / F.col("width")))
    return each.where("width > 0").select(*KEY, "phase", F.coalesce(F.exp(own * F.log(ratio)), F.lit(1.0)).alias("usual"), (own * F.col("x") / F.col("width")).alias("level"))


def tails(residuals: DataFrame, risk: float) -> DataFrame:
    """(s, g, tail): the residual that a reading of the series exceeds with the probability risk. residuals: (s, g, e)."""
    level = residuals.groupBy(*KEY).agg(F.percentile_approx("e", PEAK, 1000).alias("u"), F.count(F.lit(1)).alias("n"))
    level = stored(level, "levels")
    over = residuals.join(small(level, level.count(), 80), KEY).where("e > u").groupBy(*KEY).agg(F.percentile_approx(F.col("e") - F.col("u"), [LOWER, UPPER], 1000).alias("q"), F.count(F.lit(1)).alias("k"))
    one, two = F.col("q")[0], F.col("q")[1]
    shape = F.greatest(F.lit(SHAPES[0]), F.least(F.lit(SHAPES[1]), F.log(two / one - 1) / -math.log(1 - LOWER)))
    fits = level.join(over, KEY, "left").withColumn("shape", F.when((one > 0) & (two > one), _not_zero(shape)))
    fits = fits.withColumn("size", F.when(F.col("shape").isNotNull(), F.log(two * F.col("shape") / (F.pow(F.lit(1 - UPPER), -F.col("shape")) - 1))))
    fits = stored(fits.select(*KEY, "u", "n", "k", "shape", "size"), "fits")
    mid = lambda c: F.percentile_approx(c, 0.5, 1000).alias(f"g_{c}")
    group = stored(fits.where((F.col("k") >= TELLS) & F.col("shape").isNotNull()).groupBy("g").agg(mid("u"), mid("shape"), mid("size"), F.sum("k").alias("g_k")), "groups")
    group = group.withColumn("g_shape", F.col("g_shape") * F.col("g_k") / (F.col("g_k") + LEAN_GROUP)).drop("g_k")
    both = fits.join(small(group, group.count(), 80), "g", "left")
    own = lambda n: F.when(F.col("shape").isNotNull(), F.col("k") / (F.col("k") + n)).otherwise(F.lit(0.0))
    lean = lambda c, n: F.coalesce(own(n) * F.coalesce(F.col(c), F.lit(0.0)) + (1 - own(n)) * F.col(f"g_{c}"), F.col(c))
    both = both.select(*KEY, lean("u", LEAN).alias("u"), _not_zero(lean("shape", LEAN_SHAPE)).alias("shape"), F.exp(lean("size", LEAN)).alias("size"), F.coalesce(F.when(F.col("shape").isNotNull(), F.col("k") / F.col("n")), F.lit(1 - PEAK)).alias("rate"))
    tail = F.col("u") + F.col("size") / F.col("shape") * (F.pow(F.least(F.lit(1.0), F.lit(risk) / F.col("rate")), -F.col("shape")) - 1)
    return both.select(*KEY, tail.alias("tail"))


def _not_zero(shape: Column) -> Column:
    return F.when(F.abs(shape) < 1e-6, F.lit(1e-6)).otherwise(shape)


def implausible(readings: DataFrame, risk: float = 1e-4, ceiling: float = 8.0, least: int = 6) -> DataFrame:
    """(id, s, g, x, cut, width, spike, extreme, stuck, impossible, mistimed) for each reading.

    readings: (id, s, g, ms, slot, instant, open, high, low, close_time, trade_count): the series is (s, g), ms the length of its slots, close_time in ms. Readings with a null in s, g, slot or ms belong to no series and are left out; repeated readings each get their flags; other columns are ignored.
    width: the median of high - low over the series' readings with trades.
    spike: the excursion is above the cutoff at the fixed risk for that series and hour; x is the excursion and cut that cutoff, both null where no rule on excursions holds. A larger risk gives lower cutoffs and more spikes.
    extreme: the excursion is above ceiling * width, a plain rule beside the fit that neither limits nor replaces it. stuck: part of a run of `least` successive slots with unchanged open, high and low and trades. impossible: a price that is zero or negative, high below low, or open outside low to high. mistimed: close_time not after the instant, or a length off ms by more than half.
    Nulls and NaN make no flag true. A series without traded readings has no width and no spikes; in one whose width is 0 every excursion is one; where neither the series nor its group has peaks enough for a tail, the cutoff is ceiling * width. Ties: runs and hulls treat equal readings of a slot as one. Empty input: no rows.
    """
    o, h, low = F.col("open"), F.col("high"), F.col("low")
    length = F.try_subtract(F.col("close_time"), F.col("instant"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    any_of = lambda cs: reduce(lambda a, b: a | b, [yes(c) for c in cs])
    num = lambda c: F.when(~F.isnan(F.col(c)), F.col(c)).alias(c)
    rows = readings.where("s is not null and g is not null and slot is not null and ms is not null")
    rows = rows.select("id", *KEY, "ms", "slot", "instant", num("open"), num("high"), num("low"), "close_time", yes(F.col("trade_count") > 0).alias("traded"))
    rows = rows.withColumns({
        "impossible": any_of([o <= 0, h <= 0, low <= 0, h < low, o < low, o > h]),
        "mistimed": any_of([F.col("close_time") <= F.col("instant"), F.abs(length + 1 - F.col("ms")) > F.col("ms") / 2]),
    }).drop("instant", "close_time")
    rows = stored(rows, "readings")
    widths = stored(exact_median(rows.where("traded").withColumn("bar", h - low), KEY, "bar", "width").drop("n"), "widths")
    n_series = widths.count()
    bars = with_borders(stored(bars_in_chunks(rows), "bars")).join(small(widths, n_series, 64), KEY, "left")
    bars = bars.select(*KEY, "slot", "rank", *BAR, "may_run", "width", excursion().alias("x"), F.when(F.col("n_traded") > 0, h - low).alias("bar"), F.pmod(_div(F.col("slot"), F.lit(3_600_000)), F.lit(24)).alias("phase"))
    bars = stored(bars, "excursions")

    season = stored(seasons(bars), "season")
    n_season = season.count()
    x = bars.join(small(season, n_season, 80), [*KEY, "phase"], "left").withColumns({"usual": F.coalesce("usual", F.lit(1.0)), "level": F.coalesce("level", F.lit(0.0))})
    residual = (F.col("x") / F.col("width") - F.col("level")) / F.col("usual")
    limits = tails(x.where("width > 0").select(*KEY, residual.alias("e")), risk)
    limits = stored(limits, "limits")
    fitted = (F.col("tail") * F.col("usual") + F.col("level")) * F.col("width")
    cut = F.when(F.col("width") == 0, F.lit(0.0)).otherwise(F.coalesce(fitted, F.col("width") * ceiling))
    x = x.join(small(limits, n_series, 64), KEY, "left").withColumn("cut", cut)
    far = x.where((F.col("x") > F.col("cut")) | (F.col("x") > F.col("width") * ceiling)).select(*KEY, "slot", *BAR, "x", "cut", "width")
    runs = frozen(bars.where("may_run"), least).select("*", F.lit(True).alias("stuck"))
    marks = far.unionByName(runs, allowMissingColumns=True).groupBy(*KEY, "slot", *BAR).agg(*[F.max(c).alias(c) for c in ("x", "cut", "width", "stuck")])
    marks = stored(marks, "marks")
    marks, on = small(marks, marks.count(), 120).alias("m"), reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) if c in BAR else F.col(f"r.{c}") == F.col(f"m.{c}") for c in [*KEY, "slot", *BAR]])
    out = rows.alias("r").join(marks, on, "left")
    return out.select(
        "id", "r.s", "r.g", "x", "cut", "width",
        yes(F.col("x") > F.col("cut")).alias("spike"),
        yes(F.col("x") > F.col("width") * ceiling).alias("extreme"),
        (yes(F.col("stuck")) & F.col("traded")).alias("stuck"),
        "impossible", "mistimed",
    )
