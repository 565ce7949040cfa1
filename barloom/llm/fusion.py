"""One record from several disagreeing copies, field by field, by Bayesian fusion of sources that may copy each other.

Every delivery's archive makes one claim on each field. Claims of an item that agree are one value with the set of sources behind it. In turns, the posterior of every claimed value is computed from the sources' accuracies, with votes of likely copiers discounted; accuracies are re-estimated as the mean posterior of what a source claims; and the probability that two sources depend on each other from how often they share values that are held false, which independent sources seldom do.

A claim is a row, so an item may have any number of them: everything about an item is a partially aggregated sum over its values. A value's row holds its sources, each once, so it is as long as there are sources. Shared values of two sources are counted inside the tasks into one table a task, with a row for two sources that met; no pairs of rows are made. The driver holds the accuracies and the dependences of sources that met, nothing about items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import ship, small, stored

#: Two numbers are the same claim when they differ by no more than this part of the larger.
SAME = 1e-6
#: Plausible false values of a field, prior of dependence, share of a copier's values that are copied.
FALSE_VALUES, PRIOR, COPIED = 50.0, 0.1, 0.8
#: The largest score that is raised to a power as it is; where so many sources could vote for a value that it might be more, all scores are scaled down alike.
MOST = 600.0
ITEM = ["item", "field"]


def same(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= SAME * F.greatest(F.abs(a), F.abs(b))


def collect_claims(rows: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(claims, items). claims: item, copy, source and for each field {field}_v, the copy's last delivered value, and {field}_o, when it came. items: those with at least two copies, with n_copies and for each field {field}_conflict over all their rows (see fuse). Partial sums only, so an item may have any number of rows."""
    value = lambda f: F.when(~F.isnan(f), F.col(f))
    first = []
    for f in fields:
        v = value(f)
        first += [F.max_by(v, F.when(v.isNotNull(), F.col("order"))).alias(f"{f}_v"), F.max(F.when(v.isNotNull(), F.col("order"))).alias(f"{f}_o"), F.min(v).alias(f"{f}_lo"), F.max(v).alias(f"{f}_hi"), F.count(F.when(v.isNull(), 1)).alias(f"{f}_none")]
    by_copy = stored(rows.groupBy("item", "copy").agg(F.max("source").alias("source"), *first), "copies")
    clash = []
    for f in fields:
        lo, hi = F.min(f"{f}_lo"), F.max(f"{f}_hi")
        clash.append(F.coalesce(((F.sum(f"{f}_none") > 0) & hi.isNotNull()) | ~same(hi, lo), F.lit(False)).alias(f"{f}_conflict"))
    items = by_copy.groupBy("item").agg(F.count(F.lit(1)).alias("n_copies"), *clash).where("n_copies >= 2")
    return by_copy.select("item", "copy", "source", *[f"{f}_{k}" for f in fields for k in "vo"]), items


def _cell(v: Column) -> Column:
    """A number's cell on a grid of steps of SAME, the same on both sides of zero."""
    steps = F.when(F.abs(v) == float("inf"), F.lit(9_000_000_000)).otherwise(F.floor(F.log(F.abs(v)) / SAME) + 2_000_000_000)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("long") * steps).cast("long")


def claimed_values(claims: DataFrame, number: DataFrame, n_sources: int) -> DataFrame:
    """(item, field, value, last, sources): the different values of each item, with the numbers of the sources that claim them and when they came last. claims: (item, field, source, v, o).

    Values in one cell of the grid are one claim. A value in an odd cell joins that of the even cell beside it if the two are the same, the nearer of two such; so equal claims meet wherever a border lies, without comparing an item's values with each other."""
    known = claims.join(small(number, n_sources, 64), "source").withColumn("cell", _cell(F.col("v")))
    cells = known.groupBy(*ITEM, "cell").agg(F.max_by("v", F.struct("o", "v")).alias("value"), F.max("o").alias("last"), F.collect_set("i").alias("sources"))
    cells = stored(cells, "cells")
    odd = cells.where("cell % 2 <> 0").select(*ITEM, "cell", F.col("value").alias("v"), F.explode(F.array(F.col("cell") - 1, F.col("cell") + 1)).alias("to"))
    even = cells.where("cell % 2 = 0").select(*ITEM, F.col("cell").alias("to"), F.col("value").alias("w"))
    moves = odd.join(even, [*ITEM, "to"]).where(same(F.col("v"), F.col("w"))).groupBy(*ITEM, "cell").agg(F.min_by("to", F.struct(F.abs(F.col("v") - F.col("w")), "to")).alias("to"))
    moves = stored(moves, "moves")
    n_moves = moves.count()
    if not n_moves:
        return cells.drop("cell")
    cells = cells.join(small(moves, n_moves, 128), [*ITEM, "cell"], "left").withColumn("cell", F.coalesce("to", "cell"))
    return stored(cells.groupBy(*ITEM, "cell").agg(F.max_by("value", F.struct("last", "value")).alias("value"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("sources"))).alias("sources")).drop("cell"), "values")


class Beliefs:
    """What is known about the sources of each field: accuracy[f][i], and depends[f][i, j] for i < j where they met."""

    def __init__(self, fields: list[str], n: int):
        self.n = n
        self.accuracy = {f: [0.8] * n for f in fields}
        self.depends: dict[str, dict[tuple[int, int], float]] = {f: {} for f in fields}

    def rank(self, f: str) -> list[int]:
        """The place of each source in the order of accuracy."""
        place = [0] * self.n
        for k, i in enumerate(sorted(range(self.n), key=lambda i: (-self.accuracy[f][i], i))):
            place[i] = k
        return place

    def vote(self, f: str, i: int) -> float:
        a = min(0.99, max(0.01, self.accuracy[f][i]))
        return math.log(FALSE_VALUES * a / (1 - a))


def _scorer(b: Beliefs):
    """A function of field and sources of values: their scores, and best, the most accurate source of each. A vote counts only as far as it isn't copied from a better source."""
    votes = {f: [b.vote(f, i) for i in range(b.n)] for f in b.accuracy}
    places = {f: b.rank(f) for f in b.accuracy}
    scale = min(1.0, MOST / max(1.0, max((sum(abs(x) for x in v) for v in votes.values()), default=1.0)))
    depends = {f: {k: p for k, p in d.items() if p > 1e-4} for f, d in b.depends.items()}

    @F.pandas_udf("score double, best int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        memo: dict[tuple, tuple[float, int]] = {}
        for fields, sets in batches:
            out = []
            for f, sources in zip(fields, sets, strict=True):
                key = (f, tuple(sorted(sources)))
                if key not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    order, total = sorted(key[1], key=places[f].__getitem__), 0.0
                    for k, i in enumerate(order):
                        vote = votes[f][i]
                        for j in order[:k]:
                            vote *= 1 - COPIED * depends[f].get((min(i, j), max(i, j)), 0.0)
                        total += vote
                    memo[key] = (total * scale, order[0])
                out.append(memo[key])
            yield pd.DataFrame(out, columns=["score", "best"]).astype({"score": float, "best": "int32"})

    return run


def posteriors(values: DataFrame, b: Beliefs) -> DataFrame:
    """values with score, best (the most accurate of its sources) and p, the posterior; FALSE_VALUES + 1 values are possible, those that nobody claims included."""
    scored = values.withColumn("_s", _scorer(b)("field", "sources")).select("*", "_s.score", "_s.best").drop("_s")
    whole = scored.groupBy(*ITEM).agg(F.sum(F.exp("score")).alias("z"), F.count(F.lit(1)).alias("kinds"))
    rest = F.greatest(F.lit(0.0), F.lit(FALSE_VALUES + 1) - F.col("kinds"))
    return scored.join(whole, ITEM).withColumn("p", F.exp("score") / (F.col("z") + rest)).drop("z", "kinds")


def _pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One table a task: for two sources that share values the sums of p and 1 - p over them."""
    sums: dict[tuple, list[float]] = {}
    for batch in batches:
        for f, sources, p in zip(batch["field"], batch["sources"], batch["p"], strict=True):
            s = sorted(sources)
            for k, i in enumerate(s):
                for j in s[k + 1 :]:
                    t = sums.setdefault((f, i, j), [0.0, 0.0])
                    t[0] += p
                    t[1] += 1 - p
    yield pd.DataFrame([(*k, *v) for k, v in sums.items()], columns=["field", "i", "j", "t", "f"]).astype({"i": "int32", "j": "int32", "t": float, "f": float})


def _met(values: DataFrame) -> dict[tuple, int]:
    """How many items two sources both claim, by field."""
    by_item = values.select(*ITEM, F.explode("sources").alias("i")).groupBy(*ITEM).agg(F.collect_set("i").alias("sources")).where(F.size("sources") > 1)
    sums = by_item.select("field", "sources", F.lit(1.0).alias("p")).mapInPandas(_pair_sums, "field string, i int, j int, t double, f double")
    return {(r["field"], r["i"], r["j"]): r["t"] for r in sums.groupBy("field", "i", "j").agg(F.sum("t").alias("t")).collect()}


def learn(values: DataFrame, b: Beliefs, met: dict[tuple, int], first: bool) -> None:
    """One round. The first one learns dependences only: from how often two sources agree at all, since votes that aren't discounted yet would make a group of copiers look right and those who contradict it look like copiers."""
    post = stored(posteriors(values, b).select("field", "sources", "p"), "posteriors")
    if not first:
        for r in post.select("field", F.explode("sources").alias("i"), "p").groupBy("field", "i").agg(F.sum("p").alias("p"), F.count(F.lit(1)).alias("n")).collect():
            b.accuracy[r["field"]][r["i"]] = min(0.99, max(0.01, (r["p"] + 0.8) / (r["n"] + 1)))
    sums = post.where(F.size("sources") > 1).mapInPandas(_pair_sums, "field string, i int, j int, t double, f double").groupBy("field", "i", "j").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
    shared = {(r["field"], r["i"], r["j"]): (r["t"], r["f"]) for r in sums.collect()}
    for (f, i, j), both in met.items():
        true_, false_ = shared.get((f, i, j), (0.0, 0.0))
        counts = (true_, false_, max(0.0, both - true_ - false_))
        x, y, c = b.accuracy[f][i], b.accuracy[f][j], COPIED
        true, false = x * y, (1 - x) * (1 - y) / FALSE_VALUES
        alone = (true, false, max(1e-9, 1 - true - false))
        m = (x + y) / 2
        copied = (m * c + true * (1 - c), (1 - m) * c + false * (1 - c), alone[2] * (1 - c))
        if first:
            alone = (true + false, true + false, alone[2])
            copied = tuple(c + (1 - c) * a for a in alone[:2]) + (alone[2] * (1 - c),)
        gain = sum(n * math.log(max(q, 1e-12) / max(p, 1e-12)) for n, p, q in zip(counts, alone, copied, strict=True))
        b.depends[f][i, j] = 1 / (1 + (1 - PRIOR) / PRIOR * math.exp(max(-500.0, min(500.0, -gain))))


def fuse(rows: DataFrame, fields: list[str], rounds: int = 3) -> DataFrame:
    """One row for each item that came in at least two copies: item, n_copies, and for each field its fused value, {field}_source, {field}_belief and {field}_conflict.

    rows: (item, copy, source, order, fields...): copy is the delivery's archive, which makes one claim, its last delivered value; source the publisher or class whose accuracy is learned, any number of them, and of one source's archives each has its claim; order tells which of several rows of a copy came last. A row with a null item is of no group and left out; a null copy or source counts as one named '?'. Other columns are ignored.
    The fused value is the claim with the largest posterior; of equal ones that of the most accurate source, then of the first source by name, then the last delivered, then the smaller. A source that claims one value several times has one vote for it; where its archives disagree it votes for each of their values. Of claims that are the same (SAME), the last delivered stands for all. Null and NaN claim nothing; a field that nobody claims is null with belief 0.
    {field}_conflict: over all rows of the item, some have a value and some none, or two values differ by more than SAME of the larger. Exact copies and repeated rows change nothing. Empty input: no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = rows.where("item is not null").withColumns({c: F.coalesce(F.col(c), F.lit("?")) for c in ("copy", "source")})
    claims, items = collect_claims(rows, fields)
    items = stored(items, "items")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_v").cast("double").alias("v"), F.col(f"{f}_o").alias("o")) for f in fields]))
    claims = claims.join(items.select("item"), "item", "left_semi").select("item", "source", each.alias("c")).select("item", "c.field", "source", "c.v", "c.o").where("v is not null")
    claims = stored(claims, "claims")
    sources = sorted(r[0] for r in claims.select("source").distinct().collect())
    number = spark.createDataFrame(list(enumerate(sources)), "i int, source string")
    values = claimed_values(claims, number, len(sources))
    b, met = Beliefs(fields, len(sources)), _met(values) if rounds else {}
    for k in range(rounds):
        learn(values, b, met, k == 0)
    places = {f: b.rank(f) for f in fields}
    ranks = spark.createDataFrame([(f, i, places[f][i], s) for f in fields for i, s in enumerate(sources)], "field string, best int, place int, name string")
    post = posteriors(values, b).join(small(ranks, len(sources) * len(fields), 96), ["field", "best"])
    # Equal posteriors: sums in another order must not decide, so they are compared to twelve digits.
    better = F.struct(F.round("p", 12).alias("p"), (-F.col("place")).alias("place"), "last", (-F.col("value")).alias("v"))
    pick = F.struct("value", "name", "p")
    chosen = post.groupBy("item").agg(*[F.max_by(F.when(F.col("field") == f, pick), F.when(F.col("field") == f, better)).alias(f"_{f}") for f in fields])
    out = items.join(chosen, "item", "left")
    keep = ["item", "n_copies"]
    for f in fields:
        keep += [F.col(f"_{f}.value").alias(f), F.col(f"_{f}.name").alias(f"{f}_source"), F.coalesce(f"_{f}.p", F.lit(0.0)).alias(f"{f}_belief"), f"{f}_conflict"]
    return out.select(*keep)
