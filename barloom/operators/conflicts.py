"""Several bars of one key: archive conflicts, last-wins upserts and the rule for merged files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import small, stored

#: Rows of a key that are folded as an array.
FEW = 256
#: Rank of an archive's source; a later one may overrule an earlier one.
SOURCE_RANK = {"monthly": 1, "daily": 2}


def rank_of(source: Column) -> Column:
    expr = F.lit(0)
    for name, rank in SOURCE_RANK.items():
        expr = F.when(source == name, F.lit(rank)).otherwise(expr)
    return expr


def _equal(a: Column, b: Column, values: list[str], types: dict[str, str]) -> Column:
    """Equal in every value; NaN equals nothing, null equals null."""
    each = [a[v].eqNullSafe(b[v]) & (~F.coalesce(F.isnan(a[v]), F.lit(False)) if types[v] == "double" else F.lit(True)) for v in values]
    return reduce(lambda x, y: x & y, each)


def _same(a: str, b: str, values: list[str], types: dict[str, str]) -> Column:
    return _equal(F.col(a), F.col(b), values, types)


def resolve_archives(rows: DataFrame, key: list[str], values: list[str], source: str = "archive_source", period: str = "archive_period", order: str = "order") -> DataFrame:
    """One row a key with winner (a struct of all columns of rows) and the counters duplicates, conflicts, inconsistent.

    Rows of a key in order of source rank, period and `order` are folded: the first is the base; a later row with the base's values is a duplicate; the first daily row that differs from a monthly base overrules it (one conflict), and later rows are held against that one instead; any other row that differs is inconsistent and changes nothing. A daily row equal to the monthly base is only a duplicate, so the monthly provenance stays.
    `order` should be unique within a key; rows that tie in it too are ordered by their values. Nulls in a key make groups of their own. The rows of a key are brought together once and folded as an array; only keys with more than FEW rows, which are counted first, go by partial sums and minima instead, so a key may have any number of rows.
    """
    types = dict(rows.dtypes)
    cols = rows.columns
    place = F.struct(rank_of(F.col(source)).alias("_rank"), F.coalesce(F.col(period), F.lit("")).alias("_period"), F.col(order).alias("_order"), *cols)
    keyed = rows.select(*[F.col(k).alias(f"_k_{k}") for k in key], place.alias("r"))
    on = [f"_k_{k}" for k in key]
    eq = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in on])
    many = stored(keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).drop("n"), "hot")
    n_many = many.count()
    few = keyed.join(small(many, n_many, 128), eq(keyed, many), "left_anti") if n_many else keyed
    out = _folded(few, on, values, types)
    if n_many:
        out = out.unionByName(_by_sums(keyed.join(small(many, n_many, 128), eq(keyed, many), "left_semi"), on, values, types))
    return out.select(*[F.col(f"_k_{k}").alias(k) for k in key], F.struct(*[F.col("winner")[c].alias(c) for c in cols]).alias("winner"), "duplicates", "conflicts", "inconsistent")


def _folded(keyed: DataFrame, on: list[str], values: list[str], types: dict[str, str]) -> DataFrame:
    """The fold itself, over the sorted array of a key's rows."""
    zero = F.lit(0).cast("long")
    lists = keyed.groupBy(*on).agg(F.sort_array(F.collect_list("r")).alias("l"))
    start = F.struct(F.col("l")[0].alias("winner"), zero.alias("duplicates"), zero.alias("conflicts"), zero.alias("inconsistent"))

    def step(s: Column, r: Column) -> Column:
        equal = _equal(r, s["winner"], values, types) | r.eqNullSafe(s["winner"])
        over = ~equal & (s["winner"]["_rank"] == 1) & (r["_rank"] == 2)
        add = lambda c, n: (s[n] + c.cast("long")).alias(n)
        return F.struct(F.when(over, r).otherwise(s["winner"]).alias("winner"), add(equal, "duplicates"), add(over, "conflicts"), add(~equal & ~over, "inconsistent"))

    return lists.select(*on, F.aggregate(F.slice("l", F.lit(2), F.greatest(F.size("l") - 1, F.lit(0))), start, step).alias("s")).select(*on, "s.*")


def _by_sums(keyed: DataFrame, on: list[str], values: list[str], types: dict[str, str]) -> DataFrame:
    """The same by the base, the row that overrules it, and what lies after it."""
    eq = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in on])
    keyed = stored(keyed, "conflicts")
    base = keyed.groupBy(*on).agg(F.min("r").alias("base"))
    a, b = keyed.alias("a"), base.alias("b")
    joined = a.join(b, eq(a, b)).select(*[F.col(f"a.{k}") for k in on], "r", "base")
    differs = ~_same("r", "base", values, types)
    star = joined.groupBy(*on).agg(F.min(F.when((F.col("base._rank") == 1) & (F.col("r._rank") == 2) & differs, F.col("r"))).alias("star"), F.max("base").alias("base"))
    c = star.alias("c")
    whole = a.join(c, eq(a, c)).select(*[F.col(f"a.{k}") for k in on], "r", "base", "star")
    has, is_base, is_star = F.col("star").isNotNull(), F.col("r").eqNullSafe(F.col("base")), F.col("r").eqNullSafe(F.col("star"))
    after = has & (F.col("r") > F.col("star"))
    same_base, same_star = _same("r", "base", values, types), _same("r", "star", values, types)
    dup = F.when(is_base | is_star, False).when(after, same_star).otherwise(same_base)
    bad = F.when(is_base | is_star, False).when(after, ~same_star).otherwise(~same_base)
    n = lambda x: F.count(F.when(x, 1))
    # Exact copies of the base or the overruling row, order included, are duplicates as well.
    copies = F.greatest(n(is_base) - 1, F.lit(0)) + F.greatest(n(is_star & has) - 1, F.lit(0))
    out = whole.groupBy(*on).agg(F.first("base").alias("base"), F.first("star").alias("star"), (n(dup) + copies).alias("duplicates"), F.max(has.cast("long")).alias("conflicts"), n(bad).alias("inconsistent"))
    return out.select(*on, F.coalesce("star", "base").alias("winner"), "duplicates", "conflicts", "inconsistent")


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the largest `order`; keys with nulls are groups of their own. Rows that tie in it are ordered by their other columns, which must be orderable. Partial maxima only."""
    rest = [c for c in rows.columns if c not in order]
    top = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return top.select(*[F.col(f"_r.{c}").alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], arrival: str) -> DataFrame:
    """existing with incoming put over it: of each key the last received row, incoming before existing whatever its arrival number. Both need the same columns; arrival is the order inside each."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return last_wins(both, key, ["_new", arrival]).drop("_new")


def upsert_counts(existing: DataFrame, incoming: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """For each partition `by`, the counts of an upsert: input_rows, existing_rows, output_rows, replaced (input rows that found their key there, earlier input included), min_open_time and max_open_time of the output. Only partitions that incoming touches."""
    cols = list(dict.fromkeys([*by, *key]))
    both = existing.select(*cols).withColumn("_new", F.lit(0)).unionByName(incoming.select(*cols).withColumn("_new", F.lit(1)))
    keys = both.groupBy(*cols).agg(F.sum("_new").alias("n"), F.sum(1 - F.col("_new")).alias("e"))
    out = keys.groupBy(*by).agg(F.sum("n").alias("input_rows"), F.sum("e").alias("existing_rows"), F.count(F.lit(1)).alias("output_rows"), F.sum(F.when(F.col("n") > 0, F.col("n") - F.when(F.col("e") > 0, 0).otherwise(1)).otherwise(0)).alias("replaced"), F.min("open_time").alias("min_open_time"), F.max("open_time").alias("max_open_time"))
    return out.where("input_rows > 0")
