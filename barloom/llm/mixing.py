"""Texts drawn so that each source makes up its target share of all tokens, by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.tokens import RANKS, canonical_source, token_count
from barloom.session import stored

#: Cells of the histogram of scores that a threshold is taken from, and thresholds: the later ones fill what is left with smaller texts.
CELLS, STAGES = 1 << 16, 3


def _targets(targets: DataFrame, have: dict[str, tuple[int, int]], total: float | None) -> dict[str, dict]:
    """By source its share, its cap, and the tokens wanted. Shares of sources without any token are spread over the rest. Unless given, the total is the largest at which no source must be repeated beyond its cap."""
    rows = {r["source"]: r for r in targets.select(canonical_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).collect()}
    live = {s: r for s, r in rows.items() if have.get(s, (0, 0))[0] > 0}
    whole = sum(r["target_share"] for r in live.values())
    most = min((have[s][0] * r["max_repeats"] * whole / r["target_share"] for s, r in live.items()), default=0.0)
    total = most if total is None else min(total, most)
    return {s: {"share": r["target_share"], "cap": r["max_repeats"], "want": total * r["target_share"] / whole} for s, r in live.items()}


def _rate(cap: str = "cap") -> Column:
    """Copies of a document wanted on average: exponential in its tokens, at most the cap."""
    return F.least(F.exp(F.least(F.col("lam") * F.col("x"), F.log(F.col(cap)))), F.col(cap))


def _with(df: DataFrame, values: dict[str, dict]) -> DataFrame:
    """Rows of df of the given sources, with the numbers of each as columns; values has at most a row a target source."""
    names = sorted(next(iter(values.values())))
    table = {n: F.create_map(*[F.lit(x) for s, v in values.items() for x in (s, float(v[n]))]) for n in names}
    return df.where(F.col("source").isin(list(values))).withColumns({n: m[F.col("source")] for n, m in table.items()})


def _solve(sizes: DataFrame, goals: dict[str, dict], steps: int, tolerance: float) -> dict[str, float]:
    """The multiplier of each source: Newton steps on the logarithm of the dual's gradient, one distributed sum over (source, n, count) a step, kept inside a bracket. A source that must be taken whole, as often as its cap, has no finite one; it gets 1e9."""
    state = {s: {"lam": 0.0, "lo": -math.inf, "hi": math.inf, "done": False} for s in goals}
    for s, g in goals.items():
        if g["want"] >= g["cap"] * g["tokens"] * (1 - tolerance):
            state[s] |= {"lam": 1e9, "done": True}
    for _ in range(steps):
        live = {s: {"lam": state[s]["lam"], **{k: goals[s][k] for k in ("cap", "mean")}} for s in goals if not state[s]["done"]}
        if not live:
            break
        x = _with(sizes, live).withColumn("x", F.col("n") / F.col("mean"))
        w = _rate()
        sums = x.groupBy("source").agg(F.sum(F.col("count") * F.col("n") * w).alias("f"), F.sum(F.when(w < F.col("cap"), F.col("count") * F.col("n") * F.col("x") * w)).alias("d")).collect()
        for r in sums:
            s, want = state[r["source"]], goals[r["source"]]["want"]
            if abs(r["f"] - want) <= tolerance * want:
                s["done"] = True
                continue
            s["lo" if r["f"] < want else "hi"] = s["lam"]
            step = s["lam"] - math.log(max(r["f"], 1e-300) / want) * r["f"] / r["d"] if r["d"] and r["f"] else None
            if step is None or not s["lo"] < step < s["hi"]:
                if math.isinf(s["lo"]) or math.isinf(s["hi"]):
                    step = s["lam"] * 2 + (1 if math.isinf(s["hi"]) else -1)
                else:
                    step = (s["lo"] + s["hi"]) / 2
            s["lam"] = step
    return {s: v["lam"] for s, v in state.items()}


def _thresholds(can: DataFrame, gaps: dict[str, float]) -> dict[str, dict]:
    """For each source the largest threshold, to 1 in CELLS, at which the texts with a lower score have no more tokens than its gap, and their tokens. can: (source, n, score in [0, 1]), read once: what is decided on is a histogram of scores, which has at most CELLS rows a source."""
    cell = F.least(F.floor(F.col("score") * CELLS), F.lit(CELLS - 1))
    cells = can.groupBy("source", cell.alias("cell")).agg(F.sum("n").alias("n"))
    taken = cells.withColumn("taken", F.sum("n").over(Window.partitionBy("source").orderBy("cell")))
    fits = _with(taken, {s: {"gap": g} for s, g in gaps.items()}).where("taken <= gap")
    got = fits.groupBy("source").agg(F.max("cell").alias("cell"), F.max("taken").alias("taken")).collect()
    return {s: {"cut": 0.0, "taken": 0.0} for s in gaps} | {r["source"]: {"cut": (r["cell"] + 1) / CELLS, "taken": float(r["taken"])} for r in got}


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, ranks: str = RANKS, steps: int = 40, tolerance: float = 1e-5) -> tuple[DataFrame, DataFrame]:
    """(draw, there). draw: doc_id, source, n_tokens, rate, copies for each text drawn at least once. there: (source, tokens_there) of all sources; shares() makes the report from both.

    docs: (doc_id, text, source), targets: (source, target_share, max_repeats); sources count as one when they differ in case, outer white space, hyphens or underscores.
    Of all rates those nearest to one copy of each text (in relative entropy) that give each source its share of the tokens and no text more than max_repeats: rate = min(max_repeats, exp(lam * tokens / the source's mean)). Rates become whole copies by thresholds on a fixed hash of doc_id, moved for each source until its tokens come just below what is wanted; what is left is filled with smaller texts.
    total_tokens: the size of the mix; by default, and at most, the largest that the caps allow. Texts whose source is null, blank or not in targets, and null and empty texts, are not drawn. A target source without texts has an actual share of 0, and the others share its part in proportion. Rows that repeat a doc_id are texts of their own with the same number of copies, as far as their sizes agree. Empty docs or targets: nothing is drawn.
    """
    spark = docs.sparkSession
    # The condition comes after the table is stored: before it, it would count every text a second time.
    sized = stored(docs.select("doc_id", canonical_source(F.col("source")).alias("source"), token_count(F.col("text"), ranks).alias("n")), "sized").where("n > 0")
    sizes = stored(sized.where("source is not null").groupBy("source", "n").count(), "sizes")
    stats = sizes.groupBy("source").agg(F.sum(F.col("count") * F.col("n")).alias("tokens"), F.sum("count").alias("docs"))
    named = targets.select(canonical_source(F.col("source")).alias("source")).distinct()
    have = {r["source"]: (int(r["tokens"]), int(r["docs"])) for r in stats.join(F.broadcast(named), "source", "left_semi").collect()}
    goals = _targets(targets, have, total_tokens)
    if not goals:
        draw = spark.createDataFrame([], "doc_id long, source string, n_tokens long, rate double, copies int")
    else:
        for s, g in goals.items():
            g["tokens"], g["mean"] = have[s][0], have[s][0] / have[s][1]
        lam = _solve(sizes, goals, steps, tolerance)
        for s, g in goals.items():
            g["lam"] = lam[s]
        hashed = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(1 << 30)) / float(1 << 30)
        rated = _with(sized, goals).withColumn("x", F.col("n") / F.col("mean")).withColumn("rate", _rate()).withColumn("copies", F.floor(F.col("rate") + 1e-9)).select("doc_id", "source", "n", "rate", "copies", "cap")
        chosen = stored(rated, "rated")
        gaps = {s: goals[s]["want"] - t for s, t in chosen.groupBy("source").agg(F.sum(F.col("n") * F.col("copies"))).collect()}
        for stage in range(STAGES):
            # First by the fraction of the rate, then small texts that fit into what is left.
            score = (hashed(stage) - (F.col("rate") - F.floor(F.col("rate") + 1e-9)) + 1) / 2 if stage == 0 else hashed(stage)
            open_ = {s: {"gap": g, "most": g / 4 if stage == 1 else g} for s, g in gaps.items() if g >= 1}
            if not open_:
                break
            can = _with(chosen, open_).where((F.col("copies") < F.col("cap")) & (F.col("n") <= F.col("most"))).select("source", "n", score.alias("score"))
            cuts = _thresholds(can, {s: g["gap"] for s, g in open_.items()})
            for s in cuts:
                gaps[s] -= cuts[s]["taken"]
            if cuts:
                side = {s: {"cut": cuts[s]["cut"] if s in cuts else 0.0, "most": open_[s]["most"] if s in open_ else 0.0} for s in goals}
                more = (F.col("copies") < F.col("cap")) & (F.col("n") <= F.col("most")) & (score < F.col("cut"))
                chosen = _with(chosen, side).withColumn("copies", F.col("copies") + more.cast("int")).drop("cut", "most")
        chosen = chosen.withColumn("copies", F.col("copies").cast("int"))
        draw = chosen.where("copies > 0").select("doc_id", "source", F.col("n").alias("n_tokens"), "rate", "copies")
    return draw, stats.select("source", F.col("tokens").alias("tokens_there"))


def shares(draw: DataFrame, there: DataFrame, targets: DataFrame) -> DataFrame:
    """The report on a draw: a row for each source of either table with target_share, actual_share, tokens, documents, most_copies and tokens_there; zeros where a source has none."""
    got = draw.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("tokens")).first()[0] or 1
    wanted = targets.select(canonical_source(F.col("source")).alias("source"), "target_share").where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"))
    out = wanted.join(there, "source", "full").join(got, "source", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    return out.select("source", z("target_share").alias("target_share"), (z("tokens") / F.lit(float(whole))).alias("actual_share"), z("tokens").alias("tokens"), z("documents").alias("documents"), z("most_copies").alias("most_copies"), z("tokens_there").alias("tokens_there"))
