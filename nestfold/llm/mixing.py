"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestfold.llm.common import BROADCAST_ROWS, lookup, spare, store, table
from nestfold.llm.registry import register

#: Without stated targets, a category's share goes as its tokens to this power.
TEMPER = 0.9
#: Cells (combinations of categories that occur) raked in numpy on the driver; more are raked in Spark.
DRIVER_CELLS = 200_000
TOLERANCE, ROUNDS = 1e-8, 500
DIMS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """Kind of text, from its form: ``table``, ``noisy``, ``short`` or ``prose``."""
    n = F.length(text)
    held = lambda *cs: sum((n - F.length(F.replace(text, F.lit(c), F.lit("")))) for c in cs)
    return F.when(n.isNull() | (n < 500), "short").when(held("|") * 50 > n, "table").when(held("%", "$", "#", "&", "*") * 50 > n, "noisy").otherwise("prose")


def tokens_in(text: Column) -> Column:
    """White-space words."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(text), r"\s+"))).cast("long")


def filled(targets: np.ndarray, most: np.ndarray) -> np.ndarray:
    """``targets`` cut to ``most``, what is cut off shared out over the others in
    proportion, until all is placed or all are full."""
    out, want = np.zeros(len(targets)), targets.sum()
    open_ = targets > 0
    while open_.any():
        share = targets * open_ / (targets * open_).sum() * (want - out[~open_].sum())
        full = open_ & (share >= most)
        if not full.any():
            return np.where(open_, share, out)
        out[full] = most[full]
        open_ &= ~full
    return out


def _ratios(target: np.ndarray, fixed: np.ndarray, free: np.ndarray) -> np.ndarray:
    """What a category's scale changes by: its free cells make up what the held
    ones leave; if those hold too much already, all of it shrinks."""
    have = fixed + free
    rest = np.divide(target - fixed, free, out=np.ones(len(target)), where=free > 0)
    less = np.divide(target, have, out=np.ones(len(target)), where=have > 0)
    return np.where(target <= 0, 0.0, np.where((free > 0) & (target > fixed), rest, less))


def rake(weights: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], bound: float = np.inf) -> np.ndarray:
    """A factor for each cell, at most ``bound``, with which its weight meets
    every marginal target. Cells whose categories can't be met (target or
    weight 0) get 0.

    Each round scales the categories of one dimension after the other. A cell
    that a scale takes beyond the bound is held there and the rest of its
    category takes over its share. Warns if the marginals are not met after
    ``ROUNDS`` rounds: they contradict each other."""
    g = np.where(weights > 0, 1.0, 0.0)
    worst = 0.0
    for _ in range(ROUNDS):
        worst = 0.0
        for code, target in zip(codes, targets):
            have = np.bincount(code, weights * np.minimum(g, bound), minlength=len(target))
            live = (have > 0) & (target > 0)
            worst = max(worst, (np.abs(have[live] - target[live]) / target[live]).max(initial=0))
            held = g >= bound
            fixed = np.bincount(code, weights * np.where(held, bound if np.isfinite(bound) else 0.0, 0.0), minlength=len(target))
            free = np.bincount(code, np.where(held, 0.0, weights * g), minlength=len(target))
            g = g * _ratios(target, fixed, free)[code]
        if worst < TOLERANCE:
            break
    else:
        warnings.warn(f"marginals are {worst:.2g} off after {ROUNDS} rounds", stacklevel=2)
    return np.minimum(g, bound)


def tempered(totals: dict[str, float], power: float = TEMPER) -> dict[str, float]:
    return {k: v**power if v > 0 else 0.0 for k, v in totals.items()}


def _goals(have: dict[str, float], given: dict | None, power: float, total: float, bound: float) -> dict[str, float]:
    """What each category should have of ``total`` tokens, no more than ``bound``
    times its own."""
    want = given or tempered(have, power)
    names = sorted(have)
    goal = np.array([want.get(n, 0.0) if have[n] > 0 else 0.0 for n in names])
    if not goal.sum():
        return dict.fromkeys(names, 0.0)
    goal = goal / goal.sum() * total
    return dict(zip(names, (filled(goal, bound * np.array([have[n] for n in names])) if np.isfinite(bound) else goal).tolist()))


def _rake_driver(cells: DataFrame, n: int, goals: list[dict], bound: float) -> DataFrame:
    rows = cells.collect()
    weights = np.array([r["tokens"] for r in rows], float)
    places = [{k: i for i, k in enumerate(g)} for g in goals]
    codes = [np.array([p[r[f"c{d}"]] for r in rows], int) for d, p in enumerate(places)]
    f = rake(weights, codes, [np.array(list(g.values())) for g in goals], bound) if rows else np.zeros(0)
    schema = ", ".join(f"c{d} string" for d in range(n)) + ", held long, factor double"
    return cells.sparkSession.createDataFrame([(*(r[f"c{d}"] for d in range(n)), r["held"], float(x)) for r, x in zip(rows, f)], schema)


def _rake_spark(cells: DataFrame, n: int, goals: list[dict], bound: float) -> DataFrame:
    """The same for any number of cells: a cell's factor is a product of one
    scale per category. The scales are on the driver; a step adds up the cells of
    each category of one dimension, on the map side first."""
    spark, scales = cells.sparkSession, [dict.fromkeys(g, 1.0) for g in goals]

    def scaled() -> DataFrame:
        out = cells
        for d, scale in enumerate(scales):
            side = spark.createDataFrame(list(scale.items()), f"c{d} string, s{d} double")
            out = out.join(F.broadcast(side) if len(scale) <= BROADCAST_ROWS else side, f"c{d}")
        g = F.when(F.col("tokens") > 0, 1.0).otherwise(0.0)
        for d in range(n):
            g = g * F.col(f"s{d}")
        return out.withColumn("g", g)

    top, worst = F.lit(float(bound)), 0.0
    for _ in range(ROUNDS):
        worst = 0.0
        for d, goal in enumerate(goals):
            held = F.col("g") >= top
            fixed = F.sum(F.when(held, F.col("tokens") * top).otherwise(0.0))
            free = F.sum(F.when(held, 0.0).otherwise(F.col("tokens") * F.col("g")))
            for k, fixed_k, free_k in scaled().groupBy(f"c{d}").agg(fixed, free).collect():
                have = fixed_k + free_k
                if have > 0 and goal[k] > 0:
                    worst = max(worst, abs(have - goal[k]) / goal[k])
                scales[d][k] *= float(_ratios(*(np.array([x]) for x in (goal[k], fixed_k, free_k)))[0])
        if worst < TOLERANCE:
            break
    else:
        warnings.warn(f"marginals are {worst:.2g} off after {ROUNDS} rounds", stacklevel=2)
    return scaled().select(*[f"c{d}" for d in range(n)], "held", F.least("g", top).alias("factor"))


def mix(docs: DataFrame, dims: dict[str, Column], tokens: Column, targets: dict[str, dict[str, float]] | None = None, power: float = TEMPER,
        size: float = 1.0, seed: int = 0, repeats: bool = True, driver_cells: int = DRIVER_CELLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_weight``, ``mix_probability`` and
    ``mix_copies`` added (columns of those names are replaced).

    ``dims`` names the categories to rake (source, language, topic) and
    ``targets`` the share of each category; one that it doesn't name gets
    none. A dimension without targets is tempered by ``power``. Token counts
    per combination of categories are gathered over all documents and raked
    until every marginal meets its target; ``mix_weight`` is the mean number of
    copies of a document, for ``size`` times the tokens of ``docs`` in all.
    ``mix_copies`` draws them: the whole part, and one more with the
    probability of the rest, by a hash of id, text and ``seed``, so the same
    rows give the same draw.

    With ``repeats=False`` no document is drawn twice and weights are raked
    below 1. A category with too few tokens for its share gives all it has, and
    the others take over the rest in proportion, so ``size`` is met where
    there are tokens for it; the smaller it is, the closer the shares come to
    their targets (at 1 every document is drawn).

    Null categories are a category, the empty string. A text without tokens,
    which no target counts, has its combination's weight, or 0 if all texts of
    it are so. Repeated rows have the same draw. An empty table gives an
    empty result. A dimension's categories must fit the driver.
    """
    added = ["mix_tokens", "mix_weight", "mix_probability", "mix_copies"]
    kept = [c for c in docs.columns if c not in added]
    n, bound = len(dims), np.inf if repeats else 1.0
    cell, held = spare(docs, "_cell"), spare(docs, "_held")
    key = F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(f"c{d}") for d, c in enumerate(dims.values())])
    rows = docs.select(*kept, tokens.alias("mix_tokens"), key.alias(cell))
    cells = rows.groupBy(cell).agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("held"))
    cells = store(cells.select("tokens", "held", f"{cell}.*"), "mixing-cells")
    total, count, n_cells = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("held"), F.lit(0)), F.count("*")).first()
    goals = []
    for d, name in enumerate(dims):
        have = {r[0]: float(r[1] or 0) for r in cells.groupBy(f"c{d}").agg(F.sum("tokens")).collect()}
        goals.append(_goals(have, (targets or {}).get(name), power, float(total) * size, bound))
    least = min([sum(g.values()) for g in goals], default=0.0)  # dimensions that can't place all agree on what they can
    goals = [{k: v * least / s if (s := sum(g.values())) else v for k, v in g.items()} for g in goals]
    raked = (_rake_driver if n_cells <= driver_cells else _rake_spark)(cells, n, goals, bound)
    factors = raked.select(F.struct(*[f"c{d}" for d in range(n)]).alias(cell), F.col("held").alias(held), F.col("factor").alias("mix_weight"))
    out = lookup(rows, store(factors, "mixing-factors"), cell, held, count)
    weight = F.coalesce("mix_weight", F.lit(0.0))
    draw = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).bitwiseAND((1 << 53) - 1) / float(1 << 53)
    out = out.withColumn("mix_weight", weight).withColumn("mix_probability", F.least("mix_weight", F.lit(1.0)))
    out = out.withColumn("mix_copies", F.floor("mix_weight") + (draw < F.col("mix_weight") - F.floor("mix_weight")).cast("long"))
    return out.select(*kept, *added)


def default_dims() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}


@register("op4_mixing")
def op4_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    out = mix(docs.withColumn("topic", topic_of(F.col("text"))), {d: F.col(d) for d in DIMS}, tokens_in(F.col("text")))
    return out.select("doc_id", *DIMS, *[F.col(f"mix_{c}").alias(c) for c in ("tokens", "weight", "probability", "copies")])
