"""Mixing sources to target weights by iterative proportional fitting.

The corpus is summed up to cells, one per source, language and topic. The cells' token weights are raked:
each dimension in turn is scaled to its target shares, until all hold. A document is then kept with a
probability proportional to its cell's weight, calibrated so that the expected tokens meet the budget, by
a draw that depends on the document and the seed alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 50
BUDGET = 0.5
SEED = 7


def topic_of(text: Column) -> Column:
    """A stand-in where documents have no topic: the form of the text."""
    return (
        F.when(F.instr(text, "|") > 0, "table")
        .when(F.instr(text, "!!") > 0, "shouting")
        .when(F.length(text) < 500, "note")
        .otherwise("prose")
    )


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def tempered(shares: Mapping, power: float) -> dict:
    """Shares raised to a power: below 1 it lifts the small ones."""
    raised = {k: v**power for k, v in shares.items() if v > 0}
    return {k: v / sum(raised.values()) for k, v in raised.items()}


def rake(keys: Sequence[tuple], tokens: np.ndarray, targets: Sequence[Mapping], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of cells such that each dimension's weighted tokens have the target shares.

    A category without a target, or without tokens, keeps its weight in that dimension's steps. Where targets
    contradict each other, it is the state after `rounds` rounds.
    """
    weights = np.ones(len(keys))
    codes = []
    for i, target in enumerate(targets):
        names = list(dict.fromkeys(k[i] for k in keys))
        place = {x: j for j, x in enumerate(names)}
        codes.append((np.array([place[k[i]] for k in keys]), np.array([target.get(x, np.nan) for x in names])))
    whole = tokens.sum()
    for _ in range(rounds):
        for code, share in codes:
            now = np.bincount(code, weights=weights * tokens, minlength=len(share))
            factor = np.where(np.isnan(share) | (now <= 0), 1, share * whole / np.where(now > 0, now, 1))
            weights = weights * factor[code]
    return weights


def calibrate(weights: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """Probabilities min(1, s * weight) with the s for which the expected tokens are `budget` of all.

    Cells that reach 1 are kept whole, and the others scaled up to make up for it.
    """
    order = np.argsort(-weights, kind="stable")
    w, t = weights[order], tokens[order]
    capped = np.concatenate([[0], np.cumsum(t)[:-1]])
    mass = np.cumsum((w * t)[::-1])[::-1]
    scale = (budget * t.sum() - capped) / np.where(mass > 0, mass, 1)
    fits = np.flatnonzero((scale * w <= 1) & (mass > 0))
    found = scale[fits[0]] if len(fits) else np.inf
    return np.minimum(1, np.where(weights > 0, found * np.where(weights > 0, weights, 1), 0))


def cell_probabilities(
    docs: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    tokens: str = "n_tokens",
    targets: Mapping[str, Mapping] | None = None,
    power: float = 0.5,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    max_cells: int = 100_000,
) -> DataFrame:
    """One row per cell: the dimensions, weight, probability.

    Targets default to the tempered shares of the corpus. A null is a category like any other, null token
    counts are 0. The cells are categories combined, a bounded number: over `max_cells` raises an error.
    """
    sums = docs.groupBy(*[F.col(f"`{d}`").cast("string").alias(d) for d in dimensions])
    sums = sums.agg(F.coalesce(F.sum(f"`{tokens}`"), F.lit(0)).cast("double").alias("__tokens"))
    cells = [tuple(r) for r in sums.limit(max_cells + 1).collect()]
    if len(cells) > max_cells:
        raise ValueError(f"more than {max_cells} cells")
    cells.sort(key=lambda c: tuple((x is not None, x or "") for x in c[:-1]))
    keys, amounts = [c[:-1] for c in cells], np.array([c[-1] for c in cells], float)
    chosen = []
    for i, d in enumerate(dimensions):
        if targets and d in targets:
            chosen.append(targets[d])
            continue
        shares: dict = {}
        for k, amount in zip(keys, amounts):
            shares[k[i]] = shares.get(k[i], 0.0) + amount
        chosen.append(tempered(shares, power))
    weights = rake(keys, amounts, chosen, rounds) if keys else np.zeros(0)
    probability = calibrate(weights, amounts, budget) if keys else np.zeros(0)
    schema = T.StructType([T.StructField(d, T.StringType()) for d in dimensions]).add("weight", "double").add("probability", "double")
    rows = [(*k, float(w), float(p)) for k, w, p in zip(keys, weights, probability)]
    return docs.sparkSession.createDataFrame(rows, schema)


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed; rows without an id share one."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**48))


def mix(
    docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, tokens: str = "n_tokens", doc_id: str = "doc_id", seed: int = SEED, **fit
) -> DataFrame:
    """The documents with weight, probability and `sampled`, for all rows.

    Rows with the same id get the same draw, so repeated rows stay or go together. Documents without tokens
    have their cell's probability. Columns named like the three added ones are replaced. No rows give none.
    """
    added = ("weight", "probability", "sampled")
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    cells = cell_probabilities(source, dimensions, tokens, **fit)
    place = {c: f"c{i}" for i, c in enumerate(source.columns)}
    named = cells.toDF(*[f"cell{i}" for i in range(len(dimensions))], "weight", "probability")
    same = [F.col(place[d]).cast("string").eqNullSafe(F.col(f"cell{i}")) for i, d in enumerate(dimensions)]
    # At most `max_cells` rows.
    joined = source.toDF(*place.values()).join(F.broadcast(named), same, "left")
    return joined.select(
        *[F.col(p).alias(c) for c, p in place.items()], "weight", "probability", (draw(F.col(place[doc_id]), seed) < F.col("probability")).alias("sampled")
    )
