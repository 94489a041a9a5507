"""Exact top-k search by a Voronoi kNN join.

The score is an inner product, which is no distance; with vectors one dimension longer it becomes one:
a candidate x goes to (x, sqrt(M^2 - |x|^2)), M the largest norm, and a query q to (q, 0). Then the
squared distance is |q|^2 + M^2 - 2 q.x, so that near means a high score.

Pivots cut the space into cells. Candidates and queries go to the cell of their nearest pivot, and per
cell a summary is kept: the largest distance of a query to the pivot, and the k smallest of candidates.
By the triangle inequality these bound the k-th best distance of every query of a cell from above, and the
distance of a query to a candidate from below. Near query cells form groups, and a candidate is replicated
to the groups which it can matter to, and no others. Groups are solved locally in numpy, with integer
products, and the results of a query's tasks merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lamina.llm.common import checkpointed

PIVOTS = 64
# Candidates and queries of one task's group.
CANDIDATES_PER_GROUP, QUERIES_PER_GROUP = 20_000, 2_000
QUERY_BLOCK = 64
# What rounding can add to a distance, relative to the largest: bounds are loosened by it.
SLACK = 1e-9


def scaled(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) of every component; null where the vector, or a component, is null or not finite."""
    parts = F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")))
    wild = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(wild, F.lit(True)), parts)


def stack(vectors, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def lifted(vectors: np.ndarray, largest: float | None) -> np.ndarray:
    """With the dimension that turns products into distances; candidates have `largest`, queries None."""
    x = vectors.astype(np.float64)
    extra = np.zeros(len(x)) if largest is None else np.sqrt(np.maximum(largest**2 - (x * x).sum(axis=1), 0))
    return np.column_stack([x, extra])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    candidates_per_group: int = CANDIDATES_PER_GROUP,
    queries_per_group: int = QUERIES_PER_GROUP,
) -> DataFrame:
    """Per query its k highest scores among all rows but those of its own id: query_id, rank, vec_id, score.

    Vectors hold integers (see `scaled`) whose products fit 53 bits. Ties go to the smaller id; a query with
    fewer than k candidates gets all of them. Rows with a null id or vector take no part, rows repeated with
    id and vector count once, vectors shorter than the longest end in zeros, and an empty one is all zeros.
    Rows that share an id but not the vector are candidates each, and as queries one: the smallest in the order of arrays.

    The pivots are `pivots` candidates (those with the smallest hashes) and decide only how much is pruned.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<long>").alias("v"), is_query.alias("q")
    )
    rows = checkpointed(rows.where("id IS NOT NULL AND v IS NOT NULL").dropDuplicates(["id", "v"]))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest, width = rows.agg(F.max(F.sqrt(square)), F.max(F.size("v"))).first()
    result = "query_id long, rank int, vec_id long, score long"
    if largest is None:
        return spark.createDataFrame([], result)
    chosen = rows.select("v", F.xxhash64("id", "v").alias("h")).dropDuplicates(["v"]).orderBy("h").limit(pivots).collect()
    centres = lifted(stack([r.v for r in chosen], width), largest)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, v, q = (batch.column(i) for i in range(3))
            whole = stack(v.to_pylist(), width)
            asked = q.to_numpy(zero_copy_only=False).astype(bool)
            for as_query in (False, True):
                mine = np.flatnonzero(asked) if as_query else np.arange(len(whole))
                far = distances(lifted(whole[mine], None if as_query else largest), centres)
                cell = far.argmin(axis=1) if len(mine) else np.zeros(0, np.int64)
                taken = pa.array(mine)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), as_query)), pa.array(cell), pa.array(far[np.arange(len(mine)), cell]), ids.take(taken), v.take(taken)],
                    names=["as_query", "cell", "far", "id", "v"],
                )

    dealt = checkpointed(rows.mapInArrow(assign, "as_query boolean, cell long, far double, id long, v array<long>"))
    first = F.min(F.struct("v", "cell", "far")).alias("x")
    queries = dealt.where("as_query").groupBy("id").agg(first).select("id", "x.v", "x.cell", "x.far")
    candidates = dealt.where("NOT as_query")

    # Summaries: per cell a count and a radius, and its k smallest distances.
    asked = {r.cell: (r.n, r.u) for r in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("u")).collect()}
    # Of an id that has several vectors the nearest counts, as a query's own must not stand for others.
    nearest = Window.partitionBy("cell").orderBy("far", "id")
    per_id = candidates.groupBy("cell", "id").agg(F.min("far").alias("far"))
    closest = per_id.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("cell", "id", "far").collect()
    held = np.array([r.cell for r in closest], np.int64)
    held_ids = np.array([r.id for r in closest], np.int64)
    inner = np.array([r.far for r in closest])
    between = distances(centres, centres)
    slack = SLACK * (largest + 1) + 1e-6
    bounds = {}
    for cell, (_, radius) in asked.items():
        # A query may be its own candidate, so the bound is the distance of one id more than k.
        reach = radius + between[cell, held] + inner
        order = np.argsort(reach, kind="stable")
        _, first = np.unique(held_ids[order], return_index=True)
        reach = reach[order][np.sort(first)]
        bound = radius + (reach[k] if len(reach) > k else np.inf) + slack
        bounds[cell] = np.stack([between[cell] - bound, between[cell] + bound])

    # Near query cells with few queries make one group, so that a candidate which several of them need is sent once.
    group_of: dict[int, int] = {}
    waiting, group, size = set(asked), -1, 0
    while waiting:
        if group < 0 or size >= queries_per_group:
            here, group, size = min(waiting), group + 1, 0
        cell = min(waiting, key=lambda c: (between[here, c], c))
        waiting.remove(cell)
        group_of[cell] = group
        size += asked[cell][0]
    limits = []
    for g in range(group + 1):
        low = np.min([bounds[c][0] for c in group_of if group_of[c] == g], axis=0)
        high = np.max([bounds[c][1] for c in group_of if group_of[c] == g], axis=0)
        limits += [(other, g, float(low[other]), float(high[other])) for other in range(len(centres))]
    # pivots x pivots rows at most.
    allowed = F.broadcast(spark.createDataFrame(limits or [(0, 0, 0.0, 0.0)], "cell long, grp long, low double, high double"))
    sent = candidates.join(allowed, "cell").where("far BETWEEN low AND high")

    # Tasks of bounded size: a group's candidates and its queries are each split over several.
    load = {r.grp: r.n for r in sent.groupBy("grp").agg(F.count("*").alias("n")).collect()}
    wanted_of: dict[int, int] = {}
    for cell, g in group_of.items():
        wanted_of[g] = wanted_of.get(g, 0) + asked[cell][0]
    parts = [(g, -(-load.get(g, 1) // candidates_per_group), -(-n // queries_per_group)) for g, n in wanted_of.items()]
    split = F.broadcast(spark.createDataFrame(parts or [(0, 1, 1)], "grp long, c_parts long, q_parts long"))
    groups = F.broadcast(spark.createDataFrame(list(group_of.items()) or [(0, 0)], "cell long, grp long"))
    c_part, q_part = F.pmod(F.xxhash64("id", "v"), "c_parts"), F.pmod(F.xxhash64("id"), "q_parts")
    left = sent.join(split, "grp").select("grp", c_part.alias("c_part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_parts") - 1)).alias("q_part"), "id", "v")
    right = queries.join(groups, "cell").join(split, "grp")
    right = right.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c_parts") - 1)).alias("c_part"), q_part.alias("q_part"), F.col("id").alias("asked"), F.col("v").alias("w"))

    def solve(found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        ids = found["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], stack([found["v"].iloc[i] for i in order], width).astype(np.float64)
        out = []
        for first in range(0, len(wanted), QUERY_BLOCK):
            block = wanted.iloc[first : first + QUERY_BLOCK]
            # Exact in doubles: products and sums are whole numbers below 2**53.
            scores = (stack(list(block["w"]), width).astype(np.float64) @ x.T).astype(np.int64)
            for asked_id, score in zip(block["asked"], scores):
                others = np.flatnonzero(ids != asked_id)
                theirs = score[others]
                # Stable on ids in order, so ties go to the smaller one.
                at = np.flatnonzero(theirs >= np.partition(theirs, -k)[-k]) if len(theirs) > k else np.arange(len(theirs))
                best = others[at[np.argsort(-theirs[at], kind="stable")][:k]]
                out.append(pd.DataFrame({"query_id": asked_id, "vec_id": ids[best], "score": score[best]}))
        return pd.concat(out)

    keys = ["grp", "c_part", "q_part"]
    solved = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
