"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_in_key"


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key by `order` (ascending, nulls first); null keys are equal.

    `order` defaults to all other columns, so the survivor does not depend on how the rows
    are partitioned. `row_number = 1` plans as a group limit before the shuffle: every task
    ships at most one row per key, so even one key holding a large share of all rows
    arrives as one row per upstream task. Put the most selective key first: it leads the
    sort, and only ties compare further columns.
    """
    rest = [c for c in df.columns if c not in keys] if order is None else list(order)
    ordering = [F.col(c).asc_nulls_first() for c in rest] or [F.lit(1)]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def duplicate_count(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """One row: how many rows are copies of another row's key. Partial counts go first."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))
