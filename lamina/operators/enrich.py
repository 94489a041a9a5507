"""Look attributes up in a dimension, once per role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


class DimensionError(ValueError):
    """The dimension cannot be joined without changing the number of rows."""


@dataclass(frozen=True)
class Role:
    """`key`: column of the facts; `columns`: dimension column -> name in the result."""

    key: str
    columns: Mapping[str, str]


def enrich(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Sequence[Role],
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Left join of the facts to the dimension for each role; unmatched facts keep nulls.

    The dimension is measured first (one aggregate over it): a key that occurs twice raises,
    as it would multiply facts, and only a dimension below the limit is broadcast. A larger
    one is left to Catalyst, where adaptive execution splits skewed keys.
    """
    needed = sorted({c for role in roles for c in role.columns})
    dimension = dimension.select(key, *needed)
    size = _measure(dimension, key)
    side = dimension.filter(F.col(key).isNotNull()).select(*[F.col(c).alias(f"_looked_up_{c}") for c in (key, *needed)])
    if size <= broadcast_limit_bytes:
        side = F.broadcast(side)
    for role in roles:
        # The same side for every role, so that one broadcast serves them all.
        names = [role.key, *(c for c in df.columns if c != role.key and c not in role.columns.values())]
        kept = [F.col(f"`{c}`") for c in names]
        found = [F.col(f"_looked_up_{c}").alias(name) for c, name in role.columns.items()]
        df = df.join(side, F.col(role.key) == F.col(f"_looked_up_{key}"), "left").select(*kept, *found)
    return df


def _measure(dimension: DataFrame, key: str) -> int:
    """Bytes of the dimension as text plus a row overhead; raises on a repeated key."""
    text = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dimension.columns), F.lit(0))
    per_key = dimension.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(text + 32).alias("bytes"))
    found = per_key.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated"),
    ).first()
    if found["repeated"]:
        raise DimensionError(f"{found['repeated']} value(s) of dimension key {key} occur more than once")
    return found["bytes"]
