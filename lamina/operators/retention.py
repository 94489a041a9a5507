"""How many rows cleaning keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators.clean import Rule, all_met

_PASS, _COPIES = "_kept", "_copies"


def retention(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows_in, rows_out, rows_dropped, retention_pct) of rules followed by dedup on keys.

    One scan: rows that fail a rule share one null key per group, so that they collapse in
    the partial aggregate, and each surviving key counts once. With `by`, copies of a key
    are looked for inside each group.
    """
    kept = F.coalesce(all_met(rules), F.lit(False)) if rules else F.lit(True)
    # Each column under a name of its own: `by` may repeat a key.
    by_names = [f"_by{i}" for i in range(len(by))]
    key_names = [f"_key{i}" for i in range(len(keys))]
    marked = df.withColumn(_PASS, kept).select(
        _PASS,
        *[F.col(c).alias(n) for c, n in zip(by, by_names)],
        *[F.when(F.col(_PASS), F.col(c)).alias(n) for c, n in zip(keys, key_names)],
    )
    distinct = marked.groupBy(*by_names, _PASS, *key_names).agg(F.count(F.lit(1)).alias(_COPIES))
    counted = distinct.groupBy(*by_names).agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).alias("rows_in"), F.count_if(_PASS).alias("rows_out")
    )
    return counted.select(
        *[F.col(n).alias(c) for c, n in zip(by, by_names)],
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"),
        _pct(F.col("rows_out"), F.col("rows_in")).alias("retention_pct"),
    )


def _pct(part, whole):
    ratio = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.coalesce(F.round(ratio, 2).cast("double"), F.lit(0.0))


def retention_pct(rows_in: int, rows_out: int) -> float:
    return round(100.0 * rows_out / rows_in, 2) if rows_in else 0.0
