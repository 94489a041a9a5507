"""Row rules: named predicates folded into one filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import timing


@dataclass(frozen=True)
class Rule:
    """A predicate a row must meet; null counts as not met."""

    name: str
    predicate: Column


def required(*columns: str) -> Rule:
    return Rule("required", _all(F.col(c).isNotNull() for c in columns))


def in_range(column: str, low: float, high: float, above_low: bool = False) -> Rule:
    """low <= column <= high, or low < column <= high with `above_low`."""
    value = F.col(column)
    return Rule(f"range({column})", ((value > low) if above_low else (value >= low)) & (value <= high))


def ordered(start: str, end: str) -> Rule:
    return Rule(f"ordered({start},{end})", F.col(end) > F.col(start))


def at_most(start: str, end: str, seconds: int) -> Rule:
    return Rule(f"at_most({start},{end})", timing.elapsed_seconds(start, end) <= seconds)


def ingest_window(column: str, year: str, month: str, grace_days: int = 1) -> Rule:
    return Rule(f"ingest_window({column})", timing.in_ingest_window(column, year, month, grace_days))


def all_met(rules: Sequence[Rule]) -> Column:
    return _all(r.predicate for r in rules)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that meet every rule; one filter, so Catalyst splits and pushes it as one."""
    return df.filter(all_met(rules)) if rules else df


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, rows, failed) for each rule taken alone, from one pass."""
    failed = [
        F.count_if(~F.coalesce(r.predicate, F.lit(False))).alias(f"_f{i}") for i, r in enumerate(rules)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *failed)
    entries = [
        F.struct(F.lit(r.name).alias("rule"), F.col("rows"), F.col(f"_f{i}").alias("failed"))
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def impute(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a default, keeping the column's type."""
    types = {name: df.schema[name].dataType for name in defaults}
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value).cast(types[name])) for name, value in defaults.items()}
    )


def _all(predicates) -> Column:
    return reduce(lambda a, b: a & b, predicates)
