"""Summary tables: one group-by, or several from one shared rollup."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import exact
from lamina.functions.labels import label

_ROWS = "_rows"


@dataclass(frozen=True)
class Metric:
    """An output column: `count` of rows, or `sum` / `mean` of the non-null values of a column.

    `per` states the unit that the column counts in, as units in 1 (see `exact`): values that are
    whole units are summed exactly, others as they are. None adds doubles.
    """

    name: str
    kind: str
    column: str | None = None
    per: int | None = None
    places: int = 2


@dataclass(frozen=True)
class Label:
    column: str
    name: str
    labels: Mapping


@dataclass(frozen=True)
class Summary:
    """A summary table: group keys, metrics, an optional label of a key and a sorted result."""

    name: str
    by: tuple[str, ...]
    metrics: tuple[Metric, ...]
    label: Label | None = None
    ordered: bool = False

    @property
    def columns(self) -> list[str]:
        keys = list(self.by)
        if self.label:
            keys.insert(keys.index(self.label.column) + 1, self.label.name)
        return keys + [m.name for m in self.metrics]


def count(name: str) -> Metric:
    return Metric(name, "count")


def total(name: str, column: str, per: int | None = None, places: int = 2) -> Metric:
    return Metric(name, "sum", column, per, places)


def mean(name: str, column: str, per: int | None = None, places: int = 2) -> Metric:
    return Metric(name, "mean", column, per, places)


def summarize(df: DataFrame, summary: Summary) -> DataFrame:
    """The summary straight from the rows: partial and final hash aggregate on its keys."""
    finals = [
        F.count(F.lit(1)).alias(m.name)
        if m.kind == "count"
        else _final(m, *(added for _, added in _partials(m)))
        for m in summary.metrics
    ]
    return _finish(df.groupBy(*summary.by).agg(*finals), summary)


def rollup_for(df: DataFrame, summaries: Sequence[Summary], by: Sequence[str] = ()) -> DataFrame:
    """Sums and counts at the union of all the summaries' keys (and of `by`).

    One pass over the rows then serves every summary through `summarize_rollup`; rounding
    is left to the end, so the tables are those `summarize` gives.
    """
    keys = list(dict.fromkeys([*by, *(k for s in summaries for k in s.by)]))
    measured: dict[str, Metric] = {}
    for metric in (m for s in summaries for m in s.metrics if m.column is not None):
        known = measured.setdefault(metric.column, metric)
        if known.per != metric.per:
            raise ValueError(f"column {metric.column} is measured in different units")
    partials = [added.alias(name) for m in measured.values() for name, added in _partials(m)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS), *partials)


def rollup_definition(summaries: Sequence[Summary], by: Sequence[str] = ()) -> str:
    """A digest of all that a rollup's columns depend on: its keys, and each measured column with its unit.

    Rounding, labels, and whether a mean or a sum is made of a column do not change the rollup.
    """
    keys = sorted({*by, *(k for s in summaries for k in s.by)})
    measured = sorted({(m.column, m.per or 0) for s in summaries for m in s.metrics if m.column is not None})
    told = json.dumps([keys, measured, exact.LARGEST_UNITS])
    return hashlib.sha256(told.encode()).hexdigest()


def rollup_rows(rollup: DataFrame) -> DataFrame:
    """One row: how many rows the rollup was made from."""
    return rollup.agg(F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows"))


def summarize_rollup(rollup: DataFrame, summary: Summary) -> DataFrame:
    """The summary from a rollup made by `rollup_for`."""
    finals = [
        F.sum(_ROWS).alias(m.name)
        if m.kind == "count"
        else _final(m, *(F.sum(name) for name, _ in _partials(m)))
        for m in summary.metrics
    ]
    return _finish(rollup.groupBy(*summary.by).agg(*finals), summary)


def _partials(metric: Metric) -> list[tuple[str, Column]]:
    """(name, aggregate) of what a metric is made from; each is added up again by a sum."""
    c = metric.column
    if metric.per is None:
        return [(f"_sum_{c}", F.sum(c)), (f"_n_{c}", F.count(c))]
    return [
        (f"_units_{c}", F.sum(exact.units(c, metric.per))),
        (f"_beyond_{c}", F.sum(exact.beyond(c, metric.per))),
        (f"_n_{c}", F.count(c)),
    ]


def _final(metric: Metric, *partials: Column) -> Column:
    *added, present = partials
    if metric.kind == "sum" and metric.per is None:
        value = F.round(added[0], metric.places)
    elif metric.kind == "sum":
        value = exact.total(*added, metric.per, metric.places)
    elif metric.kind == "mean" and metric.per is None:
        value = F.round(F.try_divide(added[0], present), metric.places)
    elif metric.kind == "mean":
        value = exact.mean(*added, present, metric.per, metric.places)
    else:
        raise ValueError(f"unknown metric kind {metric.kind!r}")
    return value.alias(metric.name)


def _finish(table: DataFrame, summary: Summary) -> DataFrame:
    if summary.label:
        table = table.withColumn(summary.label.name, label(summary.label.column, summary.label.labels))
    table = table.select(*summary.columns)
    return table.orderBy(*summary.by) if summary.ordered else table
