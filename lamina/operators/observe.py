"""Counts taken by the very pass that cleans and writes, without a scan of their own.

Spark hands the counts of `DataFrame.observe` to the driver when the action ends. A stage that runs again after
a lost executor can count its rows again, so the counts are held against rows that are counted otherwise (footers,
say) before they are believed: see `Cleaning.agrees`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamina.operators.clean import Rule, all_met
from lamina.operators.retention import retention_pct


class Cleaning:
    """Rows into and out of rules and dedup, and how many each rule fails, seen while the result is written.

    `of` restricts what is counted (rows of neighbouring months pass through a month's cleaning, say). An
    object serves one action.
    """

    def __init__(self, of: Column | None = None):
        self._of = F.lit(True) if of is None else F.coalesce(of, F.lit(False))
        self._before, self._after = Observation(), Observation()
        self._names: list[str] = []

    def before(self, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """Counts the rows that come in, and those that fail each rule taken alone and any of them."""
        self._names = [r.name for r in rules]
        met = [F.coalesce(r.predicate, F.lit(False)) for r in rules]
        valid = F.coalesce(all_met(rules), F.lit(False)) if rules else F.lit(True)
        failed = [F.count_if(self._of & ~ok).alias(f"failed{i}") for i, ok in enumerate(met)]
        return df.observe(self._before, F.count_if(self._of).alias("rows_in"), F.count_if(self._of & ~valid).alias("invalid"), *failed)

    def after(self, df: DataFrame) -> DataFrame:
        """Counts the rows that are kept."""
        return df.observe(self._after, F.count_if(self._of).alias("rows_out"))

    def agrees(self, rows_in: int, rows_out: int) -> bool:
        """Whether the counts are those of the tables: if not, a stage has run twice."""
        found = self._before.get, self._after.get
        return (found[0]["rows_in"], found[1]["rows_out"]) == (rows_in, rows_out)

    def failed(self) -> dict[str, int]:
        found = self._before.get
        return {name: found[f"failed{i}"] for i, name in enumerate(self._names)}

    def metrics(self) -> dict:
        """rows_in, invalid, duplicates, rows_out, retention_pct and failed (by rule), once the action has ended."""
        before, rows_out = self._before.get, self._after.get["rows_out"]
        return {
            "rows_in": before["rows_in"],
            "invalid": before["invalid"],
            "duplicates": before["rows_in"] - before["invalid"] - rows_out,
            "rows_out": rows_out,
            "retention_pct": retention_pct(before["rows_in"], rows_out),
            "failed": self.failed(),
        }


def metrics_table(df: DataFrame, found: dict) -> DataFrame:
    """`Cleaning.metrics` as rows (metric, value); a rule's failures are named failed.<rule>."""
    flat = [(k, float(v)) for k, v in found.items() if k != "failed"] + [(f"failed.{k}", float(v)) for k, v in found["failed"].items()]
    return df.sparkSession.createDataFrame(flat, "metric string, value double")
