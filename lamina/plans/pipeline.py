"""Bronze, silver and gold of a month in one session, with a quality gate after each layer."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.quality import Suite
from lamina.plans import bronze, gold, silver, suites, trips
from lamina.session import job

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Chain:
    """One month's way through the layers: where they are, and how their values are read.

    `layers` names each layer with its job and its gates; a gate is a suite and the rows it looks at, which for
    bronze and silver are the month's.
    """

    spark: SparkSession
    year: int
    month: int
    input_path: str
    bronze_dir: str = bronze.BRONZE_DIR
    silver_dir: str = silver.SILVER_DIR
    gold_dir: str = gold.GOLD_DIR
    zones_path: str = silver.ZONES_PATH
    write_database: bool = True
    mode: str = "lenient"

    @property
    def layers(self) -> list[tuple[str, Callable[[], dict], Callable[[Mapping], list]]]:
        return [("bronze", self._land, self._bronze_gates), ("silver", self._refine, self._silver_gates), ("gold", self._sum_up, self._gold_gates)]

    def _land(self) -> dict:
        return bronze.ingest(self.spark, self.year, self.month, self.input_path, self.bronze_dir)

    def _refine(self) -> dict:
        return silver.transform(self.spark, self.bronze_dir, self.silver_dir, self.year, self.month, self.zones_path, self.mode)

    def _sum_up(self) -> dict:
        return gold.aggregate(self.spark, self.silver_dir, self.gold_dir, self.write_database)

    def _gate(self, layer: str, suite: Suite, path: str) -> tuple[Suite, DataFrame]:
        return suite, suites.GATES[layer].read(self.spark, path, self.year, self.month)

    def _bronze_gates(self, _results: Mapping) -> list:
        return [self._gate("bronze", suites.bronze_suite(), self.bronze_dir)]

    def _silver_gates(self, results: Mapping) -> list:
        around = silver.around(self.spark, self.silver_dir, self.year, self.month)
        return [self._gate("silver", suites.silver_suite(results["bronze"]["row_count"]), self.silver_dir), (suites.overlap_suite(), around)]

    def _gold_gates(self, _results: Mapping) -> list:
        return [self._gate("gold", suites.gold_suite(table.name), f"{self.gold_dir}/{table.name}") for table in trips.GOLD]

    def run(self, check: bool = True) -> dict:
        """Runs the layers in turn; gives each one's metadata. A gate that fails raises, and nothing after it is run."""
        results: dict = {}
        for name, work, gates in self.layers:
            results[name] = work()
            for suite, rows in gates(results) if check else ():
                suites.passed(suite, rows)
        return results

    def report(self, results: Mapping) -> DataFrame:
        """The findings of every gate over the layers as they are, as one table; see `Suite.report`."""
        found = [suite.report(rows) for _, _, gates in self.layers for suite, rows in gates(results)]
        return reduce(DataFrame.unionByName, found)


def run(spark: SparkSession, year: int, month: int, input_path: str, *dirs: str, check: bool = True, **options) -> dict:
    """`Chain(...).run(check)` in one call; `dirs` are the bronze, silver and gold directories and the zones' path."""
    return Chain(spark, year, month, input_path, *dirs, **options).run(check)


def run_metrics(spark: SparkSession, results: Mapping) -> DataFrame:
    """What `run` (or one layer's job, under its name) gave, as rows (layer, metric, value, text).

    A number is in value, anything else in text; metrics of single tables are named table.metric.
    """

    def rows(layer: str, found: Mapping, prefix: str = ""):
        for name, value in found.items():
            if isinstance(value, Mapping):
                yield from rows(layer, value, f"{prefix}{name}.")
            else:
                number = isinstance(value, (int, float)) and not isinstance(value, bool)
                yield layer, prefix + name, float(value) if number else None, None if number or value is None else str(value)

    flat = [row for layer, found in results.items() for row in rows(layer, found)]
    return spark.createDataFrame(flat, "layer string, metric string, value double, text string")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, required=True)
    parser.add_argument("--input", help="raw parquet file or directory")
    parser.add_argument("--bronze-dir", default=bronze.BRONZE_DIR)
    parser.add_argument("--silver-dir", default=silver.SILVER_DIR)
    parser.add_argument("--gold-dir", default=gold.GOLD_DIR)
    parser.add_argument("--zones", default=silver.ZONES_PATH)
    silver.add_strict(parser)
    parser.add_argument("--no-postgres", action="store_true", help="write parquet only")
    parser.add_argument("--skip-dq", action="store_true", help="skip the quality gates")
    args = parser.parse_args(argv)
    source = args.input or bronze.raw_path(args.year, args.month)
    with job("trip_pipeline") as spark:
        chain = Chain(
            spark, args.year, args.month, source, args.bronze_dir, args.silver_dir, args.gold_dir, args.zones,
            write_database=not args.no_postgres, mode=silver.mode_of(args),
        )
        results = chain.run(check=not args.skip_dq)
    log.info("all layers of %d-%02d written:\n%s", args.year, args.month, json.dumps(results, indent=2))


if __name__ == "__main__":
    main()
