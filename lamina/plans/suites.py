"""Quality gates of the three layers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.conform import MONTH, SOURCE_FILE, YEAR
from lamina.operators.quality import ERROR, Suite, SuiteResult
from lamina.plans import trips
from lamina.sources import files

# Bounds and column lists of the published gates.
RETENTION_BOUNDS = (0.80, 1.00)
BRONZE_COLUMNS = ("VendorID", trips.PICKUP, trips.DROPOFF, "fare_amount", "PULocationID", "DOLocationID", YEAR, MONTH, SOURCE_FILE)
SILVER_COLUMNS = (
    trips.PICKUP, trips.DROPOFF, "fare_amount", "trip_distance", "PULocationID", "DOLocationID", "pickup_date",
    "pickup_borough", "dropoff_borough",
)
SILVER_RANGES = (("fare_amount", 0, 1000, 1.0), ("trip_distance", 0.001, 200, 1.0), ("trip_duration_minutes", 0, 1440, 1.0), ("passenger_count", 0, 9, 0.999))


def bronze_suite() -> Suite:
    suite = Suite("bronze_yellow_tripdata")
    for column in BRONZE_COLUMNS:
        suite.expect_column_to_exist(column)
    suite.expect_table_row_count_to_be_between(min_value=1)
    return suite.expect_column_values_to_not_be_null(trips.PICKUP, mostly=0.99)


def silver_suite(bronze_row_count: int | None = None) -> Suite:
    suite = Suite("silver_yellow_tripdata")
    for column in SILVER_COLUMNS:
        suite.expect_column_to_exist(column)
        suite.expect_column_values_to_not_be_null(column)
    for column, low, high, mostly in SILVER_RANGES:
        suite.expect_column_values_to_be_between(column, low, high, mostly=mostly)
    suite.expect_no_exact_duplicate_rows(list(trips.TRIP_KEY), severity=ERROR)
    suite.expect_table_row_count_to_be_between(min_value=1)
    if bronze_row_count:
        low, high = RETENTION_BOUNDS
        rows = F.count(F.lit(1))
        kept = rows / F.lit(bronze_row_count)
        suite.expect_custom(
            "expect_bronze_to_silver_retention_within_bounds",
            (kept >= low) & (kept <= high),
            details=F.format_string("kept %d of %d bronze rows", rows, F.lit(bronze_row_count)),
            observed=kept,
            threshold=low,
        )
    return suite


def gold_suite(table_name: str) -> Suite:
    """At least one row; each metric there, non-null and not negative. Of an unknown table only the rows."""
    suite = Suite(f"gold_{table_name}")
    suite.expect_table_row_count_to_be_between(min_value=1)
    table = trips.GOLD_BY_NAME.get(table_name)
    for metric in table.metrics if table else ():
        suite.expect_column_to_exist(metric.name)
        suite.expect_column_values_to_not_be_null(metric.name)
        suite.expect_column_values_to_be_between(metric.name, min_value=0)
    return suite


def overlap_suite() -> Suite:
    """Of a month and the days that its neighbours share with it: no key twice."""
    return Suite("silver_overlap").expect_no_exact_duplicate_rows(list(trips.TRIP_KEY), severity=ERROR)


@dataclass(frozen=True)
class Gate:
    """How a layer is checked: which suite, and whether its files are partitioned by ingest month."""

    suite: Callable[..., Suite]
    by_month: bool

    def read(self, spark: SparkSession, path: str, year: int | None = None, month: int | None = None) -> DataFrame:
        df = spark.read.parquet(str(path))
        return files.only_partitions(df, {YEAR: year, MONTH: month}) if self.by_month else df


GATES = {"bronze": Gate(bronze_suite, True), "silver": Gate(silver_suite, True), "gold": Gate(gold_suite, False)}


def passed(suite: Suite, df: DataFrame, raise_on_failure: bool = True) -> SuiteResult:
    result = suite.run(df)
    if raise_on_failure:
        result.raise_if_failed()
    return result


def run_bronze_checks(df: DataFrame, raise_on_failure: bool = True) -> SuiteResult:
    return passed(bronze_suite(), df, raise_on_failure)


def run_silver_checks(df: DataFrame, bronze_row_count: int | None = None, raise_on_failure: bool = True) -> SuiteResult:
    return passed(silver_suite(bronze_row_count), df, raise_on_failure)


def run_gold_checks(df: DataFrame, table_name: str, raise_on_failure: bool = True) -> SuiteResult:
    return passed(gold_suite(table_name), df, raise_on_failure)
