"""Clean, derive and enrich bronze trips."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.clean import all_met
from lamina.operators.conform import MONTH, YEAR
from lamina.operators.observe import Cleaning
from lamina.operators.retention import retention_pct
from lamina.plans import trips
from lamina.plans.bronze import BRONZE_DIR, RAW_DIR
from lamina.session import job, shuffle_sized_for
from lamina.sources import files, sinks, storage

log = logging.getLogger(__name__)

SILVER_DIR = "data/silver/yellow_tripdata"
ZONES_PATH = f"{RAW_DIR}/taxi_zone_lookup.csv"


def transform(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    year: int | None = None,
    month: int | None = None,
    zones_path: str = ZONES_PATH,
    mode: str = "lenient",
) -> dict:
    """Rebuild the silver partitions of a month (or of all); gives run metadata.

    One pass over bronze and two shuffles: rows to their key (dedup), then rows to their
    output partition. The rows in and out are counted from file footers; how many rows each rule fails, and how many
    are copies, is counted by that pass, and again by a scan only if its counts are not the footers'.

    A trip that two months hold belongs to the earlier one, however the months are run: a month
    is deduplicated together with the days that its neighbours share with it, and those days of
    the next month, if it is in silver, are written again.
    """
    bronze_dir, silver_dir = str(bronze_dir), str(silver_dir)
    if month and not year:
        raise ValueError("a month needs its year")
    chosen = {YEAR: year, MONTH: month}
    zones = files.read_csv_table(spark, str(zones_path), trips.ZONES)
    seen = Cleaning(_ingested_in(year, month) if year else None)
    with shuffle_sized_for(spark, files.layer_bytes(spark, bronze_dir, chosen)):
        if year:
            silver, also = _month(spark, bronze_dir, silver_dir, year, month, zones, mode, seen)
        else:
            bronze = files.read_conformed(spark, bronze_dir, trips.CONTRACT, trips.LINEAGE, mode=mode)
            silver, also = trips.to_silver(bronze, zones, seen), []
        silver_rows = sinks.replace_partitions(
            sinks.spread_by(silver, trips.SILVER_PARTITIONS), silver_dir, trips.SILVER_PARTITIONS, chosen, also
        )
    bronze_rows = files.row_count(spark, bronze_dir, chosen)
    metadata = {
        "bronze_rows": bronze_rows,
        "silver_rows": silver_rows,
        "rows_dropped": bronze_rows - silver_rows,
        "retention_pct": retention_pct(bronze_rows, silver_rows),
        **_drops(spark, seen, bronze_dir, chosen, mode, bronze_rows, silver_rows),
    }
    log.info("silver transform complete: %s", metadata)
    return metadata


def _drops(spark, seen, bronze_dir, chosen, mode, bronze_rows, silver_rows) -> dict:
    """What was dropped and why: as the writing pass saw it, or by a scan if a stage of that has run twice."""
    if seen.agrees(bronze_rows, silver_rows):
        found = seen.metrics()
        invalid, failed = found["invalid"], found["failed"]
    else:
        log.warning("the counts of the writing pass are not those of the footers; counting anew")
        bronze = files.read_conformed(spark, bronze_dir, trips.CONTRACT, trips.LINEAGE, only=chosen, mode=mode)
        rules = trips.rules(bronze)
        counts = bronze.agg(
            F.count_if(~F.coalesce(all_met(rules), F.lit(False))).alias("invalid"),
            *[F.count_if(~F.coalesce(r.predicate, F.lit(False))).alias(f"failed{i}") for i, r in enumerate(rules)],
        ).first()
        invalid, failed = counts["invalid"], {r.name: counts[f"failed{i}"] for i, r in enumerate(rules)}
    return {"invalid": invalid, "duplicates": bronze_rows - invalid - silver_rows, "failed": failed}


def _ingested_in(year: int, month: int | None):
    first, after = trips.month_span(year, month)
    ingested = F.make_date(YEAR, MONTH, F.lit(1))
    return (ingested >= F.lit(first)) & (ingested < F.lit(after))


def _month(spark, bronze_dir, silver_dir, year, month, zones, mode, seen) -> tuple[DataFrame, list[dict]]:
    """(rows, further slices): silver of a month, and the shared days of the next if that is there."""
    first, after = trips.month_span(year, month)
    before = first - dt.timedelta(days=1)

    def read(only, needed=False):
        if not needed and not storage.matching(spark, files.partition_glob(bronze_dir, files.INGEST_LEVELS, only)):
            return []
        return [files.read_conformed(spark, bronze_dir, trips.CONTRACT, trips.LINEAGE, only=only, mode=mode)]

    following = {YEAR: after.year, MONTH: after.month}
    parts = [*read({YEAR: year, MONTH: month}, needed=True), *read({YEAR: before.year, MONTH: before.month}), *read(following)]
    silver = trips.to_silver(trips.in_reach(reduce(DataFrame.unionByName, parts), year, month), zones, seen)
    ingested, own = F.make_date(YEAR, MONTH, F.lit(1)), _ingested_in(year, month)
    if not storage.matching(spark, files.partition_glob(silver_dir, files.INGEST_LEVELS, following)):
        return silver.where(own), []
    return silver.where(ingested >= F.lit(first)), [{**following, "pickup_date": day} for day in trips.shared_days(after)]


def around(spark: SparkSession, silver_dir: str, year: int, month: int | None = None) -> DataFrame:
    """Silver rows of a month and of the days that its neighbours share with it: where a key may occur once."""
    return trips.in_reach(spark.read.parquet(str(silver_dir)), year, month)


def add_strict(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--strict", action="store_true", help="fail on a value that does not fit its type")


def mode_of(args: argparse.Namespace) -> str:
    return "strict" if args.strict else "lenient"


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--year", type=int)
    parser.add_argument("--month", type=int)
    parser.add_argument("--bronze-dir", default=BRONZE_DIR)
    parser.add_argument("--silver-dir", default=SILVER_DIR)
    parser.add_argument("--zones", default=ZONES_PATH)
    add_strict(parser)
    args = parser.parse_args(argv)
    with job("silver_transform") as spark:
        transform(spark, args.bronze_dir, args.silver_dir, args.year, args.month, args.zones, mode_of(args))


if __name__ == "__main__":
    main()
