"""Summary tables of silver, to parquet and to a database."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.aggregate import rollup_definition, rollup_for, rollup_rows, summarize, summarize_rollup
from lamina.plans import trips
from lamina.plans.silver import SILVER_DIR
from lamina.session import job, shuffle_sized_for
from lamina.sources import files, sinks, storage

log = logging.getLogger(__name__)

GOLD_DIR = "data/gold"


def build(df: DataFrame, table_name: str) -> DataFrame:
    """One gold table straight from silver rows."""
    return summarize(df, trips.GOLD_BY_NAME[table_name])


def rollup_dir(gold_dir: str) -> str:
    return f"{str(gold_dir).rstrip('/')}/rollup"


def sources_table(gold_dir: str) -> str:
    return f"{str(gold_dir).rstrip('/')}/rollup_sources"


def partition_files(spark: SparkSession, root: str) -> dict[str, tuple]:
    """Partition directory below a layer's root -> (files, a sum over their names). As many as the layout has.

    Every write gives its files new names, so a partition that was written anew, or lost or gained a file, differs.
    """
    names = F.sum(F.xxhash64("name").cast("decimal(38,0)")).alias("names")
    with storage.listing(spark):
        found = storage.file_table(spark, root).where(F.col("directory") != "").groupBy("directory").agg(F.count("*").alias("files"), names)
        return {r["directory"]: (r["files"], r["names"]) for r in found.collect()}


def rolled_files(spark: SparkSession, gold_dir: str) -> dict[str, tuple]:
    """What the rollup was made from, as `partition_files` gave it; nothing of a rollup that was defined otherwise."""
    if not storage.exists(spark, sources_table(gold_dir)) or not storage.exists(spark, rollup_dir(gold_dir)):
        return {}
    known = spark.read.parquet(sources_table(gold_dir)).where(F.col("definition") == definition())
    return {r["directory"]: (r["files"], r["names"]) for r in known.collect()}


def definition() -> str:
    return rollup_definition(trips.GOLD, trips.SILVER_PARTITIONS)


def stale_partitions(spark: SparkSession, silver_dir: str, gold_dir: str) -> tuple[list[str], list[str], dict[str, tuple]]:
    """Partitions of silver that the rollup lacks or has from other files, those that silver lost, and silver's files."""
    silver, rolled = partition_files(spark, silver_dir), rolled_files(spark, gold_dir)
    stale = sorted(d for d, held in silver.items() if rolled.get(d) != held)
    return stale, sorted(d for d in rolled if d not in silver), silver


def refresh_rollup(spark: SparkSession, silver_dir: str, gold_dir: str) -> DataFrame:
    """The rollup of all of silver, for which only partitions that changed since are read.

    It holds sums at ingest month, date, hour, zone and payment type, so that its size follows the calendar
    and the zones, and is partitioned as silver is. Beside it stands what it was made from: for each partition silver's
    files, and how the rollup is defined (its keys, columns and their units). What was made from other files is
    made again, and under another definition all of it is; partitions that silver no longer has are dropped.
    """
    rolled_dir, levels = rollup_dir(gold_dir), trips.SILVER_PARTITIONS
    stale, gone, silver = stale_partitions(spark, silver_dir, gold_dir)
    if stale:
        whole = len(stale) == len(silver)
        paths = [silver_dir] if whole else [f"{silver_dir.rstrip('/')}/{d}" for d in stale]
        changed = spark.read.option("basePath", silver_dir).parquet(*paths)
        with shuffle_sized_for(spark, files.layer_bytes(spark, silver_dir)):
            rollup = rollup_for(changed, trips.GOLD, levels)
            sinks.replace_partitions(sinks.spread_by(rollup, levels), rolled_dir, levels, {levels[0]: None} if whole else None)
    if stale or gone:
        for directory in gone:
            storage.remove(spark, f"{rolled_dir}/{directory}")
        made_from = [(d, n, names, definition()) for d, (n, names) in sorted(silver.items())]
        told = spark.createDataFrame(made_from, "directory string, files long, names decimal(38,0), definition string")
        sinks.overwrite_table(told.coalesce(1), sources_table(gold_dir))
    return spark.read.parquet(rolled_dir)


def aggregate(spark: SparkSession, silver_dir: str, gold_dir: str, write_database: bool = True) -> dict:
    """Write the five gold tables; gives row counts.

    They are added up from the rollup beside them, which is brought up to date first.
    """
    silver_dir, gold_dir = str(silver_dir), str(gold_dir)
    options = {table.name: sinks.jdbc_options(table.name) for table in trips.GOLD} if write_database else {}
    rollup = refresh_rollup(spark, silver_dir, gold_dir)
    silver_rows = rollup_rows(rollup).first()["rows"]
    rows = {}
    for table in trips.GOLD:
        path = f"{gold_dir}/{table.name}"
        rows[table.name] = sinks.overwrite_table(summarize_rollup(rollup, table), path)
        log.info("built %s: %d rows", table.name, rows[table.name])
        if write_database:
            sinks.write_jdbc(spark.read.parquet(path), options[table.name])
    return {"silver_rows": silver_rows, "gold_table_rows": rows}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--silver-dir", default=SILVER_DIR)
    parser.add_argument("--gold-dir", default=GOLD_DIR)
    parser.add_argument("--no-postgres", action="store_true", help="write parquet only")
    args = parser.parse_args(argv)
    with job("gold_aggregate") as spark:
        aggregate(spark, args.silver_dir, args.gold_dir, write_database=not args.no_postgres)


if __name__ == "__main__":
    main()
