"""Land one month of raw trips unchanged, with lineage."""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import SparkSession

from lamina.operators.conform import MONTH, YEAR, stamp_lineage
from lamina.session import job
from lamina.sources import files, sinks, storage

log = logging.getLogger(__name__)

BRONZE_DIR = "data/bronze/yellow_tripdata"
RAW_DIR = "data/raw"


def raw_path(year: int, month: int) -> str:
    return f"{RAW_DIR}/yellow_tripdata_{year:04d}-{month:02d}.parquet"


def ingest(spark: SparkSession, year: int, month: int, input_path: str, bronze_dir: str) -> dict:
    """Replace the bronze partition of a month by a raw file (or directory); gives run metadata.

    The copy is a narrow scan-and-write with the columns of all the raw files. Counts come from
    file footers, so that a retried task cannot count twice, and the rows written are held against
    the raw ones.
    """
    input_path, bronze_dir = str(input_path), str(bronze_dir)
    if not storage.exists(spark, input_path):
        raise FileNotFoundError(f"{input_path} not found")
    strays = files.stray_entries(spark, bronze_dir)
    if strays:
        log.warning("outside the partition layout of %s: %s; see layout_audit for their rows", bronze_dir, strays)

    source = files.profile(spark, input_path).first()
    raw = files.read_united(spark, input_path)
    log.info("source %s: %s, schema %s", input_path, source.asDict(), raw.schema.simpleString())
    moment = dt.datetime.now(dt.timezone.utc)
    written = sinks.replace_partitions(
        stamp_lineage(raw, year, month, ingested_at=moment), bronze_dir, (YEAR, MONTH), {YEAR: year, MONTH: month}
    )
    if written != source["row_count"]:
        raise RuntimeError(f"{written} rows written of {source['row_count']} in {input_path}")
    metadata = {
        "year": year,
        "month": month,
        "row_count": source["row_count"],
        "column_count": source["column_count"],
        "source_file_size_mb": source["size_mb"],
        "source_file": input_path.rstrip("/").rsplit("/", 1)[-1],
        "ingested_at": moment.isoformat(),
    }
    log.info("bronze ingest complete: %s", metadata)
    return metadata


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, required=True)
    parser.add_argument("--input", help="raw parquet file or directory")
    parser.add_argument("--bronze-dir", default=BRONZE_DIR)
    args = parser.parse_args(argv)
    with job("bronze_ingest") as spark:
        ingest(spark, args.year, args.month, args.input or raw_path(args.year, args.month), args.bronze_dir)


if __name__ == "__main__":
    main()
