"""Writing layers: partition replacement, table overwrite, JDBC."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lamina.sources import storage
from lamina.sources.files import partition_glob


class EmptyLayerError(ValueError):
    """Nothing was written, and what was there before is still in place."""


def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one output partition together before a partitioned write.

    Spark rebalances: adaptive execution merges small partitions and splits a partition that
    holds too much, so a hot date becomes several tasks and files of the advisory size.
    """
    return df.hint("rebalance", *columns)


def replace_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    within: Mapping[str, object] | None = None,
    also: Sequence[Mapping[str, object]] = (),
) -> int:
    """Write a partitioned parquet layer, replacing only the slices it belongs to; gives the first slice's rows.

    `within` gives the values of leading partition columns, None for any value: the slice is every directory at
    that depth, and those of it that the new data no longer has are dropped. `also` names further slices. Without
    `within`, each partition that the data has is replaced by itself.

    The rows are written beside the layer, under a name that readers skip, and each directory of a slice
    is published whole: the old one is renamed away, the new one into its place. So a reader never sees
    old and new partitions of one directory together, and until the write has succeeded sees the old ones only. If
    the driver is lost between the two renames, the directory is missing until the job is run again. Nothing is published for
    a slice without rows: that raises, whether it held any or not. Only directories are listed, and only of the slices.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    slices = [dict.fromkeys(by) if within is None else dict(within), *map(dict, also)]
    with staged(spark, root) as stage:
        df.write.partitionBy(*by).parquet(stage)
        fresh = [below(spark, stage, values) for values in slices]
        if not fresh[0]:
            raise EmptyLayerError(f"no rows for {dict(within or {})} of {path}; its partitions left as they were")
        written = spark.read.option("basePath", stage).parquet(partition_glob(stage, list(slices[0]), slices[0])).count()
        held = [below(spark, root, values) if within is not None else [] for values in slices]
        units = {unit for found in [*fresh, *held] for unit in found}
        for unit in sorted(units):
            publish(spark, stage, root, unit)
        for unit in below(spark, stage, dict.fromkeys(by)):
            publish(spark, stage, root, unit)
    return written


def overwrite_table(df: DataFrame, path: str) -> int:
    """Overwrite an unpartitioned parquet table; gives its rows, from the footers.

    It is written beside the old one and published whole, as a partition is.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    with staged(spark, parent) as stage:
        df.write.parquet(f"{stage}/{name}")
        rows = spark.read.schema(df.schema).parquet(f"{stage}/{name}").count()
        publish(spark, stage, parent, name)
    return rows


@contextmanager
def staged(spark: SparkSession, root: str) -> Iterator[str]:
    """A directory of a writer's own beside what it replaces, on the same file system; gone afterwards."""
    stage = f"{root}/_staged-{uuid.uuid4().hex}"
    try:
        yield stage
    finally:
        storage.remove(spark, stage)


def below(spark: SparkSession, root: str, values: Mapping[str, object]) -> list[str]:
    """The partition directories with the given leading values, as paths below the root."""
    found = storage.matching(spark, partition_glob(root, list(values), values))
    return ["/".join(directory.split("/")[-len(values) :]) for directory in found]


def publish(spark: SparkSession, stage: str, root: str, unit: str) -> None:
    """Puts a staged directory in the place of the one that is there; only takes that away if none is staged."""
    fresh, target, aside = f"{stage}/{unit}", f"{root}/{unit}", f"{stage}/_replaced/{unit}"
    replaced, staged_ = storage.exists(spark, target), storage.exists(spark, fresh)
    if replaced:
        storage.move(spark, target, aside)
    try:
        if staged_:
            storage.move(spark, fresh, target)
    except Exception:
        if replaced:
            storage.move(spark, aside, target)
        raise


def jdbc_options(dbtable: str, environ: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options for a Postgres table, from POSTGRES_* variables. User and password have no default."""
    env = os.environ if environ is None else environ
    host, port = env.get("POSTGRES_HOST", "postgres"), env.get("POSTGRES_PORT", "5432")
    for name in ("POSTGRES_USER", "POSTGRES_PASSWORD"):
        if name not in env:
            raise KeyError(f"{name} is not set")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{env.get('POSTGRES_GOLD_DB', 'gold')}",
        "dbtable": dbtable,
        "user": env["POSTGRES_USER"],
        "password": env["POSTGRES_PASSWORD"],
        "driver": "org.postgresql.Driver",
    }


def write_jdbc(df: DataFrame, options: Mapping[str, str], truncate: bool = False, connections: int = 8) -> None:
    """Overwrite a database table: dropped and recreated, or emptied with `truncate` (keeps grants, indexes).

    At most `connections` tasks write at once, whatever the size of the cluster.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("truncate", truncate)
        .option("numPartitions", connections)
        .option("batchsize", 10_000)
        .mode("overwrite")
        .save()
    )
