"""Spark session with the settings the jobs rely on."""

from __future__ import annotations

import logging
import math
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the results depend on. Trip times are local wall clock without a zone:
# with UTC nothing shifts, and the same parquet columns load as `timestamp`, so
# time predicates reach the scan without a cast in between.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}

# What only speed depends on; a value given to spark-submit wins.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
DEFAULT_SHUFFLE_PARTITIONS = "200"
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024


def get_spark(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """Session for a job: master, driver memory, jars and shuffle width come from the environment.

    Read: SPARK_MASTER_URL, SPARK_DRIVER_HOST, SPARK_DRIVER_MEMORY, SPARK_JDBC_JAR and
    SPARK_SHUFFLE_PARTITIONS. Under spark-submit the master it was given is kept.
    """
    builder = SparkSession.builder.appName(app_name)
    master = os.environ.get("SPARK_MASTER_URL")
    if master is None and "SPARK_SUBMIT_MODE" not in os.environ and "PYSPARK_GATEWAY_PORT" not in os.environ:
        master = "local[*]"
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            host = os.environ.get("SPARK_DRIVER_HOST", "127.0.0.1")
            builder = (
                builder.config("spark.driver.host", host)
                .config("spark.driver.bindAddress", host)
                .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "4g"))
            )
    jar = os.environ.get("SPARK_JDBC_JAR")
    if jar:
        builder = builder.config("spark.jars", jar)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)

    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    for key, value in TUNING.items():
        if not _given(spark, key):
            spark.conf.set(key, value)
    partitions = os.environ.get("SPARK_SHUFFLE_PARTITIONS")
    if partitions:
        spark.conf.set(SHUFFLE_PARTITIONS, partitions)
    return spark


@contextmanager
def job(name: str) -> Iterator[SparkSession]:
    """The session of a command, which ends with it; progress goes to the log."""
    logging.basicConfig(level=logging.INFO)
    spark = get_spark(name)
    try:
        yield spark
    finally:
        spark.stop()


def working_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, below the one that the cluster's machines share.

    That is spark.checkpoint.dir; only a session that runs in this process alone may do without.
    """
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="lamina-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/lamina-{uuid.uuid4().hex}"


@contextmanager
def shuffle_sized_for(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """The shuffle width for a stage with so much input, while it runs, unless somebody chose one.

    One partition per 128 MB of (compressed) input, and one per core at least. It is an upper bound:
    adaptive execution merges what turns out small. A width from the environment, from spark-submit or
    set on the session stays.
    """
    chosen = os.environ.get("SPARK_SHUFFLE_PARTITIONS") or _given(spark, SHUFFLE_PARTITIONS)
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    if chosen or before != DEFAULT_SHUFFLE_PARTITIONS:
        yield int(before)
        return
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION))
    spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def _given(spark: SparkSession, key: str) -> bool:
    return spark.sparkContext.getConf().contains(key)
