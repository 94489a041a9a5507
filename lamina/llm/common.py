"""What the operators of this package share: checkpoints, columns computed from texts, components."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A slice of texts handed to a task's computation at once; a longer text is a slice of its own.
SLICE_CHARS = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, from the session.

    Only a session that runs in this process alone and names no folder gets a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="lamina-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows cut from their lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def landed(df: DataFrame, folder: str) -> DataFrame:
    """The rows cut from their lineage by a table of their own, which can be dropped when it is of no more use."""
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when its action ends, for work that lands each step as a table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, tasks exchange at most so many rows at once with Python, for work whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_fold(doc_id: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into a fold; never, for a null id."""
    column = F.col(f"`{doc_id}`") if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % folds == fold, F.lit(False))


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[list[str | None]]:
    """Consecutive texts in slices of about `limit` characters, so that memory follows that and the longest text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def with_text_columns(
    df: DataFrame, text: str, added: T.StructType, compute: Callable[[list[str | None]], list[list]]
) -> DataFrame:
    """The frame with columns that a task computes from a text column, slice by slice.

    `compute` gets the texts of a slice and gives one list of values per added column. A
    column of the frame that has the name of an added one is replaced.
    """
    kept = [c for c in df.columns if c not in added.names]
    passed = [F.col(f"`{c}`") for c in kept]
    if text in kept and isinstance(df.schema[text].dataType, T.StringType):
        source, position = df.select(*passed), kept.index(text)
    else:
        source, position = df.select(*passed, F.col(f"`{text}`").cast("string").alias("__text")), len(kept)
    schema = T.StructType(source.schema.fields[: len(kept)] + added.fields)
    width = len(kept)
    types = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, done = batch.column(position).to_pylist(), 0
            for piece in slices(texts):
                columns = [c.slice(done, len(piece)) for c in batch.columns[:width]]
                computed = [pa.array(v, type=t) for v, t in zip(compute(piece), types)]
                done += len(piece)
                yield pa.RecordBatch.from_arrays(columns + computed, names=schema.names)

    return source.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (node, root): the smallest node that each node can reach.

    Alternating stars: a node first links its larger neighbours, then its smaller ones, to
    the smallest that it sees, until every edge leads to a root. Rounds grow with the
    logarithm of the longest chain, each is joins and partial minima (no group of a node's
    neighbours is ever built), and its edges are checkpointed. Loops and repeated edges do
    nothing; nodes without an edge do not appear.
    """

    def tidy(df: DataFrame) -> DataFrame:
        return checkpointed(df.where("hi != lo").distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.select(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    now = tidy(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))
    before = None
    while (found := state(now)) != before:
        before = found
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least)
        now = tidy(small)
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
