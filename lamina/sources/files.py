"""Scans of parquet layers and CSV tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.conform import MONTH, YEAR, conform, quoted, resolve
from lamina.sources import storage

INGEST_LEVELS = (YEAR, MONTH)
CORRUPT_LINE = "_corrupt_line"


def profile(spark: SparkSession, path: str) -> DataFrame:
    """(row_count, column_count, file_count, size_mb) of a parquet file or directory.

    Rows are counted from the footers, files (also empty ones) and bytes from the listing. Columns are those
    of all files together.
    """
    df = read_united(spark, path)
    with storage.listing(spark):
        listed = storage.file_table(spark, path).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return rows_of(df).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(listed["n"]).cast("long").alias("file_count"),
        F.round(F.lit(listed["bytes"]) / F.lit(1e6), 2).alias("size_mb"),
    )


def read_united(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file or directory with the columns of all its files; where one lacks a column it is null.

    Files that give one column different types fail, with an error that names it.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def rows_of(df: DataFrame) -> DataFrame:
    """One row: row_count. Over a parquet scan it reads footers, not data."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def row_count(spark: SparkSession, path: str, only: Mapping[str, int] | None = None) -> int:
    """Rows of a layer, or of the partitions chosen by `only`."""
    return rows_of(only_partitions(spark.read.parquet(path), only)).first()["row_count"]


def only_partitions(df: DataFrame, only: Mapping[str, int | None] | None) -> DataFrame:
    """Keep the partitions with the given values; a None value does not restrict."""
    for name, value in (only or {}).items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def read_conformed(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keep: Sequence[str] = (),
    levels: Sequence[str] = INGEST_LEVELS,
    only: Mapping[str, int | None] | None = None,
    mode: str = "lenient",
) -> DataFrame:
    """A partitioned layer whose files may differ in schema.

    Spark reads one scan with one schema, and a column that is `bigint` in one file and `double` in another
    fails it. So files that agree are read in one scan, each scan is conformed, and the results are
    united; see `by_schema`. Without drift that is a single scan. `only` limits the directories listed.
    """
    directories = storage.matching(spark, partition_glob(root, levels, only))
    if not directories:
        raise FileNotFoundError(f"no partition {dict(only or {})} under {root}")
    reader = spark.read.option("basePath", root)
    scans = [conform(reader.schema(known).parquet(*group), schema, keep, mode) for known, group in by_schema(spark, root, directories)]
    # A column of `keep` may be in some files only.
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def by_schema(spark: SparkSession, root: str, directories: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, paths) of parquet directories: paths whose files have that schema's types, or lack columns.

    One Spark job reads the footers of all files together, which is all there is to do where they agree. Where
    a column has two types, the files are put in the order in which they were written, as drift is, and
    halved until each part agrees; parts that agree with each other are put together again. So k changes
    of a type among n files cost some k * log2(n) jobs, wherever in a partition they are.
    """
    if (found := _schema_of(spark, root, directories)) is not None:
        return [(found, list(directories))]
    found = spark.read.format("binaryFile").load([f"{d}/*" for d in directories]).select("path", "modificationTime")
    with storage.listing(spark):
        paths = [r["path"] for r in found.orderBy("modificationTime", "path").collect()]
    groups: list[tuple[T.StructType, list[str]]] = []
    for known, part in _halved(spark, root, paths):
        for i, (other, held) in enumerate(groups):
            if (both := _merged(other, known)) is not None:
                groups[i] = (both, held + part)
                break
        else:
            groups.append((known, part))
    return groups


def _schema_of(spark: SparkSession, root: str, paths: Sequence[str]) -> T.StructType | None:
    """The columns of all files together; None if they give a column two types."""
    try:
        return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths).schema
    except Exception as raised:  # Spark gives this one as whatever its driver or a task raised
        if "CANNOT_MERGE" not in str(raised):
            raise
        return None


def _halved(spark: SparkSession, root: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    if (found := _schema_of(spark, root, paths)) is not None:
        return [(found, paths)]
    half = len(paths) // 2
    return _halved(spark, root, paths[:half]) + _halved(spark, root, paths[half:])


def _merged(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The columns of both, if those that both have are of one type."""
    types = {f.name.lower(): f.dataType for f in a.fields}
    if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in b.fields):
        return None
    return T.StructType(a.fields + [f for f in b.fields if f.name.lower() not in types])


def partition_glob(root: str, levels: Sequence[str], only: Mapping[str, int | None] | None = None) -> str:
    """Glob of the partition directories with the given values; other values are free."""
    values = {level: (only or {}).get(level) for level in levels}
    return "/".join([root.rstrip("/"), *(f"{k}={'*' if v is None else v}" for k, v in values.items())])


def layer_bytes(spark: SparkSession, root: str, only: Mapping[str, int | None] | None = None) -> int:
    """Size on disk of a layer or of some of its partitions, by listing."""
    directories = storage.matching(spark, partition_glob(root, INGEST_LEVELS, only))
    return sum(storage.size_bytes(spark, d) for d in directories)


def stray_entries(spark: SparkSession, root: str, levels: Sequence[str] = INGEST_LEVELS) -> list[str]:
    """Entries of a partitioned directory that a scan would see but that are not `level=...`.

    Looks at the root and at each level of partition directories, by listing only.
    """
    found, parent = [], root.rstrip("/")
    for level in levels:
        names = {p: p.rsplit("/", 1)[-1] for p in storage.matching(spark, f"{parent}/*")}
        found += [p for p, name in names.items() if not name.startswith(f"{level}=") and not _hidden(name)]
        parent += f"/{level}=*"
    return found


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def layout_audit(spark: SparkSession, root: str, levels: Sequence[str] = INGEST_LEVELS) -> DataFrame:
    """(in_layout, files, rows) of all data files below a directory, and the rows of the parquet ones.

    A file that is not at `level=value/.../file` is skipped by a partitioned read of the root, or makes it
    fail; here every file is looked up, whatever its place and name. Files come from Spark's listing, rows
    from footers, and both are counted by tasks.
    """
    place = "^" + "/".join(f"{re.escape(level)}=[^/]+" for level in levels)
    parquet = spark.read.schema(T.StructType()).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    above = storage.without_scheme(spark, root)
    below = F.substring(path, F.instr(path, F.lit(above)) + F.lit(len(above) + 1), F.length(path))
    inside = below.rlike(f"{place}/[^/]+$").alias("inside")
    rows = {r.inside: r.n for r in parquet.groupBy(inside).agg(F.count(F.lit(1)).alias("n")).collect()}
    with storage.listing(spark):
        listed = storage.file_table(spark, root).groupBy(F.col("directory").rlike(f"{place}$").alias("inside")).count().collect()
    found = [(r["inside"], r["count"], rows.get(r["inside"], 0)) for r in listed]
    return spark.createDataFrame(found, "in_layout boolean, files long, rows long")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, mode: str = "lenient", columns: Sequence[str] | None = None) -> DataFrame:
    """The schema's columns of a CSV file, found by name; no type inference pass.

    Names come from the header, or from `columns` for files without one. A line with too few or too many fields is left
    out (`lenient`; see `csv_lines` for these) or raises (`strict`), and so does a value that does not fit its type.
    """
    lines = csv_lines(spark, path, columns)
    if mode == "lenient":
        lines = lines.where(F.col(CORRUPT_LINE).isNull())
    else:
        broken = F.concat(F.lit(f"broken line in {path}: "), F.col(CORRUPT_LINE))
        lines = lines.withColumn(CORRUPT_LINE, F.when(F.col(CORRUPT_LINE).isNotNull(), F.raise_error(broken)))
        lines = lines.where(F.col(CORRUPT_LINE).isNull())
    return conform(lines, schema, mode=mode)


def csv_lines(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The lines of CSV files as text columns, with CORRUPT_LINE: the whole of a line whose fields are not as many as the columns."""
    header = columns is None
    names = spark.read.option("header", True).csv(path).columns if header else list(columns)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT_LINE]])
    # Unpruned, as a parser that skips fields does not see that some are missing.
    options = {"header": header, "enforceSchema": not header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_LINE, "columnPruning": False}
    lines = spark.read.schema(schema).options(**options).csv(path)
    # Read with a field beside it, as Spark refuses to parse for the corrupt lines alone.
    corrupt = F.when(F.col(CORRUPT_LINE).isNotNull(), F.coalesce(F.col(CORRUPT_LINE), quoted(names[0])))
    return lines.withColumn(CORRUPT_LINE, corrupt)


def csv_report(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: lines, broken (with too few or too many fields), and of the others unfit_<column>: values that do not fit."""
    lines = csv_lines(spark, path, columns)
    there = {f.name: resolve(lines, f.name) for f in schema.fields if resolve(lines, f.name)}
    texts = {f"_text_{name}": quoted(actual) for name, actual in there.items()}
    fitted = conform(lines.withColumns(texts), schema, [CORRUPT_LINE, *texts])
    whole = F.col(CORRUPT_LINE).isNull()
    unfit = [F.count_if(whole & quoted(f"_text_{n}").isNotNull() & quoted(n).isNull()).alias(f"unfit_{n}") for n in there]
    return fitted.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~whole).alias("broken"), *unfit)
