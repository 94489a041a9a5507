"""Bring a DataFrame to a declared schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR, MONTH, SOURCE_FILE, INGESTED_AT = "_ingest_year", "_ingest_month", "_source_file", "_ingested_at"


# What reads as a number. A string that does not is made null without a cast: a failed
# try_cast costs an exception per row, some 100 times the price of a good one.
_WHOLE = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_NUMBER = r"(?i)^\s*[+-]?(nan|inf|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?)\s*$"


def resolve(df: DataFrame, name: str) -> str | None:
    """The actual name of a column under the session's case rule, or None."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (), mode: str = "lenient") -> DataFrame:
    """Exactly the schema's columns, in its order and types, then those of `keep` that exist.

    A missing column becomes a typed null and a column in neither list is dropped. A value
    that does not fit its type becomes null (`lenient`) or raises (`strict`). Columns that
    already have their type are passed through, so filters on them still reach the scan.
    """
    if mode not in ("lenient", "strict"):
        raise ValueError(f"mode must be 'lenient' or 'strict', not {mode!r}")
    columns = []
    for field in schema.fields:
        actual = resolve(df, field.name)
        if actual is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _fit(df, actual, field.dataType, mode)
        columns.append(value.alias(field.name))
    kept = [(name, resolve(df, name)) for name in keep]
    columns += [quoted(actual).alias(name) for name, actual in kept if actual is not None]
    return df.select(*columns)


def _fit(df: DataFrame, name: str, target: T.DataType, mode: str) -> Column:
    column, source = quoted(name), df.schema[name].dataType
    if source == target:
        return column
    if not isinstance(source, T.StringType):
        fitted = column.try_cast(target)
    elif isinstance(target, T.IntegralType):
        # A whole number written with decimals ("2.0") is that number.
        fitted = F.when(column.rlike(_WHOLE), column.try_cast("decimal(38,18)").try_cast(target))
    elif isinstance(target, T.NumericType):
        fitted = F.when(column.rlike(_NUMBER), column.try_cast(target))
    elif isinstance(target, T.TimestampType):
        fitted = F.try_to_timestamp(column)
    else:
        fitted = column.try_cast(target)
    if mode == "lenient":
        return fitted
    message = F.concat(
        F.lit(f"column {name}: cannot cast to {target.simpleString()}: "), column.cast("string")
    )
    return F.when(column.isNull() | fitted.isNotNull(), fitted).otherwise(F.raise_error(message))


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stamp_lineage(
    df: DataFrame, year: int, month: int, source_file: str | None = None, ingested_at: dt.datetime | None = None
) -> DataFrame:
    """Add ingest year and month, source file name and ingest time (ISO-8601 UTC text).

    Without `source_file` each row gets the name of the file it was scanned from.
    """
    moment = ingested_at or dt.datetime.now(dt.timezone.utc)
    return df.withColumns(
        {
            YEAR: F.lit(year).cast("int"),
            MONTH: F.lit(month).cast("int"),
            SOURCE_FILE: F.col("_metadata.file_name") if source_file is None else F.lit(source_file),
            INGESTED_AT: F.lit(moment.isoformat()),
        }
    )
