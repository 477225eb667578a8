"""Shared shapes: one row per (column, value), counted once and used by many reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_AS_NULL = (T.FloatType, T.DoubleType)


def col(name: str) -> Column:
    """Column by exact name, also with blanks or dots in it."""
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def categorical_columns(df: DataFrame) -> list[str]:
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def present_value(df: DataFrame, name: str) -> Column:
    """The value with NaN turned into null, so that both count as missing."""
    if isinstance(df.schema[name].dataType, MISSING_AS_NULL):
        return F.when(~F.isnan(col(name)), col(name))
    return col(name)


def as_double(df: DataFrame, name: str) -> Column:
    return present_value(df, name).cast("double")


def as_text(df: DataFrame, name: str) -> Column:
    """Text of a value; -0.0 and 0.0 are one value, so they get one text."""
    value = present_value(df, name)
    if isinstance(df.schema[name].dataType, MISSING_AS_NULL):
        value = value + F.lit(0.0).cast(df.schema[name].dataType)
    return value.cast("string")


def value_counts_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) over the texts of several columns, missing values included.

    Equal values are merged inside the map tasks, so a value holding most rows costs one row
    per task in the only shuffle.
    """
    entries = [
        F.struct(F.lit(c).alias("column"), as_text(df, c).alias("value")) for c in columns
    ]
    stacked = df.select(F.inline(F.array(*entries)))
    return stacked.groupBy("column", "value").agg(F.count("*").alias("n"))


def aggregate_row(df: DataFrame, aggregates: list[Column]) -> Row:
    """The single row of an ungrouped aggregate, brought to the driver.

    Later passes use its numbers as literals, which keeps their plans flat and lets range
    conditions reach the scan.
    """
    return df.agg(*aggregates).first()


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null when there is nothing to share."""
    return F.when(whole > 0, part * 100.0 / whole)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of several frames. Merged in halves, since every union analyses all of its plan."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return stack(frames[:half]).unionByName(stack(frames[half:]))
