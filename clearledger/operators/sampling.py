"""Samples of values and rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearledger.operators.frames import value_counts_long

SEED = 42
SAMPLES = 5


def column_samples(
    df: DataFrame,
    n_samples: int = SAMPLES,
    dtype_filter: str | list[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(column, value): all distinct values of a column when there are few, else ``n_samples``
    of them in an order given by a seeded hash, so that a rerun picks the same ones."""
    if isinstance(dtype_filter, str):
        dtype_filter = [dtype_filter]
    columns = [
        f.name
        for f in df.schema.fields
        if dtype_filter is None or f.dataType.simpleString() in dtype_filter
    ]
    shuffled = W.partitionBy("column").orderBy(
        F.md5(F.concat(F.lit(f"{seed}:"), F.col("value"))), "value"
    )
    return (
        value_counts_long(df, columns)
        .filter(F.col("value").isNotNull())
        .select("column", "value", F.row_number().over(shuffled).alias("_rank"))
        .filter(F.col("_rank") <= n_samples)
        .drop("_rank")
    )


def rows_with_total(
    df: DataFrame, columns: list[str], limit: int = 100, order_by: list[str] | None = None
) -> DataFrame:
    """The first rows with the row count of the whole table on each.

    The count is a scalar subquery, since a window over everything would run in one task.
    """
    total = df.agg(F.count("*").alias("n")).scalar()
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(limit).select(*columns, total.alias("total_rows"))
