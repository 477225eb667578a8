"""Correlations of many columns from one pass: sums of products by matrix multiplication.

Pairwise-complete correlation needs, for each pair of columns, six sums over the rows where both
are present. Written as expressions these are too many for a plan from some tens of columns on.
Here each task turns its rows into matrices, multiplies them, and gives one row a pair; the
pairs' sums add up. Values are centred by a rough mean first, so that little precision is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.operators.frames import as_double, numeric_columns

#: Rows whose mean centres the values; any number near the values serves.
CENTRE_ROWS = 1_000
SUMS = ("n", "x", "y", "xx", "yy", "xy")
SCHEMA = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS)


def co_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, x, y, xx, yy, xy): for column numbers a <= b the sums of both centred columns over
    the rows where both are present and finite. One scan of the columns, pairs' sums per task."""
    doubles = df.select(*[as_double(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    finite = [F.avg(F.when(F.abs(f"c{i}") < float("inf"), F.col(f"c{i}"))) for i in range(len(columns))]
    centre = np.array([x or 0.0 for x in doubles.limit(CENTRE_ROWS).agg(*finite).first()])
    first, second = np.triu_indices(len(columns))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, x, xx, xy = (np.zeros((len(columns), len(columns))) for _ in range(4))
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            there = np.isfinite(values)
            values[~there] = 0
            mask = there.astype(float)
            n += mask.T @ mask
            x += values.T @ mask  # [a, b]: a's values where b is present
            xx += (values * values).T @ mask
            xy += values.T @ values
        i, j = first, second
        sums = (n[i, j], x[i, j], x[j, i], xx[i, j], xx[j, i], xy[i, j])
        arrays = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", *SUMS])

    return doubles.mapInArrow(made, SCHEMA).groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation, n) for all ordered pairs of numeric columns, complete pairs
    of values only. Null where fewer than two pairs are complete or a column does not vary in them;
    no rows for fewer than two columns. Infinite values count as missing."""
    columns = columns or numeric_columns(df)
    spark = df.sparkSession
    if len(columns) < 2:
        return spark.createDataFrame([], "column_a string, column_b string, correlation double, n bigint")
    sums = co_moments(df, columns)
    n = F.col("n")
    vary = lambda sq, s: F.col(sq) - F.col(s) * F.col(s) / n
    both = F.col("xy") - F.col("x") * F.col("y") / n
    # what rounding leaves of a constant column is not variance
    least = lambda sq: F.col(sq) * 1e-12
    known = (n > 1) & (vary("xx", "x") > least("xx")) & (vary("yy", "y") > least("yy"))
    value = F.when(known, both / F.sqrt(vary("xx", "x") * vary("yy", "y")))
    pairs = sums.select("a", "b", value.alias("correlation"), n.cast("bigint").alias("n"))
    turned = pairs.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation", "n")
    names = F.array(*map(F.lit, columns))
    name = lambda c: F.element_at(names, (F.col(c) + 1).cast("int"))
    size = len(columns)
    every = spark.range(size * size).select(F.floor(F.col("id") / size).alias("a"), (F.col("id") % size).alias("b"))
    # one row a pair of columns on both sides
    told = every.join(F.broadcast(pairs.union(turned)), ["a", "b"], "left")
    return told.select(
        name("a").alias("column_a"), name("b").alias("column_b"), "correlation", F.coalesce("n", F.lit(0)).alias("n")
    )
