"""Descriptive profile of any frame: one row per column and kind of column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearledger.operators.frames import (
    as_double,
    as_text,
    categorical_columns,
    col,
    date_columns,
    numeric_columns,
    percent,
    present_value,
    value_counts_long,
)
from clearledger.operators.quantiles import Sketch, approximate_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def profile_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Rows, missing and distinct values per column.

    Exact distinct counts share one shuffle of (column, value) pairs for all columns; ``approx``
    needs none of it.
    """
    columns = columns or df.columns
    if approx:
        totals = df.agg(
            F.count("*").alias("_rows"),
            *[F.count(present_value(df, c)).alias(f"_p{i}") for i, c in enumerate(columns)],
            *[
                F.approx_count_distinct(as_text(df, c)).alias(f"_d{i}")
                for i, c in enumerate(columns)
            ],
        )
        entries = [
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("count"),
                (F.col("_rows") - F.col(f"_p{i}")).alias("missing"),
                F.col(f"_d{i}").alias("unique_values"),
            )
            for i, c in enumerate(columns)
        ]
        per_column = totals.select(F.inline(F.array(*entries)))
    else:
        per_column = (
            value_counts_long(df, columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("count"),
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
                F.count("value").alias("unique_values"),
            )
        )
    kinds = F.create_map(
        *[x for c in columns for x in (F.lit(c), F.lit(df.schema[c].dataType.simpleString()))]
    )
    return per_column.select(
        "column",
        kinds[F.col("column")].alias("data_type"),
        "count",
        "missing",
        percent(F.col("missing"), F.col("count")).alias("missing_percentage"),
        "unique_values",
        percent(F.col("unique_values"), F.col("count")).alias("unique_percentage"),
        (F.col("missing") == F.col("count")).alias("all_missing"),
    )


def total_missing(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table, in one pass."""
    missing = [F.count("*") - F.count(present_value(df, c)) for c in df.columns]
    return df.agg(sum(missing[1:], missing[0]).alias("missing_cells"))


def _moment_stats(columns: list[str], value) -> list[Column]:
    """Aggregates of each column, whose number is given by ``value``."""
    stats = []
    for i in range(len(columns)):
        v = value(i)
        stats += [
            F.count(v).alias(f"_n{i}"),
            F.min(v).alias(f"_min{i}"),
            F.max(v).alias(f"_max{i}"),
            F.avg(v).alias(f"_avg{i}"),
            F.stddev_samp(v).alias(f"_std{i}"),
            F.skewness(v).alias(f"_skew{i}"),
        ]
    return stats


def _moment_rows(stats: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, min, max, mean, std, skew) from the one row of aggregates; skewness is
    corrected for sample size."""
    entries = []
    for i, c in enumerate(columns):
        n = F.col(f"_n{i}").cast("double")
        corrected = F.col(f"_skew{i}") * F.sqrt(n * (n - 1)) / (n - 2)
        constant = F.col(f"_min{i}") == F.col(f"_max{i}")
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_n{i}").alias("n"),
                F.col(f"_min{i}").alias("min"),
                F.col(f"_max{i}").alias("max"),
                F.col(f"_avg{i}").alias("mean"),
                F.col(f"_std{i}").alias("std"),
                F.when(n >= 3, F.when(constant, 0.0).otherwise(corrected)).alias("skew"),
            )
        )
    return stats.select(F.inline(F.array(*entries)))


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, min, max, mean, std, skew) of numeric columns in one pass without shuffle
    of values."""
    stats = _moment_stats(columns, lambda i: as_double(df, columns[i]))
    return _moment_rows(df.agg(*stats), columns)


def profile_numeric(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Minimum, maximum, mean, quartiles, deviation and skewness of numeric columns.

    Exact quartiles take two passes; the moments ride along in the first."""
    columns = columns or numeric_columns(df)
    if approx:
        found, quartiles = moments(df, columns), approximate_quantiles(df, columns, QUARTILES)
    else:
        beside = _moment_stats(columns, lambda i: F.col(f"_v{i}"))
        sketch = Sketch(df, columns, QUARTILES, beside=beside)
        found, quartiles = _moment_rows(sketch.summary, columns), sketch.exact()
    # One row per column on both sides.
    return (
        found.filter("n > 0")
        .join(F.broadcast(quartiles), "column")
        .select("column", "n", "min", "max", "mean", "median", "std", "skew", "q1", "q3")
    )


def top_values(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent present values per column; equal counts go by value.

    A rank limit on row_number is applied inside the map tasks before the shuffle.
    """
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return (
        counts.filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def profile_categorical(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """Most frequent values per column with rank and share of all rows; rank 1 is the mode."""
    columns = columns or categorical_columns(df)
    # Missing values are counted too, so the counts hold the number of rows.
    counts = value_counts_long(df, columns)
    rows = counts.groupBy("column").agg(F.sum("n").alias("rows"))
    top = top_values(counts, k).join(F.broadcast(rows), "column")  # a row for each column
    return top.select(
        "column", "rank", "value", "n", percent(F.col("n"), F.col("rows")).alias("percentage")
    )


def profile_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """First and last date of each date column and the whole days between them."""
    columns = columns or date_columns(df)
    stats = []
    for i, c in enumerate(columns):
        stats += [F.min(col(c)).alias(f"_min{i}"), F.max(col(c)).alias(f"_max{i}")]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_min{i}").cast("timestamp_ntz").alias("min_date"),
            F.col(f"_max{i}").cast("timestamp_ntz").alias("max_date"),
            F.timestamp_diff("DAY", F.col(f"_min{i}"), F.col(f"_max{i}")).alias("range_days"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*stats).select(F.inline(F.array(*entries)))


def date_distribution(df: DataFrame, column: str, as_of: str | None = None) -> DataFrame:
    """One row: missing and future dates, range, and mean, median, quartiles and deviation in
    days since 1970-01-01. A date is in the future from tomorrow on: a time later today is not,
    as with the declared check that dates are past.

    Rows are first counted per day inside the map tasks. The calendar bounds the number of
    days, so the exact quartiles of the day counts fit in one task at any size of the table.
    """
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    per_day = df.groupBy(col(column).cast("date").alias("_date")).agg(F.count("*").alias("_n"))
    day, n = F.unix_date("_date"), F.col("_n")
    present = F.sum(F.when(F.col("_date").isNotNull(), n))
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    totals = per_day.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_date").isNull(), n)), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("_date") > today, n)), F.lit(0)).alias("future_dates"),
        F.min("_date").alias("min_date"),
        F.max("_date").alias("max_date"),
        F.datediff(F.max("_date"), F.min("_date")).alias("range_days"),
        present.cast("double").alias("_present"),
        exact(n * day).cast("double").alias("_sum"),
        exact(n.cast("decimal(20,0)") * day * day).cast("double").alias("_squares"),
        F.percentile(day, list(QUARTILES.values()), n).alias("_q"),
    )
    spread = F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("_present")
    quartile = lambda i: F.col("_q")[i]
    return totals.select(
        "rows",
        "missing",
        "future_dates",
        "min_date",
        "max_date",
        "range_days",
        F.when(F.col("_present") > 0, F.col("_sum") / F.col("_present")).alias("mean_days"),
        F.when(F.col("_present") > 1, F.sqrt(spread / (F.col("_present") - 1))).alias("std_days"),
        quartile(0).alias("q1_days"),
        quartile(1).alias("median_days"),
        quartile(2).alias("q3_days"),
        (quartile(2) - quartile(0)).alias("iqr_days"),
    )


def future_date_examples(
    df: DataFrame, column: str, as_of: str | None = None, k: int = 5
) -> DataFrame:
    """The k latest dates after today."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    dates = df.select(col(column).alias("date")).filter(F.col("date").cast("date") > today)
    return dates.orderBy(F.desc("date")).limit(k)


def date_year_month_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per year and rows per month of the year, in one frame."""
    dates = df.filter(col(column).isNotNull()).select(
        F.inline(
            F.array(
                F.struct(F.lit("year").alias("part"), F.year(col(column)).alias("value")),
                F.struct(F.lit("month").alias("part"), F.month(col(column)).alias("value")),
            )
        )
    )
    return dates.groupBy("part", "value").agg(F.count("*").alias("n"))


def grouped_stats(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Count, mean, median and deviation of a number per group, in two passes."""
    beside = [
        F.count("_v0").alias("count"), F.avg("_v0").alias("mean"), F.stddev_samp("_v0").alias("std")
    ]
    sketch = Sketch(df, [column], {"median": 0.5}, by, beside=beside)
    medians = sketch.exact().drop("column")
    stats = sketch.summary.select(*[col(b) for b in by], "count", "mean", "std")
    return stats.join(medians, by, "left").select(*[col(b) for b in by], "count", "mean", "median", "std")


def group_size_stats(df: DataFrame, by: list[str]) -> DataFrame:
    """Distribution of group sizes: number of groups, mean, deviation, extremes, quartiles.

    Sizes are counted before their quartiles are taken: n rows cannot make more than about
    sqrt(2n) different group sizes, so the counts fit in one task.
    """
    rows = df
    for b in by:
        rows = rows.filter(col(b).isNotNull())
    sizes = rows.groupBy(*[col(b) for b in by]).agg(F.count("*").alias("size"))
    per_size = sizes.groupBy("size").agg(F.count("*").alias("_n"))
    size, n = F.col("size"), F.col("_n")
    exact = lambda c: F.sum(c.cast("decimal(38,0)")).cast("double")
    totals = per_size.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("groups"),
        exact(n * size).alias("_sum"),
        exact(n.cast("decimal(20,0)") * size * size).alias("_squares"),
        F.min("size").alias("min"),
        F.max("size").alias("max"),
        F.percentile(size, list(QUARTILES.values()), n).alias("_q"),
    )
    groups = F.col("groups").cast("double")
    spread = F.col("_squares") - F.col("_sum") * F.col("_sum") / groups
    return totals.select(
        "groups",
        F.when(groups > 0, F.col("_sum") / groups).alias("mean"),
        F.when(groups > 1, F.sqrt(spread / (groups - 1))).alias("std"),
        "min",
        "max",
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"),
    )


def value_counts(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """Present values of one column with their number of rows, optionally the top N."""
    counts = (
        df.filter(present_value(df, column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return counts.orderBy(F.desc("n"), F.asc("value")).limit(top_n) if top_n else counts
