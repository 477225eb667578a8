"""Outliers: interquartile fences, z-scores, rare categories, and dates far from the median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.operators.frames import (
    aggregate_row,
    as_double,
    categorical_columns,
    col,
    date_columns,
    numeric_columns,
    percent,
    value_counts_long,
)
from clearledger.operators.profile import top_values
from clearledger.operators.quantiles import exact_quantiles
from clearledger.sources.tables import stored

IQR_FACTOR = 1.5
Z_LIMIT = 3.0
RARE_SHARE = 0.01
MODIFIED_Z_LIMIT = 3.5
# Fixed value: makes the median absolute deviation comparable to a standard deviation.
MODIFIED_Z_SCALE = 0.6745
BOUND_FIELDS = ("q1", "q3", "iqr", "lower_bound", "upper_bound")
LISTED_VALUES = 10
LISTED_DATES = 5
SECONDS_A_DAY = 86_400


def iqr_bounds(df: DataFrame, columns: list[str], factor: float = IQR_FACTOR) -> DataFrame:
    """(column, q1, q3, iqr, lower_bound, upper_bound), one row per column."""
    quartiles = exact_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return quartiles.select(
        "column",
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - factor * iqr).alias("lower_bound"),
        (F.col("q3") + factor * iqr).alias("upper_bound"),
    )


def _outside(df: DataFrame, bounds: dict[str, Row], column: str) -> Column:
    """Whether a number lies beyond the fences; false for a column without numbers."""
    if column not in bounds:
        return F.lit(False)
    fences = bounds[column]
    value = as_double(df, column)
    return (value < fences.lower_bound) | (value > fences.upper_bound)


def _by_column(frame: DataFrame) -> dict[str, Row]:
    """A report with one row per column of the input, brought to the driver."""
    return {row["column"]: row for row in frame.collect()}


def outliers_iqr(
    df: DataFrame, columns: list[str] | None = None, factor: float = IQR_FACTOR
) -> DataFrame:
    """Values outside the fences per column, with their share of all rows."""
    columns = columns or numeric_columns(df)
    bounds = _by_column(iqr_bounds(df, columns, factor))
    counts = [F.count_if(_outside(df, bounds, c)).alias(f"_o{i}") for i, c in enumerate(columns)]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(bounds[c][f]).alias(f) for f in BOUND_FIELDS],
            F.col(f"_o{i}").alias("outliers_count"),
            percent(F.col(f"_o{i}"), F.col("_rows")).alias("outliers_percentage"),
        )
        for i, c in enumerate(columns)
        if c in bounds
    ]
    return df.agg(F.count("*").alias("_rows"), *counts).select(F.inline(F.array(*entries)))


def iqr_outlier_values(
    df: DataFrame,
    columns: list[str] | None = None,
    factor: float = IQR_FACTOR,
    listed: int = LISTED_VALUES,
) -> DataFrame:
    """Most frequent outlying values per column; ``listed`` is how many the report shows."""
    columns = columns or numeric_columns(df)
    bounds = _by_column(iqr_bounds(df, columns, factor))
    outlying = df.select(
        *[F.when(_outside(df, bounds, c), as_double(df, c)).alias(c) for c in columns]
    )
    return top_values(value_counts_long(outlying, columns), listed).select(
        "column", "rank", F.col("value").cast("double").alias("value"), "n"
    )


def outliers_zscore(
    df: DataFrame, columns: list[str] | None = None, limit: float = Z_LIMIT
) -> DataFrame:
    """Values more than ``limit`` population deviations from the mean, share of all rows."""
    columns = columns or numeric_columns(df)
    stats = []
    for i, c in enumerate(columns):
        v = as_double(df, c)
        stats += [F.avg(v).alias(f"mean{i}"), F.stddev_pop(v).alias(f"std{i}")]
    row = aggregate_row(df, stats)
    counts = []
    for i, c in enumerate(columns):
        deviation = F.abs(as_double(df, c) - F.lit(row[f"mean{i}"]))
        # Compared without dividing, so that a constant column has no outliers.
        counts.append(F.count_if(deviation > limit * F.lit(row[f"std{i}"])).alias(f"_z{i}"))
    totals = df.agg(F.count("*").alias("_rows"), *counts)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_z{i}").alias("z_score_outliers_count"),
            percent(F.col(f"_z{i}"), F.col("_rows")).alias("z_score_outliers_percentage"),
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*entries)))


def rare_categories(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Categories whose share of the present values is below 1 % or 1/categories, whichever is
    higher. A column with a single category has none."""
    columns = columns or categorical_columns(df)
    counts = value_counts_long(df, columns).filter(F.col("value").isNotNull())
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("_present"), F.count("*").alias("_categories")
    )
    # One row per column of the input.
    share = F.col("n") / F.col("_present")
    threshold = F.greatest(F.lit(RARE_SHARE), F.lit(1.0) / F.col("_categories"))
    return (
        counts.join(F.broadcast(totals), "column")
        .filter((F.col("_categories") > 1) & (share < threshold))
        .select("column", "value", "n", (share * 100).alias("percentage"))
    )


def rare_category_summary(
    df: DataFrame, columns: list[str] | None = None, listed: int = LISTED_VALUES
) -> DataFrame:
    """Number of rare categories per column and whether the report would list them."""
    rare = rare_categories(df, columns)
    return rare.groupBy("column").agg(
        F.count("*").alias("rare_categories_count"),
        (F.count("*") <= listed).alias("listed"),
    )


def outliers_mad_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Dates whose modified z-score exceeds the limit, share of the present dates.

    Measured on whole seconds. A column whose median absolute deviation is zero gets no verdict.
    Dates without a time are counted per day in one pass, and the calendar bounds the days.
    """
    columns = columns or date_columns(df)
    if columns and all(isinstance(df.schema[c].dataType, T.DateType) for c in columns):
        return _outlying_days(df, columns)
    medians, mads = _medians_and_deviations(df, columns)
    judged = [c for c in columns if c in medians]
    counts = []
    for i, c in enumerate(judged):
        far = _far(_seconds(c), medians[c].median, mads[c].mad)
        counts += [F.count(col(c)).alias(f"_n{i}"), F.count_if(far).alias(f"_o{i}")]
    entries = []
    for i, c in enumerate(judged):
        count = F.when(F.lit(mads[c].mad > 0), F.col(f"_o{i}"))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_n{i}").alias("non_null"),
                F.lit(medians[c].median).alias("median_seconds"),
                F.lit(mads[c].mad).alias("mad_seconds"),
                count.alias("datetime_outliers_count"),
                percent(count, F.col(f"_n{i}")).alias("datetime_outliers_percentage"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def _outlying_days(df: DataFrame, columns: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), col(c).alias("_date")) for c in columns]
    days = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("_date").isNotNull())
        .groupBy("column", "_date")
        .agg(F.count("*").alias("_n"))
    )
    days = stored(days, "days").withColumn("_s", F.unix_date("_date").cast("double") * SECONDS_A_DAY)
    # One row per column on the broadcast sides.
    medians = days.groupBy("column").agg(F.percentile("_s", 0.5, F.col("_n")).alias("_median"))
    apart = days.join(F.broadcast(medians), "column").withColumn("_apart", F.abs(F.col("_s") - F.col("_median")))
    mads = apart.groupBy("column").agg(F.percentile("_apart", 0.5, F.col("_n")).alias("_mad"))
    far = MODIFIED_Z_SCALE * F.col("_apart") > MODIFIED_Z_LIMIT * F.col("_mad")
    report = (
        apart.join(F.broadcast(mads), "column")
        .groupBy("column")
        .agg(
            F.sum("_n").alias("non_null"),
            F.max("_median").alias("median_seconds"),
            F.max("_mad").alias("mad_seconds"),
            F.coalesce(F.sum(F.when(far, F.col("_n"))), F.lit(0)).alias("_far"),
        )
    )
    count = F.when(F.col("mad_seconds") > 0, F.col("_far"))
    return report.select(
        "column",
        "non_null",
        "median_seconds",
        "mad_seconds",
        count.alias("datetime_outliers_count"),
        percent(count, F.col("non_null")).alias("datetime_outliers_percentage"),
    )


def mad_outlier_dates(df: DataFrame, column: str, listed: int = LISTED_DATES) -> DataFrame:
    """The outlying dates farthest from the median; ``listed`` is how many the report shows."""
    medians, mads = _medians_and_deviations(df, [column])
    if column not in medians or mads[column].mad == 0:
        far, distance = F.lit(False), F.lit(0.0)
    else:
        distance = F.abs(_seconds(column) - medians[column].median)
        far = _far(_seconds(column), medians[column].median, mads[column].mad)
    return (
        df.filter(far)
        .select(col(column).alias("date"), distance.alias("seconds_from_median"))
        .orderBy(F.desc("seconds_from_median"), "date")
        .limit(listed)
    )


def _seconds(column: str) -> Column:
    """Whole seconds since 1970-01-01."""
    micros = F.unix_micros(col(column).cast("timestamp"))
    return F.floor(micros / 1_000_000).cast("double")


def _medians_and_deviations(
    df: DataFrame, columns: list[str]
) -> tuple[dict[str, Row], dict[str, Row]]:
    """Median and median absolute deviation in seconds, by column."""
    epochs = df.select(*[_seconds(c).alias(c) for c in columns])
    medians = _by_column(exact_quantiles(epochs, columns, {"median": 0.5}))
    present = [c for c in columns if c in medians]
    if not present:
        return medians, {}
    distances = epochs.select(*[F.abs(col(c) - medians[c].median).alias(c) for c in present])
    return medians, _by_column(exact_quantiles(distances, present, {"mad": 0.5}))


def _far(seconds: Column, median: float, mad: float) -> Column:
    return MODIFIED_Z_SCALE * F.abs(seconds - median) > F.lit(MODIFIED_Z_LIMIT * mad)
