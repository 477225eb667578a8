"""The numbers behind charts, small enough to draw whatever the size of the table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearledger.operators.frames import aggregate_row, as_double, col, numeric_columns, percent
from clearledger.operators.joins import beside_groups, has_at_most
from clearledger.operators.profile import value_counts
from clearledger.operators.quantiles import exact_quantiles
from clearledger.sources.tables import stored

# Resampling frequencies, chart defaults.
PERIODS = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
HISTOGRAM_BINS = 30
MAX_DATE_BINS = 50
WHISKER_FACTOR = 1.5
KDE_GRID = 200
KDE_CUT = 3.0
# exp(-z*z/2) is zero in double precision beyond this many bandwidths.
KDE_REACH = 39.0
# Bins of a binned density, as a part of the bandwidth.
KDE_BIN = 0.02
OTHER = "Other"
ONE_TASK_ROWS = 100_000


def _period_start(c: Column, freq: str) -> Column:
    day = c.cast("date")
    return day if freq == "D" else F.trunc(day, PERIODS[freq])


def time_series(
    df: DataFrame, date_column: str, freq: str = "M", value_column: str | None = None
) -> DataFrame:
    """(period, n) or (period, total) per day, week from Monday, month, quarter or year."""
    dated = df.filter(col(date_column).isNotNull())
    grouped = dated.groupBy(_period_start(col(date_column), freq).alias("period"))
    if value_column is None:
        return grouped.agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum(as_double(df, value_column)), F.lit(0.0))
    return grouped.agg(total.alias("total"))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation) for all ordered pairs, complete pairs of values only.

    All pairs come from one aggregate over one scan. Fewer than two columns give no rows;
    names that are absent or not numeric are skipped.
    """
    numbers = numeric_columns(df)
    columns = [c for c in (columns or numbers) if c in numbers]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    if len(columns) < 2:
        schema = "column_a string, column_b string, correlation double"
        return df.sparkSession.createDataFrame([], schema)
    values = df.select(*[as_double(df, c).alias(f"_v{i}") for i, c in enumerate(columns)])
    corrs = values.agg(*[F.corr(f"_v{i}", f"_v{j}").alias(f"_{i}_{j}") for i, j in pairs])
    entries = [
        F.struct(
            F.lit(columns[i]).alias("column_a"),
            F.lit(columns[j]).alias("column_b"),
            F.col(f"_{min(i, j)}_{max(i, j)}").alias("correlation"),
        )
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return corrs.select(F.inline(F.array(*entries)))


def histogram_numeric(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(bin, low, high, n) for equal bins between minimum and maximum, empty bins included."""
    v = as_double(df, column)
    edges = aggregate_row(df, [F.min(v).alias("low"), F.max(v).alias("high")])
    return _histogram(df, v, edges.low, edges.high, bins)


def _histogram(df: DataFrame, v: Column, low: float | None, high: float | None, bins: int) -> DataFrame:
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    position = F.least(F.floor((v - low) / width), F.lit(bins - 1))
    counts = df.filter(v.isNotNull()).groupBy(position.cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return axis.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_dates(df: DataFrame, column: str) -> DataFrame:
    """Histogram of dates in days since 1970-01-01, one bin per started 30 days, at most 50."""
    day = F.unix_date(col(column).cast("date")).cast("double")
    days = df.select(day.alias("day"))
    edges = aggregate_row(days, [F.min("day").alias("low"), F.max("day").alias("high")])
    span = int(edges.high - edges.low) if edges.low is not None else 0
    bins = min(MAX_DATE_BINS, span // 30 + 1)
    return _histogram(days, F.col("day"), edges.low, edges.high, bins)


def boxplot_stats(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers at the most extreme values inside the fences, and values beyond,
    for the whole column or per group."""
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(df, [column], names, [by] if by else None).drop("column")
    value = as_double(df, column).alias("_v")
    if by:
        joined = beside_groups(df.select(col(by), value), quartiles, [by])
    else:
        row = quartiles.first() or dict.fromkeys(names)
        joined = df.select(value).withColumns(
            {name: F.lit(row[name]).cast("double") for name in names}
        )
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("_v") >= F.col("q1") - WHISKER_FACTOR * iqr) & (
        F.col("_v") <= F.col("q3") + WHISKER_FACTOR * iqr
    )
    return joined.groupBy(*([col(by)] if by else []), "q1", "median", "q3").agg(
        F.count("_v").alias("n"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )


def kde_by_category(
    df: DataFrame, column: str, category: str | None = None, grid: int = KDE_GRID
) -> DataFrame:
    """(category, point, x, density): Gaussian kernel density on an even grid reaching three
    bandwidths beyond the data, bandwidth by Scott's rule.

    Equal values are merged first. A value then reaches only the grid points where its kernel
    is not zero in double precision, so the work per value falls as the bandwidth narrows.
    """
    values = _category_values(df, column, category)
    merged = values.groupBy("category", "_v").agg(F.count("*").alias("_n"))
    curves = _curves(values, grid)
    if category:
        curves = stored(curves, "curves")  # also the axis of the result
        near = beside_groups(merged, curves, ["category"])
    else:
        row = curves.first() or dict.fromkeys(curves.columns)
        fields = ("_bw", "_start", "_step")
        near = merged.withColumns({f: F.lit(row[f]).cast("double") for f in fields})
    z = (F.col("_start") + F.col("point") * F.col("_step") - F.col("_v")) / F.col("_bw")
    sums = (
        near.select("category", "_v", "_n", "_bw", "_start", "_step", F.explode(_reached(F.col("_v"), grid)).alias("point"))
        .groupBy("category", "point")
        .agg(F.sum(F.col("_n") * F.exp(-0.5 * z * z)).alias("_sum"))
    )
    return _densities(curves, sums, grid)


def kde_binned(
    df: DataFrame, column: str, category: str | None = None, grid: int = KDE_GRID, bin_width: float = KDE_BIN
) -> DataFrame:
    """(category, point, x, density, error_bound): as ``kde_by_category``, for many distinct values.

    Each value is shared linearly between the two nearest bin borders, ``bin_width`` bandwidths
    apart; the borders' weights are then convolved with the kernel on the grid. A row costs two
    additions, whatever the bandwidth, and borders are bounded by the data's range in bandwidths.
    Linear interpolation of the kernel K of bandwidth h errs by at most bin ** 2 / 8 * max |K''|, so
    the density is within ``error_bound`` = bin_width ** 2 / (8 h sqrt(2 pi)) of the exact one.
    """
    values = _category_values(df, column, category)
    curves = stored(_curves(values, grid), "curves")  # one row a category
    bin_ = F.col("_bw") * bin_width
    place = (F.col("_v") - F.col("_min")) / bin_
    low = F.floor(place)
    shares = F.array(
        F.struct(low.alias("border"), (1 - (place - low)).alias("weight")),
        F.struct((low + 1).alias("border"), (place - low).alias("weight")),
    )
    weights = stored(
        beside_groups(values, curves, ["category"])
        .select("category", F.inline(shares))
        .groupBy("category", "border")
        .agg(F.sum("weight").alias("weight")),
        "borders",
    )
    near = beside_groups(weights, curves, ["category"])
    near = near.withColumn("_at", F.col("_min") + F.col("border") * bin_)
    z = (F.col("_start") + F.col("point") * F.col("_step") - F.col("_at")) / F.col("_bw")
    sums = (
        near.withColumn("point", F.explode(_reached(F.col("_at"), grid)))
        .groupBy("category", "point")
        .agg(F.sum(F.col("weight") * F.exp(-0.5 * z * z)).alias("_sum"))
    )
    bound = bin_width**2 / 8 / (F.col("_bw") * math.sqrt(2 * math.pi))
    return _densities(curves, sums, grid, bound.alias("error_bound"))


def _category_values(df: DataFrame, column: str, category: str | None) -> DataFrame:
    """(category, _v) where neither is missing.

    Both pass through a generator of one row: the filters on missing values would be pushed below the
    projections that make them, and each text read into a number several times."""
    name = col(category) if category else F.lit("all")
    given = df.select(F.inline(F.array(F.struct(name.alias("category"), col(column).alias("_given")))))
    values = given.select("category", as_double(given, "_given").alias("_v"))
    return values.filter("category IS NOT NULL AND _v IS NOT NULL")


def _curves(values: DataFrame, grid: int) -> DataFrame:
    """Bandwidth by Scott's rule and even axis of each category's curve."""
    spread = values.groupBy("category").agg(
        F.count("*").alias("_total"),
        F.stddev_samp("_v").alias("_std"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    return (
        spread.filter("_total > 1 AND _std > 0")
        .withColumn("_bw", F.col("_std") * F.pow(F.col("_total").cast("double"), F.lit(-0.2)))
        .withColumn("_start", F.col("_min") - KDE_CUT * F.col("_bw"))
        .withColumn("_end", F.col("_max") + KDE_CUT * F.col("_bw"))
        .withColumn("_step", (F.col("_end") - F.col("_start")) / (grid - 1))
    )


def _reached(v: Column, grid: int) -> Column:
    """The grid points where the kernel of a value is not zero in double precision."""
    reach = KDE_REACH * F.col("_bw")
    first = F.ceil((v - reach - F.col("_start")) / F.col("_step"))
    last = F.floor((v + reach - F.col("_start")) / F.col("_step"))
    return F.sequence(
        F.greatest(first, F.lit(0).cast("bigint")), F.least(last, F.lit(grid - 1).cast("bigint"))
    )


def _densities(curves: DataFrame, sums: DataFrame, grid: int, *more: Column) -> DataFrame:
    """(category, point, x, density, ...) on the whole axis, from sums of kernels at some points."""
    axis = curves.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))))
    scale = F.col("_total") * F.col("_bw") * math.sqrt(2 * math.pi)
    return axis.join(sums, ["category", "point"], "left").select(
        "category",
        "point",
        (F.col("_start") + F.col("point") * F.col("_step")).alias("x"),
        (F.coalesce("_sum", F.lit(0.0)) / scale).alias("density"),
        *more,
    )


def category_shares(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """(category, n, share) of the most frequent values; the rest is one 'Other' row."""
    counts = value_counts(df, column).select(F.col("value").cast("string").alias("category"), "n")
    total = counts.agg(F.sum("n").alias("n"))
    shown = counts
    if top_n is not None:
        top = counts.orderBy(F.desc("n"), F.asc("category")).limit(top_n)
        rest = total.select(
            F.lit(OTHER).alias("category"),
            (F.col("n") - top.agg(F.sum("n")).scalar()).alias("n"),
        )
        shown = top.unionByName(rest.filter("n > 0"))
    return shown.select("category", "n", percent(F.col("n"), total.scalar()).alias("share"))


def category_codes(df: DataFrame, column: str, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """(category, code): position of each distinct value in sort order, from zero.

    Few categories are numbered in one task. More are stored in range partitions, each with its
    number, and numbered inside each partition, offset by the sizes of the partitions before it;
    stored rows keep their partition if a task runs again.
    """
    categories = df.filter(col(column).isNotNull()).select(col(column).alias("category")).distinct()
    if has_at_most(categories, one_task_rows):
        code = F.row_number().over(W.orderBy("category")) - 1
        return categories.select("category", code.cast("bigint").alias("code"))
    numbered = categories.repartitionByRange(F.col("category")).withColumn("_part", F.spark_partition_id())
    ranged = stored(numbered, "categories")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per shuffle partition.
    offsets = sizes.select(
        "_part", (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_offset")
    )
    inside = F.row_number().over(W.partitionBy("_part").orderBy("category"))
    return ranged.join(F.broadcast(offsets), "_part").select(
        "category", (F.col("_offset") + inside - 1).cast("bigint").alias("code")
    )


def scatter_points(
    df: DataFrame,
    x: str,
    y: str,
    color_by: str | None = None,
    fraction: float | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """(x, y) points with the code of their category, -1 for none; optionally a sample."""
    points = df.sample(fraction, seed=42) if fraction else df
    if color_by is None:
        return points.select(col(x).alias("x"), col(y).alias("y"))
    codes = category_codes(df, color_by, one_task_rows)
    if has_at_most(codes, one_task_rows):
        codes = F.broadcast(codes)
    picked = points.select(col(x).alias("x"), col(y).alias("y"), col(color_by).alias("category"))
    return picked.join(codes, "category", "left").select(
        "x", "y", "category", F.coalesce("code", F.lit(-1).cast("bigint")).alias("code")
    )
