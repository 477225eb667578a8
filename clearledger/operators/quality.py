"""What needs cleaning, cleaning it, and what the cleaning changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearledger.functions import (
    date_shape,
    detect_date_format,
    email_domain,
    email_error,
    email_is_valid,
    has_date_shape,
    has_outer_whitespace,
    looks_like_date,
    looks_like_german_number,
    parse_date_mixed,
    parse_number_mixed,
    strip_whitespace,
    whitespace_issue,
)
from clearledger.functions.dates import UNRECOGNIZED, stripped_date_shape
from clearledger.operators.frames import col, percent, string_columns
from clearledger.operators.sampling import SAMPLES, column_samples

NUMERIC, DATE, WHITESPACE = "numeric", "date", "whitespace"
MAJORITY = 0.5
WHITESPACE_EXAMPLES = 5
EMAIL_EXAMPLES = 10
COMMON_DOMAINS = 10
CHANGE_EXAMPLES = 3


def _detection(df: DataFrame, columns: list[str], is_date) -> DataFrame:
    """(column, kind, matching, non_null, ratio, recommended) over the full columns, from one
    aggregate without a shuffle of values."""
    tests = (
        (NUMERIC, looks_like_german_number),
        (DATE, is_date),
        (WHITESPACE, has_outer_whitespace),
    )
    counts = []
    for i, c in enumerate(columns):
        counts.append(F.count(col(c)).alias(f"_n{i}"))
        counts += [F.count_if(test(col(c))).alias(f"_{kind}{i}") for kind, test in tests]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("kind"),
            F.col(f"_{kind}{i}").alias("matching"),
            F.col(f"_n{i}").alias("non_null"),
        )
        for i, c in enumerate(columns)
        for kind, _ in tests
    ]
    found = df.agg(*counts).select(F.inline(F.array(*entries))).filter("non_null > 0")
    ratio = F.col("matching") / F.col("non_null")
    enough = F.when(F.col("kind") == WHITESPACE, ratio > 0).otherwise(ratio > MAJORITY)
    return found.select("*", ratio.alias("ratio"), enough.alias("recommended"))


def quality_recommendations(df: DataFrame) -> DataFrame:
    """Which text columns look like numbers, dates (in any of eight shapes) or carry outer
    white space."""
    return _detection(df, string_columns(df), has_date_shape)


def detect_cleaning(df: DataFrame) -> dict[str, list[str]]:
    """Columns per kind of cleaning, as the table cleaner decides."""
    report = _detection(df, string_columns(df), looks_like_date).filter("recommended")
    rows = report.collect()  # three rows per column at most
    return {
        kind: [r["column"] for r in rows if r.kind == kind]
        for kind in (NUMERIC, DATE, WHITESPACE)
    }


def date_columns_of(df: DataFrame) -> list[str]:
    """Text columns recommended for date conversion."""
    rows = quality_recommendations(df).filter((F.col("kind") == DATE) & F.col("recommended"))
    return [r["column"] for r in rows.select("column").collect()]


def _shape_counts(df: DataFrame, columns: list[str], anchored: bool) -> DataFrame:
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"`{c}`").isNotNull().alias("_present"),
            date_shape(col(c), anchored).alias("format"),
        )
        for c in columns
    ]
    shaped = df.select(F.inline(F.array(*entries))).filter("_present")
    return shaped.groupBy("column", "format").agg(F.count("*").alias("n"))


def date_format_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, format, n) for the shapes found anywhere in the text of date columns."""
    columns = columns or date_columns_of(df)
    return _shape_counts(df, columns, anchored=False).filter(F.col("format").isNotNull())


def date_format_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, format, n, total_non_null): the whole stripped text against eight shapes, for the
    texts that hold one of them anywhere.

    Without columns those recommended for date conversion are reported: one scan counts every
    text column by shape and by whether a date is found anywhere in it, which decides both."""
    entries = [
        F.struct(F.lit(c).alias("column"), col(c).alias("_raw")) for c in columns or string_columns(df)
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, format string, n bigint, total_non_null bigint")
    texts = df.select(F.inline(F.array(*entries))).filter("_raw IS NOT NULL")
    # one joint pattern decides for most values, and only the others are stripped; behind the
    # generators neither is evaluated again
    judged_once = F.struct(has_date_shape(F.col("_raw")).alias("_dated"), "_raw")
    stripped_once = F.struct("_dated", F.when(F.col("_dated"), strip_whitespace(F.col("_raw"))).alias("_text"))
    dated = texts.select("column", F.inline(F.array(judged_once)))
    shaped = dated.select("column", F.inline(F.array(stripped_once))).select(
        "column",
        F.when(F.col("_dated"), stripped_date_shape(F.col("_text"))).alias("format"),
        (F.lit(True) if columns else F.col("_dated")).alias("_dated"),
    )
    counts = shaped.groupBy("column", "format", "_dated").agg(F.count("*").alias("n"))
    # At most eighteen rows per column by now.
    column = W.partitionBy("column")
    judged = counts.withColumn("total_non_null", F.sum("n").over(column)).withColumn(
        "_dates", F.sum(F.when(F.col("_dated"), F.col("n")).otherwise(0)).over(column)
    )
    chosen = judged.filter(F.col("_dates") / F.col("total_non_null") > (0 if columns else MAJORITY))
    return chosen.groupBy(
        "column", F.coalesce("format", F.lit(UNRECOGNIZED)).alias("format"), "total_non_null"
    ).agg(F.sum("n").alias("n")).select("column", "format", "n", "total_non_null")


def whitespace_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Leading, trailing and two-sided white space per text column that has any."""
    columns = columns or string_columns(df)
    counts = []
    for i, c in enumerate(columns):
        issue = whitespace_issue(col(c))
        counts.append(F.count(col(c)).alias(f"_n{i}"))
        counts += [
            F.count_if(issue == kind).alias(f"_{kind}{i}")
            for kind in ("leading", "trailing", "both")
        ]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("total_values"),
            F.col(f"_n{i}").alias("non_null_values"),
            F.col(f"_leading{i}").alias("leading_whitespace_count"),
            F.col(f"_trailing{i}").alias("trailing_whitespace_count"),
            F.col(f"_both{i}").alias("both_sides_whitespace_count"),
            (F.col(f"_leading{i}") + F.col(f"_trailing{i}") + F.col(f"_both{i}")).alias(
                "total_whitespace_issues"
            ),
        )
        for i, c in enumerate(columns)
    ]
    report = df.agg(F.count("*").alias("_rows"), *counts).select(F.inline(F.array(*entries)))
    share = percent(F.col("total_whitespace_issues"), F.col("non_null_values"))
    return report.filter("total_whitespace_issues > 0").withColumn("whitespace_percentage", share)


def _first_values(values: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows per group; the limit is applied inside the map tasks already."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return values.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def whitespace_examples(
    df: DataFrame, columns: list[str] | None = None, k: int = WHITESPACE_EXAMPLES
) -> DataFrame:
    """A few distinct values with white space per column: as given, stripped, and the issue."""
    columns = columns or string_columns(df)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            col(c).alias("original"),
            whitespace_issue(col(c)).alias("issue"),
        )
        for c in columns
    ]
    found = df.select(F.inline(F.array(*entries))).filter(F.col("issue").isNotNull()).distinct()
    return _first_values(found, ["column"], ["original"], k).select(
        "column", "original", strip_whitespace(F.col("original")).alias("stripped"), "issue"
    )


def with_email_verdict(df: DataFrame, column: str) -> DataFrame:
    """The frame with ``<column>_is_valid``, null where no address is given."""
    return df.withColumn(f"{column}_is_valid", email_is_valid(col(column)))


def email_report(df: DataFrame, column: str) -> DataFrame:
    """One row: addresses in total, missing, valid and invalid, and distinct domains."""
    if column not in df.columns:
        raise ValueError(f"Column '{column}' not found in DataFrame")
    address = col(column)
    valid = email_is_valid(address)
    # Merged by domain first, so the distinct count moves one row per domain.
    per_domain = df.groupBy(F.when(valid, email_domain(address)).alias("_domain")).agg(
        F.count("*").alias("_rows"),
        F.count_if(address.isNull()).alias("_null"),
        F.count_if(valid).alias("_valid"),
    )
    totals = per_domain.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_emails"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("null_emails"),
        F.coalesce(F.sum("_valid"), F.lit(0)).alias("valid_emails"),
        F.count("_domain").alias("unique_domain_count"),
    )
    given = F.col("total_emails") - F.col("null_emails")
    return totals.select(
        "total_emails",
        "null_emails",
        "valid_emails",
        (given - F.col("valid_emails")).alias("invalid_emails"),
        F.coalesce(percent(F.col("valid_emails"), given), F.lit(0.0)).alias("valid_percentage"),
        "unique_domain_count",
    )


def email_domains(df: DataFrame, column: str, k: int = COMMON_DOMAINS) -> DataFrame:
    """The most common domains of valid addresses."""
    valid = df.filter(email_is_valid(col(column)))
    counts = valid.groupBy(email_domain(col(column)).alias("domain")).agg(
        F.count("*").alias("n")
    )
    return counts.orderBy(F.desc("n"), "domain").limit(k)


def email_errors(df: DataFrame, column: str) -> DataFrame:
    """Rows per broken rule."""
    errors = df.select(email_error(col(column)).alias("error")).filter("error IS NOT NULL")
    return errors.groupBy("error").agg(F.count("*").alias("n"))


def email_examples(df: DataFrame, column: str, k: int = EMAIL_EXAMPLES) -> DataFrame:
    """A few distinct invalid addresses with the rule they break."""
    found = df.select(col(column).alias("email"), email_error(col(column)).alias("error"))
    return found.filter("error IS NOT NULL").distinct().orderBy("email").limit(k)


def clean_whitespace(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip text columns, by default all of them."""
    texts = string_columns(df)
    chosen = [c for c in (columns or texts) if c in texts]
    return df.withColumns({c: strip_whitespace(col(c)) for c in chosen})


def _resolved(
    df: DataFrame,
    numeric: list[str] | None,
    dates: list[str] | None,
    whitespace: list[str] | None,
) -> dict[str, list[str]]:
    """Columns to clean by kind; detection runs only for kinds left open."""
    given = {NUMERIC: numeric, DATE: dates, WHITESPACE: whitespace}
    found = detect_cleaning(df) if None in given.values() else {}
    texts = set(string_columns(df))
    return {
        kind: [c for c in (found[kind] if names is None else names) if c in texts]
        for kind, names in given.items()
    }


def _cleaner(kind: str, c: Column) -> Column:
    return {NUMERIC: parse_number_mixed, DATE: parse_date_mixed, WHITESPACE: strip_whitespace}[
        kind
    ](c)


def clean_table(
    df: DataFrame,
    numeric_columns: list[str] | None = None,
    date_columns: list[str] | None = None,
    whitespace_columns: list[str] | None = None,
) -> DataFrame:
    """Strip, then convert numbers and dates; a conversion wins over stripping.

    Kinds not given are detected. All columns are cleaned in one projection.
    """
    chosen = _resolved(df, numeric_columns, date_columns, whitespace_columns)
    cleaned = {c: _cleaner(WHITESPACE, col(c)) for c in chosen[WHITESPACE]}
    cleaned |= {c: _cleaner(NUMERIC, col(c)) for c in chosen[NUMERIC]}
    cleaned |= {c: _cleaner(DATE, col(c)) for c in chosen[DATE]}
    return df.withColumns(cleaned) if cleaned else df


def _changes(df: DataFrame, chosen: dict[str, list[str]]) -> DataFrame:
    """(column, kind, original, cleaned) for values the cleaning rewrites."""
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("kind"),
            col(c).alias("original"),
            _cleaner(kind, col(c)).cast("string").alias("cleaned"),
        )
        for kind, names in chosen.items()
        for c in names
    ]
    return df.select(F.inline(F.array(*entries)))


def cleaning_summary(
    df: DataFrame,
    numeric_columns: list[str] | None = None,
    date_columns: list[str] | None = None,
    whitespace_columns: list[str] | None = None,
) -> DataFrame:
    """(column, kind, changed, unreadable): values rewritten and values that got lost."""
    chosen = _resolved(df, numeric_columns, date_columns, whitespace_columns)
    changed = F.col("cleaned").isNotNull() & (F.col("original") != F.col("cleaned"))
    lost = F.col("original").isNotNull() & F.col("cleaned").isNull()
    return (
        _changes(df, chosen)
        .groupBy("column", "kind")
        .agg(F.count_if(changed).alias("changed"), F.count_if(lost).alias("unreadable"))
    )


def cleaning_changes(
    df: DataFrame,
    numeric_columns: list[str] | None = None,
    date_columns: list[str] | None = None,
    whitespace_columns: list[str] | None = None,
    n_samples: int = CHANGE_EXAMPLES,
) -> DataFrame:
    """A few distinct rewritten values per column and kind."""
    chosen = _resolved(df, numeric_columns, date_columns, whitespace_columns)
    rewritten = _changes(df, chosen).filter("cleaned IS NOT NULL AND original != cleaned")
    return _first_values(rewritten.distinct(), ["column", "kind"], ["original"], n_samples)


def cleaning_samples(df: DataFrame, n_samples: int = SAMPLES) -> DataFrame:
    """Sample values per column beside what number, date and white-space cleaning would make
    of them; only recommended cleanings are filled in."""
    # At most three rows per column.
    rows = quality_recommendations(df).filter("recommended").collect()
    wanted = {
        kind: [r["column"] for r in rows if r.kind == kind]
        for kind in (NUMERIC, DATE, WHITESPACE)
    }
    value = F.col("value")

    def suggested(kind: str, cleaned: Column) -> Column:
        return F.when(F.col("column").isin(wanted[kind]), cleaned)

    date_format = detect_date_format(value)
    return column_samples(df, n_samples).select(
        "column",
        "value",
        suggested(NUMERIC, parse_number_mixed(value)).alias("cleaned_number"),
        suggested(DATE, F.when(date_format.isNotNull(), parse_date_mixed(value))).alias(
            "cleaned_date"
        ),
        suggested(DATE, date_format).alias("date_format"),
        suggested(
            WHITESPACE, F.when(has_outer_whitespace(value), strip_whitespace(value))
        ).alias("cleaned_text"),
    )
