"""Identifier columns: duplicates, composite keys, order, digits."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.functions import count_digits
from clearledger.operators.frames import col, percent, value_counts_long
from clearledger.operators.profile import profile_counts

# What makes a column an identifier by name, and by share of distinct values.
ID_TERMS = ("id", "key", "code", "num")
NEARLY_UNIQUE_PERCENT = 95.0
LISTED_RECORDS = 100
# Six times the standard error of the approximate distinct count.
SCREEN_MARGIN = 0.3


def detect_id_columns(df: DataFrame) -> list[str]:
    """Columns named like an identifier, then nearly unique ones that are not constant."""
    named = [c for c in df.columns if any(term in c.lower() for term in ID_TERMS)]
    others = [c for c in df.columns if c not in named]
    if not others:
        return named
    # A sketch rules out most columns; only those it cannot are counted exactly.
    screened = profile_counts(df, others, approx=True).collect()  # one row per column
    near = NEARLY_UNIQUE_PERCENT * (1 - SCREEN_MARGIN)
    others = [r["column"] for r in screened if (r.unique_percentage or 0) > near]
    if not others:
        return named
    report = {r["column"]: r for r in profile_counts(df, others).collect()}
    unique = [
        c
        for c in others
        if c in report
        and report[c].unique_percentage > NEARLY_UNIQUE_PERCENT
        and report[c].unique_values > 1
    ]
    return named + unique


def id_duplicates(df: DataFrame, id_columns: list[str] | None = None) -> DataFrame:
    """Missing values, duplicated values and records involved per identifier column; a column
    the frame lacks gets an error row. Derived from one shared count of values."""
    id_columns = id_columns or detect_id_columns(df)
    known = [c for c in id_columns if c in df.columns]
    absent = [c for c in id_columns if c not in df.columns]
    n, value = F.col("n"), F.col("value")
    repeated = value.isNotNull() & (n > 1)
    report = (
        value_counts_long(df, known)
        .groupBy("column")
        .agg(
            F.sum(F.when(value.isNull(), n).otherwise(0)).alias("missing_count"),
            F.sum("n").alias("_rows"),
            F.count_if(repeated).alias("duplicate_values_count"),
            F.sum(F.when(repeated, n).otherwise(0)).alias("records_with_duplicates"),
        )
        .select(
            "column",
            "missing_count",
            percent(F.col("missing_count"), F.col("_rows")).alias("missing_percentage"),
            (F.col("duplicate_values_count") > 0).alias("has_duplicates"),
            "duplicate_values_count",
            "records_with_duplicates",
            (F.col("records_with_duplicates") > LISTED_RECORDS).alias("too_many_to_list"),
            F.lit(None).cast("string").alias("error"),
        )
    )
    if not absent:
        return report
    errors = df.sparkSession.createDataFrame(
        [(c, None, None, None, None, None, None, f"Column '{c}' not found") for c in absent],
        T.StructType([T.StructField(f.name, f.dataType, True) for f in report.schema.fields]),
    )
    return report.unionByName(errors)


def duplicate_values(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """(column, value, n) for every value an identifier column holds more than once."""
    counts = value_counts_long(df, id_columns)
    return counts.filter(F.col("value").isNotNull() & (F.col("n") > 1))


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def duplicate_records(df: DataFrame, column: str) -> DataFrame:
    """All rows whose value of a column occurs more than once, equal values together.

    The null-safe condition gives the join shuffles of its own, which adaptive execution can
    split where one value holds most rows. A hash of the other columns breaks ties in the sort,
    so that range bounds can fall within one value.
    """
    return _repeated_rows(df, column).orderBy(col(column), *_tie_breaker(df, [column]))


def _repeated_rows(df: DataFrame, column: str) -> DataFrame:
    repeated = (
        df.filter(col(column).isNotNull())
        .groupBy(col(column))
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
        .alias("r")
    )
    return df.alias("d").join(repeated, _same("d", "r", [column]), "left_semi")


def _tie_breaker(df: DataFrame, keys: list[str]) -> list[Column]:
    """A hash of the columns that are not keys; maps cannot be hashed and are left out."""
    others = [
        f.name for f in df.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()
    ]
    return [F.xxhash64(*[col(c) for c in others])] if others else []


def listed_records(
    records: DataFrame, order_by: list[str], limit: int = LISTED_RECORDS
) -> DataFrame:
    """What a report prints of a set of records: the first ``limit`` in order and whether some
    are left. One top-k of ``limit + 1`` rows holds both."""
    first = records.orderBy(*[col(c) for c in order_by]).limit(limit + 1)
    # limit + 1 rows at most from here on
    numbered = first.withColumn(
        "_place", F.row_number().over(W.orderBy(*[col(c) for c in order_by]))
    ).withColumn("truncated", F.count("*").over(W.partitionBy()) > limit)
    return numbered.filter(F.col("_place") <= limit).drop("_place")


def listed_duplicates(
    df: DataFrame, column: str, columns: list[str], limit: int = LISTED_RECORDS
) -> DataFrame:
    """The first rows, in the order of ``columns``, whose value of a column repeats; without
    sorting the others."""
    return listed_records(_repeated_rows(df, column).select(*[col(c) for c in columns]), columns, limit)


def composite_key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows sharing their key combination with another row; missing parts are equal.

    Combinations are counted with map-side merging and joined back, so that a combination
    holding most rows is never gathered in one task as a window over it would.
    """
    repeated = (
        df.groupBy(*[col(k) for k in keys])
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
        .alias("r")
    )
    return df.alias("d").join(repeated, _same("d", "r", keys), "left_semi")


def composite_key_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a key combination repeats, and how many rows take part."""
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("_n"))
    involved = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
    return counts.agg(involved.alias("duplicate_records_count")).select(
        F.lit(",".join(keys)).alias("columns"),
        (F.col("duplicate_records_count") > 0).alias("has_duplicates"),
        "duplicate_records_count",
    )


def dedupe_keep_last(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the last in the given order.

    The rank limit is applied inside the map tasks, so at most one row per key and task is
    shuffled, whatever share of the rows a key holds.
    """
    last_first = [F.col(o).desc_nulls_last() for o in order_by]
    window = W.partitionBy(*[col(k) for k in keys]).orderBy(*last_first)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def repeat_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys, and rows that repeat an earlier key."""
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"),
    )


def shared_contacts(df: DataFrame, contact: str, person: str) -> DataFrame:
    """Contacts used by more than one person, with rows and persons per contact.

    Rows of one contact and person are merged first, so a contact holding most rows shrinks to
    its distinct persons before it is counted.
    """
    pairs = (
        df.filter(col(contact).isNotNull())
        .groupBy(col(contact), col(person))
        .agg(F.count("*").alias("_n"))
    )
    return (
        pairs.groupBy(col(contact))
        .agg(
            F.sum("_n").alias("records"),
            F.count(col(person)).alias("persons"),
        )
        .filter("persons > 1")
    )


def shared_contact_records(df: DataFrame, contact: str) -> DataFrame:
    """All rows whose contact occurs more than once, sorted by contact."""
    return duplicate_records(df, contact)


def id_properties(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """Whether an identifier is unique, and whether it never falls or never rises along an
    order column. A missing identifier breaks both orders.

    Rows are merged per order value, range-partitioned, and compared with their predecessor
    inside each partition; partitions then meet in a table of one row each. Rows that tie in
    the order column may stand in any order.
    """
    identity = df.groupBy(col(column)).agg(F.count("*").alias("_n"))
    unique = identity.agg(F.coalesce(F.max("_n") <= 1, F.lit(True)).alias("u")).scalar()

    # Rows without an order value come first; several of them tie with each other.
    steps = df.groupBy(F.col(f"`{order_by}`").alias("_order")).agg(
        F.min(col(column)).alias("_min"),
        F.max(col(column)).alias("_max"),
        F.count_if(col(column).isNull()).alias("_missing"),
    )
    ranged = steps.repartitionByRange(F.col("_order")).withColumn(
        "_part", F.spark_partition_id()
    )
    along = W.partitionBy("_part").orderBy("_order")
    compared = ranged.withColumn("_prev_max", F.lag("_max").over(along)).withColumn(
        "_prev_min", F.lag("_min").over(along)
    )
    parts = compared.groupBy("_part").agg(
        F.sum("_missing").alias("_missing"),
        F.bool_and(F.coalesce(F.col("_min") >= F.col("_prev_max"), F.lit(True))).alias("_inc"),
        F.bool_and(F.coalesce(F.col("_max") <= F.col("_prev_min"), F.lit(True))).alias("_dec"),
        F.min("_min").alias("_lowest"),
        F.max("_max").alias("_highest"),
    )
    # One row per shuffle partition from here on.
    between = W.orderBy("_part")
    edges = parts.withColumn(
        "_before_high", F.max("_highest").over(between.rowsBetween(W.unboundedPreceding, -1))
    ).withColumn(
        "_before_low", F.min("_lowest").over(between.rowsBetween(W.unboundedPreceding, -1))
    )
    whole = F.coalesce(F.sum("_missing"), F.lit(0)) == 0
    rising = F.bool_and(
        F.col("_inc") & F.coalesce(F.col("_lowest") >= F.col("_before_high"), F.lit(True))
    )
    falling = F.bool_and(
        F.col("_dec") & F.coalesce(F.col("_highest") <= F.col("_before_low"), F.lit(True))
    )
    verdict = edges.agg(
        (whole & F.coalesce(rising, F.lit(True))).alias("is_monotonic_inc"),
        (whole & F.coalesce(falling, F.lit(True))).alias("is_monotonic_dec"),
    )
    return verdict.select(
        F.lit(column).alias("column"),
        unique.alias("is_unique"),
        "is_monotonic_inc",
        "is_monotonic_dec",
        (F.col("is_monotonic_inc") | F.col("is_monotonic_dec")).alias("is_monotonic"),
    )


def digit_counts(df: DataFrame, column: str) -> DataFrame:
    """How many values have how many digits."""
    return df.groupBy(count_digits(col(column)).alias("digits")).agg(F.count("*").alias("n"))
