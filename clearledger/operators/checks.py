"""Declared checks. Each returns the failing rows or values; an empty frame is a pass."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearledger.operators.frames import col, stack

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"
NUMERIC_RANGE = "numeric_range"
DATE_IS_PAST = "date_is_past"
IS_BOOL = "is_bool"
UNIQUE_COMBINATION = "unique_combination_of_columns"
SUMMARY_SCHEMA = "model string, column string, check string, failures bigint, passed boolean"


class CheckFailed(Exception):
    """A fail-fast run met a failing check."""


def _today(as_of: str | None) -> Column:
    return F.lit(as_of).cast("date") if as_of else F.current_date()


def _outside(c: Column, low: float | None, high: float | None) -> Column:
    """Beyond the inclusive bounds; with no bound nothing is."""
    failing = F.lit(False)
    if low is not None:
        failing = failing | (c < low)
    if high is not None:
        failing = failing | (c > high)
    return failing


def not_accepted(c: Column, values: list[Any]) -> Column:
    return c.isNotNull() & ~c.isin(*values)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """(value, n) for values held by several rows; missing values are ignored."""
    return (
        df.filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def accepted_values(df: DataFrame, column: str, values: list[Any]) -> DataFrame:
    """(value, n) for values outside the list; a missing value passes."""
    return (
        df.filter(not_accepted(col(column), values))
        .groupBy(col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys, one per child row, that the parent lacks; a missing key passes."""
    parents = parent.select(col(parent_column).alias(column)).distinct()
    keys = child.filter(col(column).isNotNull()).select(col(column))
    return keys.join(parents, column, "left_anti")


def numeric_range(
    df: DataFrame, column: str, min: float | None = None, max: float | None = None
) -> DataFrame:
    return df.filter(_outside(col(column), min, max))


def date_is_past(df: DataFrame, column: str, as_of: str | None = None) -> DataFrame:
    """Rows dated after today; today and a missing date pass."""
    return df.filter(col(column) > _today(as_of))


def is_bool(df: DataFrame, column: str) -> DataFrame:
    """Values above one; negative ones pass."""
    value = col(column).cast("int")
    return df.filter(value > 1).select(value.alias("test_field"))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations held by several rows, with their number; missing parts are equal."""
    counts = df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


@dataclass(frozen=True)
class Check:
    """One declared check on one model."""

    model: str
    kind: str
    columns: tuple[str, ...]
    options: dict[str, Any] = field(default_factory=dict, hash=False)

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def failing(check: Check, models: dict[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """The failing rows or values of a declared check."""
    df, column, o = models[check.model], check.columns[0], check.options
    if check.kind == NOT_NULL:
        return not_null(df, column)
    if check.kind == UNIQUE:
        return unique(df, column)
    if check.kind == ACCEPTED_VALUES:
        return accepted_values(df, column, o["values"])
    if check.kind == RELATIONSHIPS:
        return relationships(df, column, models[o["to"]], o["field"])
    if check.kind == NUMERIC_RANGE:
        return numeric_range(df, column, o.get("min"), o.get("max"))
    if check.kind == DATE_IS_PAST:
        return date_is_past(df, column, as_of)
    if check.kind == IS_BOOL:
        return is_bool(df, column)
    if check.kind == UNIQUE_COMBINATION:
        return unique_combination(df, list(check.columns))
    raise ValueError(f"unknown check {check.kind}")


def row_condition(check: Check, as_of: str | None) -> Column | None:
    """Condition of a check that looks at single rows, so that one scan can count many."""
    column, o = col(check.columns[0]), check.options
    if check.kind == NOT_NULL:
        return column.isNull()
    if check.kind == NUMERIC_RANGE:
        return _outside(column, o.get("min"), o.get("max"))
    if check.kind == DATE_IS_PAST:
        return column > _today(as_of)
    if check.kind == IS_BOOL:
        return column.cast("int") > 1
    return None


def _key_text(check: Check) -> Column:
    """The value a check groups rows by, as text; null where the check leaves a row out."""
    if check.kind == UNIQUE_COMBINATION:
        return F.to_json(F.struct(*[col(c) for c in check.columns]), {"ignoreNullFields": "false"})
    return col(check.columns[0]).cast("string")


def _entry(i: int, check: Check, as_of: str | None) -> Column:
    """What a row adds to a check: nothing, or one entry under the key that counts."""
    condition, key = row_condition(check, as_of), F.lit(None).cast("string")
    if condition is None:
        key = _key_text(check)
        condition = key.isNotNull()
        if check.kind == ACCEPTED_VALUES:
            condition = not_accepted(col(check.columns[0]), check.options["values"])
    return F.when(condition, F.struct(F.lit(i).alias("_check"), key.alias("_key")))


def _model_summary(
    model: str, checks: list[Check], models: dict[str, DataFrame], as_of: str | None
) -> DataFrame:
    """(check number, failures) of a model, all from one scan of it.

    Rows become entries (check, key), counted per key inside the map tasks; parents' keys meet
    these counts, which already lie by check and key. A key with most rows is one entry a task.
    """
    df = models[model]
    entries = [_entry(i, c, as_of) for i, c in enumerate(checks)]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("_check").isNotNull())
        .groupBy("_check", "_key")
        .agg(F.count("*").alias("_n"))
    )
    parents = [
        models[c.options["to"]]
        .select(F.lit(i).alias("_check"), col(c.options["field"]).cast("string").alias("_key"))
        .filter(F.col("_key").isNotNull())
        for i, c in enumerate(checks)
        if c.kind == RELATIONSHIPS
    ]
    if parents:
        known = stack(parents).distinct().withColumn("_known", F.lit(True))
        counts = counts.join(known, ["_check", "_key"], "left")
    else:
        counts = counts.withColumn("_known", F.lit(False))
    of = lambda *kinds: F.col("_check").isin([i for i, c in enumerate(checks) if c.kind in kinds])
    failures = (
        F.when(of(RELATIONSHIPS), F.when(F.col("_known").isNull(), F.col("_n")))
        .when(of(UNIQUE, UNIQUE_COMBINATION), (F.col("_n") > 1).cast("bigint"))
        .when(of(ACCEPTED_VALUES), F.lit(1).cast("bigint"))
        .otherwise(F.col("_n"))
    )
    found = counts.groupBy("_check").agg(F.sum(failures).alias("failures"))
    declared = [
        F.struct(
            F.lit(i).alias("_check"),
            F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column"),
            F.lit(c.kind).alias("check"),
        )
        for i, c in enumerate(checks)
    ]
    named = df.sparkSession.range(1).select(F.inline(F.array(*declared)))
    # One row per declared check on both sides.
    return named.join(F.broadcast(found), "_check", "left").select(
        "model", "column", "check", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def check_suite_summary(
    checks: list[Check], models: dict[str, DataFrame], as_of: str | None = None
) -> DataFrame:
    """(model, column, check, failures, passed), one row per declared check.

    Every model is scanned once for all its checks, and once more where it is a parent.
    """
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        own = [c for c in checks if c.model == model]
        parts.append(_model_summary(model, own, models, as_of))
    return stack(parts).withColumn("passed", F.col("failures") == 0)


def run_checks(
    checks: list[Check],
    models: dict[str, DataFrame],
    as_of: str | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """Run a suite; with ``fail_fast`` stop at the first model with a failing check."""
    if not fail_fast:
        return check_suite_summary(checks, models, as_of)
    done, spark = [], next(iter(models.values())).sparkSession
    for model in dict.fromkeys(c.model for c in checks):
        summary = check_suite_summary([c for c in checks if c.model == model], models, as_of)
        rows = summary.collect()  # one row per declared check
        if failed := [r for r in rows if not r.passed]:
            listed = ", ".join(f"{r['check']}({r['column']}): {r.failures}" for r in failed)
            raise CheckFailed(f"{model}: {listed}")
        done += rows
    return spark.createDataFrame(done, SUMMARY_SCHEMA)
