"""Checks of single rows counted while a layer is written; layers that fail are not published.

A check that looks at one row at a time (missing, outside a range or a list, in the future, not a
flag) is a metric of ``DataFrame.observe``: the write that makes the layer counts its failing rows,
and no scan is spent on it. Checks of keys (unique, combinations, relationships) need the rows
together; they run on the written candidate, before it takes the place of the published table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearledger.operators.checks import (
    ACCEPTED_VALUES,
    SUMMARY_SCHEMA,
    Check,
    CheckFailed,
    check_suite_summary,
    not_accepted,
    row_condition,
)
from clearledger.operators.frames import col

CANDIDATE, PREVIOUS = "__candidate", "__previous"
Result = tuple[str, str, str, int, bool]


def failing_rows(check: Check, as_of: str | None = None) -> Column | None:
    """Whether a row fails a check; None for a check that a row alone cannot fail.

    A list of accepted values counts as such: here its failures are rows, in the summary of a
    suite they are values."""
    if check.kind == ACCEPTED_VALUES:
        return not_accepted(col(check.columns[0]), check.options["values"])
    return row_condition(check, as_of)


@dataclass(frozen=True)
class Observed:
    """A frame that counts its checks when it is written or read in whole, once."""

    df: DataFrame
    checks: list[Check]
    observation: Observation

    def results(self) -> list[Result]:
        """(model, column, check, failures, passed) of each check, after the action."""
        counted = self.observation.get
        if "rows" not in counted:
            raise RuntimeError("the checks were not counted: the frame was not read by the action")
        failures = [counted[f"check{i}"] for i in range(len(self.checks))]
        return [(c.model, c.column, c.kind, n, n == 0) for c, n in zip(self.checks, failures, strict=True)]

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]


def observe_checks(df: DataFrame, checks: list[Check], as_of: str | None = None) -> Observed:
    """Attach all row checks among ``checks`` to a frame; checks of other kinds are left out."""
    own = [c for c in checks if failing_rows(c, as_of) is not None]
    observation = Observation()
    counts = [F.count_if(F.coalesce(failing_rows(c, as_of), F.lit(False))).alias(f"check{i}") for i, c in enumerate(own)]
    return Observed(df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), own, observation)


def write_observed(
    df: DataFrame, path: str, checks: list[Check], as_of: str | None = None
) -> tuple[DataFrame, list[Result]]:
    """Write a layer's files and count its row checks in the same pass: the rows as written, and the
    results."""
    observed = observe_checks(df, checks, as_of)
    observed.df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed.results()


def results_frame(spark: SparkSession, results: list[Result]) -> DataFrame:
    """Results, one row a declared check, as a frame."""
    return spark.createDataFrame(results, SUMMARY_SCHEMA)


def _replace(spark: SparkSession, database: str, name: str) -> None:
    """Put the candidate in the place of the published table, which comes back if that fails."""
    published, candidate, previous = (f"`{database}`.`{name}{suffix}`" for suffix in ("", CANDIDATE, PREVIOUS))
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    replaced = spark.catalog.tableExists(published)
    if replaced:
        spark.sql(f"ALTER TABLE {published} RENAME TO {previous}")
    try:
        spark.sql(f"ALTER TABLE {candidate} RENAME TO {published}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {previous} RENAME TO {published}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def publish_checked(
    df: DataFrame,
    name: str,
    database: str,
    checks: list[Check],
    models: dict[str, DataFrame] | None = None,
    as_of: str | None = None,
    blocking: Callable[[Check], bool] = lambda check: True,
) -> tuple[DataFrame, list[Result]]:
    """Publish a model as a table if its checks pass; (the table, the results of all its checks).

    The model is written as a candidate, its row checks counted on the way. If one that is blocking
    fails, the candidate goes, the table published before stays as it is, and ``CheckFailed`` tells
    what failed; key checks are then not run. Checks that do not block are only reported.
    ``models`` holds the parents of relationships."""
    spark = df.sparkSession
    own = [c for c in checks if c.model == name]
    blocks = {(c.column, c.kind) for c in own if blocking(c)}
    candidate = f"`{database}`.`{name}{CANDIDATE}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {candidate}")

    def judge(results: list[Result]) -> None:
        failed = [r for r in results if not r[4] and (r[1], r[2]) in blocks]
        if failed:
            spark.sql(f"DROP TABLE IF EXISTS {candidate}")
            raise CheckFailed(f"{name}: " + ", ".join(f"{kind}({column}): {n}" for _, column, kind, n, _ in failed))

    observed = observe_checks(df, own, as_of)
    observed.df.write.format("parquet").saveAsTable(candidate)
    results = observed.results()
    judge(results)
    keys = [c for c in own if c not in observed.checks]
    if keys:
        seen = {**(models or {}), name: spark.table(candidate)}
        told = check_suite_summary(keys, seen, as_of).collect()  # one row per declared check
        results += [tuple(r) for r in told]
        judge(results)
    _replace(spark, database, name)
    return spark.table(f"`{database}`.`{name}`"), results
