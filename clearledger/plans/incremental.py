"""Daily arrival: new transactions merged into the reporting table without reading the old ones.

Two tables of files carry the state, both partitioned by a period (day or month):

* ``partials`` (period, load): sums of amounts and numbers of transactions per account, date and
  currency of one load. Sums and counts merge by addition, so a load need not know the others. A load
  replaces its own partitions only, hence running it again changes nothing.
* ``report`` (period): the reporting model. After a load only the periods that the load touched are
  summed up again, over the partials of all loads, and written over with dynamic partition overwrite;
  a late day touches its old period.

A load or a period that has lost all of its rows cannot be written over by nothing, so every period
written also gets a row with no transactions; readers leave it out.

Conversion to EUR is linear and happens after the merge, with accounts, rates and customers as they
are at that time: a period shows those of its last rebuild. After a change to them ``rebuild`` writes
periods (or all) again from the partials alone. A missing date has a period of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.plans.reporting import price_and_group, sums_per_account
from clearledger.sources.tables import MOST_TASKS, stored

#: Partial sums, read from footers, per task of the join that rebuilds periods.
TASK_SUMS = 500_000
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
NO_DATE = "none"
NAMED_PERIODS = 1_000
PARTIAL = (
    "account_id {key}, transaction_date date, currency_iso_code string, _amount double, _transactions long, "
    "period string, load string"
)
REPORT = (
    "transaction_date date, customer_id {key}, account_id {key}, branch_id string, total_amount_eur double, "
    "total_transactions long, period string"
)


def period_of(date: Column, grain: str) -> Column:
    """The period of a date as text; one of its own for a missing date."""
    return F.coalesce(F.date_format(date, PERIODS[grain]), F.lit(NO_DATE))


def _with_empty_rows(df: DataFrame, places: DataFrame, count: str) -> DataFrame:
    """The rows and, for each place, one with nulls and a count of 0."""
    return df.unionByName(places.withColumn(count, F.lit(0).cast("long")), allowMissingColumns=True)


def _overwrite(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that have rows in ``df``, and no others.

    Rows are gathered by partition first, so that a partition is a few files; one too large for a
    task is split."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


@dataclass(frozen=True)
class DailySummary:
    """The reporting table below a folder that all executors share."""

    folder: str
    grain: str = "day"
    key_type: str = "long"

    @property
    def partials_path(self) -> str:
        return f"{self.folder}/partials"

    @property
    def report_path(self) -> str:
        return f"{self.folder}/report"

    def partials(self, spark: SparkSession) -> DataFrame:
        """All partial sums, empty rows included; filters on period and load reach the listing of
        the files."""
        return spark.read.schema(PARTIAL.format(key=self.key_type)).parquet(self.partials_path)

    def report(self, spark: SparkSession) -> DataFrame:
        """The reporting table, without the period."""
        rows = spark.read.schema(REPORT.format(key=self.key_type)).parquet(self.report_path)
        return rows.where("total_transactions > 0").drop("period")

    def _given_before(self, spark: SparkSession, load: str) -> DataFrame | None:
        """The periods in which a load has partials already."""
        try:
            return self.partials(spark).where(F.col("load") == load).select("period").distinct()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _of(self, sums: DataFrame, periods: DataFrame) -> DataFrame:
        """The partial sums of some periods."""
        named = [r.period for r in periods.limit(NAMED_PERIODS + 1).collect()]
        if len(named) > NAMED_PERIODS:
            return sums.join(periods, "period", "left_semi")
        return sums.where(F.col("period").isin(named))

    def add(
        self,
        transactions: DataFrame,
        load: str,
        accounts: DataFrame,
        fx_rates: DataFrame,
        customers: DataFrame,
    ) -> DataFrame:
        """Merge one load of cleaned transactions; returns the periods that were rebuilt.

        The load is read once. A load that is run again replaces all it gave before. Loads must
        not run at the same time."""
        spark = transactions.sparkSession
        sums = sums_per_account(transactions)
        placed = sums.withColumns({"period": period_of(F.col("transaction_date"), self.grain), "load": F.lit(load)})
        # stored: the periods below must be those that are written, and cost no second reading
        placed = stored(placed, "load")
        touched, before = placed.select("period"), self._given_before(spark, load)
        touched = stored((touched if before is None else touched.union(before)).distinct(), "touched")
        places = touched.withColumn("load", F.lit(load))
        _overwrite(_with_empty_rows(placed, places, "_transactions"), self.partials_path, ["period", "load"])
        self.rebuild(spark, accounts, fx_rates, customers, touched)
        return touched

    def rebuild(
        self,
        spark: SparkSession,
        accounts: DataFrame,
        fx_rates: DataFrame,
        customers: DataFrame,
        periods: DataFrame | None = None,
    ) -> None:
        """Write periods (all if None) of the reporting table again from the partials.

        Up to ``NAMED_PERIODS`` periods are named in the filter, so that no other partition of the
        partials is listed or read; more are joined."""
        sums = self.partials(spark)
        if periods is not None:
            sums = self._of(sums, periods.select("period"))
        merged = sums.where("_transactions > 0").groupBy("account_id", "transaction_date", "currency_iso_code").agg(
            F.sum("_amount").alias("_amount"), F.sum("_transactions").alias("_transactions")
        )
        tasks = min(math.ceil(sums.count() / TASK_SUMS), MOST_TASKS)
        finer = tasks if tasks > spark.sparkContext.defaultParallelism else None
        report = price_and_group(merged, accounts, fx_rates, customers, tasks=finer)
        placed = report.withColumn("period", period_of(F.col("transaction_date"), self.grain))
        places = sums.select("period").distinct()
        _overwrite(_with_empty_rows(placed, places, "total_transactions"), self.report_path, ["period"])
