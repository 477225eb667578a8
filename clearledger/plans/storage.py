"""Layers stored bucketed by account, so that the reporting model is joined without a shuffle.

The rows of one account lie in one bucket. Single transactions are therefore not bucketed (an
account may hold a third of them); their sums per account, date and currency are, and so are the
accounts with customer and branch. Reading both, Spark joins bucket to bucket and groups within the
bucket: the one exchange left is the broadcast of the rates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from clearledger.operators.joins import BROADCAST_ROWS
from clearledger.plans.reporting import group_by_owner, owners_of, priced_sums, sums_per_account

ACCOUNT = "account_id"


def publish_bucketed(
    df: DataFrame, name: str, database: str, by: list[str], buckets: int, path: str | None = None
) -> DataFrame:
    """A layer as a table in so many buckets, a sorted file each; replaces the old content.

    Rows are dealt by the same hash before they are written, so that each bucket is written by one
    task. ``path`` puts the files elsewhere than in the warehouse folder."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    qualified = f"`{database}`.`{name}`"
    writer = df.repartition(buckets, *by).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(qualified)
    return spark.table(qualified)


@dataclass(frozen=True)
class BucketedLayers:
    """Sums per account, date and currency, and accounts with their owners, in equal buckets."""

    account_days: DataFrame
    owners: DataFrame

    def summary(self, fx_rates: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """The reporting model, joined and grouped bucket by bucket."""
        return group_by_owner(priced_sums(self.account_days, fx_rates, broadcast_rows), self.owners)


def bucket_layers(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    database: str,
    buckets: int,
    folder: str | None = None,
) -> BucketedLayers:
    """Write both layers; every later report reads them without a shuffle."""
    path = lambda name: f"{folder}/{name}" if folder else None
    days, owners = sums_per_account(transactions), owners_of(accounts, customers)
    return BucketedLayers(
        publish_bucketed(days, "account_days", database, [ACCOUNT], buckets, path("account_days")),
        publish_bucketed(owners, "account_owners", database, [ACCOUNT], buckets, path("account_owners")),
    )
