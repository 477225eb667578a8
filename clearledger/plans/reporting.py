"""The reporting model: transactions in EUR per customer, account, branch and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.functions import to_eur
from clearledger.operators.joins import BROADCAST_ROWS, left_join_lookup
from clearledger.sources.tables import tasks_for

UNKNOWN_BRANCH = "Unknown"


def transactions_with_account(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions of known accounts, with the customer of the account."""
    owners = accounts.select("account_id", "customer_id")
    return transactions.join(owners, "account_id", "inner").select(
        "transaction_id",
        "account_id",
        "customer_id",
        "transaction_date",
        "transaction_amount",
        F.col("transaction_currency").alias("currency_iso_code"),
        "transaction_type",
    )


def transactions_in_eur(
    transactions: DataFrame, fx_rates: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Every transaction with its rate and its amount in EUR; no date takes part in the join."""
    rates = fx_rates.select("currency_iso_code", "fx_rate")
    priced = left_join_lookup(
        transactions.withColumnRenamed("transaction_currency", "currency_iso_code"),
        rates,
        "currency_iso_code",
        spread_by=["transaction_id"],
        broadcast_rows=broadcast_rows,
    )
    return priced.select(
        "transaction_id",
        "account_id",
        "transaction_date",
        "transaction_amount",
        "currency_iso_code",
        F.coalesce("fx_rate", F.lit(1.0)).alias("exchange_rate_to_eur"),
        to_eur(
            F.col("transaction_amount"), F.col("currency_iso_code"), F.col("fx_rate")
        ).alias("amount_eur"),
    )


def customer_transactions_summary(
    transactions: DataFrame,
    accounts: DataFrame,
    fx_rates: DataFrame,
    customers: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sum in EUR and number of transactions per date, customer, account and branch.

    Conversion is linear, so transactions are summed per account, date and currency before
    anything is joined. An account holding a third of all rows shrinks to one row per date and
    currency inside the map tasks, and no later shuffle sees the single transactions. Branches
    are put on the accounts, the small side, so the customer join moves no transaction either.
    The last grouping reuses the partitioning of the account join, whose number of tasks follows the
    files of the transactions. Duplicate accounts, rates or customers multiply rows exactly as in
    joins on the single transactions.
    """
    sums, tasks = sums_per_account(transactions), tasks_for(transactions)
    return price_and_group(sums, accounts, fx_rates, customers, broadcast_rows, tasks)


def sums_per_account(transactions: DataFrame) -> DataFrame:
    """(account_id, transaction_date, currency_iso_code, _amount, _transactions): sums and counts
    that may be summed up again with those of other transactions."""
    return transactions.groupBy(
        "account_id",
        "transaction_date",
        F.col("transaction_currency").alias("currency_iso_code"),
    ).agg(
        F.sum("transaction_amount").alias("_amount"),
        F.count("*").alias("_transactions"),
    )


def owners_of(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts with their customer and branch."""
    return (
        accounts.select("account_id", "customer_id")
        .join(customers.select("customer_id", "branch_id"), "customer_id", "left")
        .select(
            "account_id",
            "customer_id",
            F.coalesce(F.col("branch_id").cast("string"), F.lit(UNKNOWN_BRANCH)).alias(
                "branch_id"
            ),
        )
    )


def price_and_group(
    per_account: DataFrame,
    accounts: DataFrame,
    fx_rates: DataFrame,
    customers: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """The reporting model from the sums of ``sums_per_account``.

    The account join sorts and groups the rows of a task in memory. Spark deals them to as many tasks
    as there are cores, up to 64 MB of packed rows each; ``tasks`` deals both sides finer."""
    owners, priced = owners_of(accounts, customers), priced_sums(per_account, fx_rates, broadcast_rows)
    if tasks:
        priced, owners = (df.repartition(tasks, "account_id") for df in (priced, owners))
    return group_by_owner(priced, owners)


def priced_sums(per_account: DataFrame, fx_rates: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(account_id, transaction_date, _eur, _transactions)."""
    return left_join_lookup(
        per_account,
        fx_rates.select("currency_iso_code", "fx_rate"),
        "currency_iso_code",
        spread_by=["account_id", "transaction_date"],
        broadcast_rows=broadcast_rows,
    ).select(
        "account_id",
        "transaction_date",
        to_eur(F.col("_amount"), F.col("currency_iso_code"), F.col("fx_rate")).alias("_eur"),
        "_transactions",
    )


def group_by_owner(priced: DataFrame, owners: DataFrame) -> DataFrame:
    """Sums per date, customer, account and branch; grouping reuses the partitioning of the join."""
    return (
        priced.join(owners, "account_id", "inner")
        .groupBy("transaction_date", "customer_id", "account_id", "branch_id")
        .agg(
            F.sum("_eur").alias("total_amount_eur"),
            F.sum("_transactions").alias("total_transactions"),
        )
    )
