"""Staging models: rename, parse, trim and flag. One narrow projection each, no shuffle
(customers excepted, whose rows are made distinct)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.functions import (
    has_parsing_error,
    parse_date_warehouse,
    parse_number_warehouse,
    present,
)

ERROR_FLAG = "has_date_parsing_error"


def _flagged(df: DataFrame, parsed: str, raw: str) -> DataFrame:
    """Replace the raw text kept beside a parsed date by the error flag."""
    flag = has_parsing_error(F.col(parsed), F.col(raw))
    return df.withColumn(ERROR_FLAG, flag).drop(raw)


def stg_accounts(raw: DataFrame) -> DataFrame:
    kept = raw.filter(present(F.col("account_type"), ["", "-"]))
    renamed = kept.select(
        "account_id",
        "customer_id",
        "account_type",
        parse_date_warehouse(F.col("account_opening_date")).alias("account_opening_date"),
        F.col("account_opening_date").alias("_raw"),
    )
    return _flagged(renamed, "account_opening_date", "_raw")


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        F.trim("firstname").alias("firstname"),
        F.trim("lastname").alias("lastname"),
        F.col("Age").alias("age"),
        "branch_id",
    ).distinct()


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    kept = raw.filter(present(F.col("currency_iso_code"), ["(none)", ""], trimmed=True))
    renamed = kept.select(
        F.trim("currency_iso_code").alias("currency_iso_code"),
        parse_number_warehouse(F.col("fx_rate")).alias("fx_rate"),
        parse_date_warehouse(F.col("date")).alias("fx_rate_date"),
        F.col("date").alias("_raw"),
    )
    return _flagged(renamed, "fx_rate_date", "_raw")


def stg_loans(raw: DataFrame) -> DataFrame:
    renamed = raw.select(
        "customer_id",
        "loan_id",
        parse_number_warehouse(F.col("loan_amount")).alias("loan_amount"),
        F.col("loant_type").alias("loan_type"),
        parse_number_warehouse(F.col("interest_rate")).alias("interest_rate"),
        "loan_term",
        parse_date_warehouse(F.col("approval_rejection_date")).alias("approval_rejection_date"),
        "loan_status",
        F.col("approval_rejection_date").alias("_raw"),
    )
    return _flagged(renamed, "approval_rejection_date", "_raw")


def stg_transactions(raw: DataFrame) -> DataFrame:
    renamed = raw.select(
        "transaction_id",
        parse_date_warehouse(F.col("transaction_date")).alias("transaction_date"),
        "account_id",
        F.trim("transaction_type").alias("transaction_type"),
        parse_number_warehouse(F.col("transaction_amount")).alias("transaction_amount"),
        F.trim("transaction_currency").alias("transaction_currency"),
        F.col("transaction_date").alias("_raw"),
    )
    return _flagged(renamed, "transaction_date", "_raw")
