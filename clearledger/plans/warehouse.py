"""Building the layers from raw tables, lazily or as catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearledger.plans import intermediate, reporting, staging

RAW_TABLES = ("accounts", "customers", "fx_rates", "loans", "transactions", "currencies")
DEFAULT_DATABASE = "default"


def staging_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_accounts": staging.stg_accounts(raw["accounts"]),
        "stg_customers": staging.stg_customers(raw["customers"]),
        "stg_fx_rates": staging.stg_fx_rates(raw["fx_rates"]),
        "stg_loans": staging.stg_loans(raw["loans"]),
        "stg_transactions": staging.stg_transactions(raw["transactions"]),
    }


def intermediate_models(staged: dict[str, DataFrame], currencies: DataFrame) -> dict[str, DataFrame]:
    return {
        "int_accounts": intermediate.without_date_errors(staged["stg_accounts"]),
        "int_customers": intermediate.int_customers(staged["stg_customers"]),
        "int_fx_rates": intermediate.without_date_errors(staged["stg_fx_rates"]),
        "int_loans": intermediate.without_date_errors(staged["stg_loans"]),
        "int_transactions": intermediate.without_date_errors(staged["stg_transactions"]),
        "int_currencies": intermediate.int_currencies(currencies),
    }


def reporting_models(cleaned: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "customer_transactions_summary": reporting.customer_transactions_summary(
            cleaned["int_transactions"],
            cleaned["int_accounts"],
            cleaned["int_fx_rates"],
            cleaned["int_customers"],
        )
    }


def lazy_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All models as plans over the raw tables; nothing is written."""
    staged = staging_models(raw)
    cleaned = intermediate_models(staged, raw["currencies"])
    return {**staged, **cleaned, **reporting_models(cleaned)}


def database_for(custom: str | None, default: str = DEFAULT_DATABASE) -> str:
    """A model's database: its own name used verbatim, or the default when it has none."""
    return default if custom is None else custom.strip()


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A layer kept as a view: planned again by every reader."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_table(
    df: DataFrame, name: str, database: str | None, default: str = DEFAULT_DATABASE
) -> DataFrame:
    """A layer kept as a table: fully rewritten on every run, then read back."""
    spark: SparkSession = df.sparkSession
    target = database_for(database, default)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target}`")
    qualified = f"`{target}`.`{name}`"
    df.write.mode("overwrite").format("parquet").saveAsTable(qualified)
    return spark.table(qualified)


def build_warehouse(
    raw: dict[str, DataFrame],
    intermediate_database: str | None = "intermediate",
    reporting_database: str | None = "reporting",
) -> dict[str, DataFrame]:
    """Run the pipeline: staging as views, intermediate and reporting as tables.

    Each layer reads what the layer before wrote, so a lost executor costs at most the model
    being written.
    """
    staged = {n: publish_view(df, n) for n, df in staging_models(raw).items()}
    cleaned = {
        n: publish_table(df, n, intermediate_database)
        for n, df in intermediate_models(staged, raw["currencies"]).items()
    }
    reports = {
        n: publish_table(df, n, reporting_database) for n, df in reporting_models(cleaned).items()
    }
    return {**staged, **cleaned, **reports}
