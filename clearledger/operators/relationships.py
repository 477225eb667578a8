"""Foreign keys and currency coverage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.operators.frames import col, percent, stack

EXAMPLES = 5

REPORT_SCHEMA = (
    "relationship string, parent_table string, parent_key string, parent_record_count bigint, "
    "child_table string, foreign_key string, child_record_count bigint, "
    "non_null_foreign_keys bigint, null_foreign_keys bigint, null_percentage double, "
    "orphaned_records bigint, orphaned_percentage double, relationship_valid boolean, "
    "error string"
)


@dataclass(frozen=True)
class Relationship:
    parent_table: str
    parent_key: str
    child_table: str
    foreign_key: str

    @property
    def name(self) -> str:
        return f"{self.parent_table}_{self.child_table}"


# The relationships of the banking schema.
RELATIONSHIPS = (
    Relationship("customers", "customer_id", "accounts", "customer_id"),
    Relationship("customers", "customer_id", "loans", "customer_id"),
    Relationship("accounts", "account_id", "transactions", "account_id"),
)


def fk_orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is given but unknown to the parent."""
    parents = parent.select(col(parent_key).alias(foreign_key)).distinct()
    return child.filter(col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def orphan_examples(
    child: DataFrame,
    foreign_key: str,
    parent: DataFrame,
    parent_key: str,
    order_by: list[str],
    limit: int = EXAMPLES,
) -> DataFrame:
    """The first few orphans, for a report."""
    return fk_orphans(child, foreign_key, parent, parent_key).orderBy(*order_by).limit(limit)


def fk_report(
    child: DataFrame, parent: DataFrame, relationship: Relationship
) -> DataFrame:
    """One row of counts for a relationship.

    The child is reduced to its distinct keys with a count before it meets the parent, so a key
    held by a third of the rows joins as one row; the parent is reduced to distinct keys, so
    repeated parents cannot inflate counts.
    """
    key = "_key"
    children = child.groupBy(col(relationship.foreign_key).alias(key)).agg(
        F.count("*").alias("_rows")
    )
    parents = parent.groupBy(col(relationship.parent_key).alias(key)).agg(
        F.count("*").alias("_parents")
    )
    # A full join also keeps parents without children, which the parent count needs.
    both = children.join(parents, key, "full")
    rows = F.coalesce("_rows", F.lit(0))
    given = F.when(F.col(key).isNotNull(), rows).otherwise(0)
    orphaned = F.when(F.col(key).isNotNull() & F.col("_parents").isNull(), rows).otherwise(0)
    totals = both.agg(
        F.coalesce(F.sum("_parents"), F.lit(0)).alias("parents"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("children"),
        F.coalesce(F.sum(given), F.lit(0)).alias("given"),
        F.coalesce(F.sum(orphaned), F.lit(0)).alias("orphaned"),
    )
    missing = F.col("children") - F.col("given")
    zero_if_empty = lambda c: F.coalesce(c, F.lit(0.0))
    return totals.select(
        F.lit(relationship.name).alias("relationship"),
        F.lit(relationship.parent_table).alias("parent_table"),
        F.lit(relationship.parent_key).alias("parent_key"),
        F.col("parents").alias("parent_record_count"),
        F.lit(relationship.child_table).alias("child_table"),
        F.lit(relationship.foreign_key).alias("foreign_key"),
        F.col("children").alias("child_record_count"),
        F.col("given").alias("non_null_foreign_keys"),
        missing.alias("null_foreign_keys"),
        zero_if_empty(percent(missing, F.col("children"))).alias("null_percentage"),
        F.col("orphaned").alias("orphaned_records"),
        zero_if_empty(percent(F.col("orphaned"), F.col("given"))).alias("orphaned_percentage"),
        (F.col("orphaned") == 0).alias("relationship_valid"),
        F.lit(None).cast("string").alias("error"),
    )


def _error(tables: dict[str, DataFrame], r: Relationship) -> str | None:
    for table in (r.parent_table, r.child_table):
        if table not in tables:
            return f"Table '{table}' does not exist"
    for table, column in ((r.parent_table, r.parent_key), (r.child_table, r.foreign_key)):
        if column not in tables[table].columns:
            return f"Column '{column}' does not exist in table '{table}'"
    return None


def check_all_relationships(
    tables: dict[str, DataFrame], relationships: tuple[Relationship, ...] = RELATIONSHIPS
) -> DataFrame:
    """One report row per relationship; an absent table or column gives an error row."""
    spark = next(iter(tables.values())).sparkSession
    reports = []
    for r in relationships:
        error = _error(tables, r)
        if error is None:
            reports.append(fk_report(tables[r.child_table], tables[r.parent_table], r))
            continue
        values = (r.name, r.parent_table, r.parent_key, None, r.child_table, r.foreign_key)
        row = values + (None,) * 6 + (False, error)
        reports.append(spark.createDataFrame([row], REPORT_SCHEMA))
    return stack(reports)


def missing_currencies(
    transactions: DataFrame, fx_rates: DataFrame, trim: bool = False
) -> DataFrame:
    """(currency, n, has_rate) per transaction currency. Codes are compared as they are unless
    ``trim`` is set. Transactions are counted per code before the codes meet."""
    return _currencies(transactions, fx_rates, trim).filter(F.col("currency").isNotNull())


def _currencies(transactions: DataFrame, fx_rates: DataFrame, trim: bool) -> DataFrame:
    """(currency, n, has_rate), with a row for missing currencies."""
    clean = F.trim if trim else (lambda c: c)
    counts = transactions.groupBy(clean(F.col("transaction_currency")).alias("currency")).agg(
        F.count("*").alias("n")
    )
    known = fx_rates.select(clean(F.col("currency_iso_code")).alias("currency")).distinct()
    marked = known.withColumn("_known", F.lit(True))
    return counts.join(marked, "currency", "left").select(
        "currency", "n", F.coalesce("_known", F.lit(False)).alias("has_rate")
    )


def currency_coverage(
    transactions: DataFrame, fx_rates: DataFrame, trim: bool = False
) -> DataFrame:
    """One row: distinct codes on both sides, codes without a rate, transactions affected."""
    clean = F.trim if trim else (lambda c: c)
    for df, column, name in (
        (transactions, "transaction_currency", "transactions"),
        (fx_rates, "currency_iso_code", "fx_rates"),
    ):
        if column not in df.columns:
            raise ValueError(f"Column '{column}' does not exist in table '{name}'")
    codes = _currencies(transactions, fx_rates, trim)
    rated = (
        fx_rates.select(clean(F.col("currency_iso_code")).alias("c"))
        .distinct()
        .agg(F.count("*"))
        .scalar()
    )
    # Missing currencies are a row of their own, so the rows hold all transactions.
    lacking = F.col("currency").isNotNull() & ~F.col("has_rate")
    summary = codes.agg(
        F.count("currency").alias("distinct_transaction_currencies"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        F.count_if(lacking).alias("missing_currency_count"),
        F.coalesce(F.sum(F.when(lacking, F.col("n"))), F.lit(0)).alias(
            "transactions_with_missing_fx"
        ),
    ).withColumn("distinct_fx_currencies", rated)
    share = percent(F.col("transactions_with_missing_fx"), F.col("total_transactions"))
    return summary.select(
        "distinct_transaction_currencies",
        "distinct_fx_currencies",
        "missing_currency_count",
        "total_transactions",
        "transactions_with_missing_fx",
        F.coalesce(share, F.lit(0.0)).alias("missing_fx_percentage"),
        (F.col("missing_currency_count") == 0).alias("currency_coverage_valid"),
    )
