"""Layers, catalogue and files."""

from __future__ import annotations

import re

import compare
import pytest
from pyspark.sql import functions as F

from clearledger.operators import checks, observed
from clearledger.plans import reporting, warehouse
from clearledger.plans.suite import SUITE
from clearledger.sources import catalog, tables
from clearledger.workload import raw_feeds
from clearledger.workload.queries import QUERIES


def test_pipeline_writes_layers_and_rewrites_them(spark, small):
    raw = {n: getattr(raw_feeds, f"raw_{n}")(spark, small) for n in warehouse.RAW_TABLES}
    for _ in range(2):
        models = warehouse.build_warehouse(raw, " intermediate ", "reporting")
    databases = {r.schema_name for r in catalog.list_databases(spark).collect()}
    assert {"intermediate", "reporting"} <= databases
    names = [r.table_name for r in catalog.list_tables(spark, "intermediate").collect()]
    assert names == sorted(n for n in models if n.startswith("int_"))
    summary = spark.table("reporting.customer_transactions_summary")
    lazy = QUERIES["customer_transactions_summary"](spark, small)
    assert summary.count() == lazy.count() > 0
    columns = catalog.table_columns(spark, "intermediate", "int_accounts").collect()
    assert [(c.column_name, c.data_type) for c in columns] == [
        ("account_id", "bigint"),
        ("customer_id", "bigint"),
        ("account_type", "string"),
        ("account_opening_date", "date"),
    ]
    assert catalog.schema_columns(spark, "reporting").count() == 6
    catalog.drop_table(spark, "reporting", "customer_transactions_summary")
    assert catalog.list_tables(spark, "reporting").count() == 0


def test_database_names():
    assert warehouse.database_for(None, "main") == "main"
    assert warehouse.database_for(" raw ") == "raw"


def test_delimited_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "currencies.csv"
    path.write_bytes("﻿currency;currency_iso_code\nEuro;EUR\nOld; (none) \n".encode())
    schema = "currency string, currency_iso_code string"
    got = tables.read_delimited(spark, str(path), schema)
    assert sorted(map(tuple, got.collect())) == [("Euro", "EUR"), ("Old", " (none) ")]


def test_seed_becomes_a_table(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("currency,currency_iso_code\nEuro,EUR\n")
    seed = tables.load_seed(
        spark, str(path), "seed_currencies", "currency string, currency_iso_code string"
    )
    assert [tuple(r) for r in seed.collect()] == [("Euro", "EUR")]
    spark.sql("DROP TABLE seed_currencies")


def test_sample_limits(spark):
    df = spark.range(10)
    assert tables.table_sample(df).count() == tables.table_sample(df, 0).count() == 10
    assert [r.id for r in tables.table_sample(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_catalogue_as_json_and_naming(spark, small, tmp_path):
    feeds = {"customers": raw_feeds.raw_customers(spark, small)}
    entries = catalog.present_counts(feeds)
    catalog.write_catalogue(entries, str(tmp_path / "catalogue"))
    assert spark.read.json(str(tmp_path / "catalogue")).count() == 11
    found = {r.column_name for r in catalog.columns_with_capitals(entries).collect()}
    assert found == {"Age", "Gender", "Address", "City", "Contact Number", "Email"}


def test_data_catalogue_of_written_warehouse(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS catalogued")
    spark.sql("DROP TABLE IF EXISTS catalogued.t")
    spark.sql("CREATE TABLE catalogued.t (k BIGINT COMMENT 'the key', v STRING) USING parquet COMMENT 'a table'")
    spark.sql("CREATE OR REPLACE VIEW catalogued.w AS SELECT k FROM catalogued.t")
    got = [tuple(r) for r in catalog.data_catalogue(spark, ["catalogued"]).collect()]
    assert got == [
        ("catalogued", "t", "BASE TABLE", "a table", "k", "bigint", "the key", 1),
        ("catalogued", "t", "BASE TABLE", "a table", "v", "string", None, 2),
        ("catalogued", "w", "VIEW", None, "k", "bigint", "the key", 1),
    ]


def test_explore_tables(spark):
    found = catalog.explore_tables({"a": spark.range(7).coalesce(1), "b": spark.range(0)}, 2)
    got = sorted((r.table_name, r.row_count, r.place or 0, r.row) for r in found.collect())
    assert got == [("a", 7, 1, '{"id":0}'), ("a", 7, 2, '{"id":1}'), ("b", 0, 0, None)]


def test_run_sql(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert tables.run_sql(spark, "SELECT sum(id) AS s FROM five").first().s == 10


def test_suite_is_the_declared_one():
    from collections import Counter

    from clearledger.plans.suite import SUITE
    from clearledger.workload.oracles import declared

    assert sorted((c.model, c.column, c.kind) for c in SUITE) == sorted(d[:3] for d in declared())
    assert len(SUITE) == 78
    assert Counter(c.model for c in SUITE) == {
        "stg_accounts": 7, "stg_customers": 5, "stg_fx_rates": 6, "stg_loans": 14,
        "stg_transactions": 6, "int_accounts": 6, "int_customers": 3, "int_fx_rates": 6,
        "int_loans": 12, "int_transactions": 4, "int_currencies": 2,
        "customer_transactions_summary": 7,
    }


def test_shared_folder_comes_from_the_session(spark):
    assert tables.shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_flagship_plan(spark, small):
    plan = QUERIES["customer_transactions_summary"](spark, small)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    scan = next(line for line in physical.splitlines() if "lineitem.parquet" in line)
    assert "l_tax" not in scan and "l_partkey" not in scan
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_plans_a_cross_join(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_compare_notices_differences():
    assert compare.normal_rows(["b", "a"], [(1, 2)]) == [(2, 1)]
    assert compare.normal_rows(["a"], [(1.0000000000001,)]) == compare.normal_rows(["a"], [(1.0,)])
    assert compare.normal_rows(["a"], [(1,)]) != compare.normal_rows(["a"], [(2,)])


def banking_rows(spark, folder):
    """Transactions in a file, with a hot account, missing and unknown accounts and repeated rows, and
    accounts, rates and customers, of which one account and one customer come twice."""
    n, k = 3000, F.col("id")
    spark.range(n).select(
        k.alias("transaction_id"),
        F.when(k % 3 == 0, 7).when(k % 50 == 1, F.lit(None)).otherwise(k % 400).cast("long").alias("account_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 40).cast("int")).alias("transaction_date"),
        F.element_at(F.array(F.lit("EUR"), F.lit("USD"), F.lit("XXX")), (k % 3 + 1).cast("int")).alias(
            "transaction_currency"
        ),
        F.when(k % 17 != 0, (k % 1000).cast("double")).alias("transaction_amount"),
    ).coalesce(1).write.parquet(f"{folder}/transactions")
    accounts = spark.range(390).select(k.alias("account_id"), F.when(k % 9 != 0, k % 50).alias("customer_id"))
    customers = spark.range(45).select(k.alias("customer_id"), (k % 5).cast("int").alias("branch_id"))
    return {
        "transactions": spark.read.parquet(f"{folder}/transactions"),
        "accounts": accounts.unionByName(accounts.where("account_id = 11")),
        "fx_rates": spark.createDataFrame([("USD", 0.5)], "currency_iso_code string, fx_rate double"),
        "customers": customers.unionByName(customers.where("customer_id = 12")),
    }


def dealt_by_account(df) -> set[int]:
    """The numbers of partitions that plans deal rows by account to."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {int(n) for n in re.findall(r"hashpartitioning\(account_id#\d+L?, (\d+)\)", plan)}


def test_account_join_is_dealt_by_the_size_of_the_files(spark, tmp_path, monkeypatch):
    rows = banking_rows(spark, tmp_path)
    whole = reporting.customer_transactions_summary(**rows)
    assert tables.tasks_for(rows["transactions"]) is None
    assert tables.tasks_for(rows["accounts"]) is None  # from no file
    before = sorted(map(str, whole.collect()))
    for tasks in (20, 40):
        monkeypatch.setattr(tables, "TASK_BYTES", -(-tables.file_bytes(rows["transactions"]) // tasks))
        finer = reporting.customer_transactions_summary(**rows)
        assert dealt_by_account(finer) >= {tables.tasks_for(rows["transactions"])}
        assert tables.tasks_for(rows["transactions"]) in (tasks - 1, tasks)
        assert sorted(map(str, finer.collect())) == before


def test_keys_of_a_finely_dealt_report_are_checked_in_its_tasks(spark, tmp_path, monkeypatch):
    rows = banking_rows(spark, tmp_path)
    keys = ["transaction_date", "customer_id", "account_id", "branch_id"]
    before = sorted(map(str, checks.unique_combination(reporting.customer_transactions_summary(**rows), keys).collect()))
    monkeypatch.setattr(tables, "TASK_BYTES", -(-tables.file_bytes(rows["transactions"]) // 20))
    summary = reporting.customer_transactions_summary(**rows)
    found = checks.unique_combination(summary, keys)
    assert dealt_by_account(found) >= {tables.tasks_for(rows["transactions"])}
    assert sorted(map(str, found.collect())) == before


def test_bytes_of_files_with_odd_names(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    spark.range(10).write.parquet(str(folder))
    written = sum(f.stat().st_size for f in folder.glob("*.parquet"))
    assert tables.file_bytes(spark.read.parquet(str(folder))) == written > 0
    assert tables.file_bytes(spark.range(3)) == 0


def test_observed_report_is_dealt_by_the_size_of_its_layer(spark, tmp_path, monkeypatch):
    rows = banking_rows(spark, tmp_path)
    layers = {f"int_{name}": df for name, df in rows.items()}
    name = "customer_transactions_summary"
    own = [c for c in SUITE if c.model == name]
    written, whole = observed.write_observed(warehouse.reporting_models(layers)[name], f"{tmp_path}/whole", own)
    monkeypatch.setattr(tables, "TASK_BYTES", -(-tables.file_bytes(rows["transactions"]) // 20))
    report = warehouse.reporting_models(layers)[name]
    assert dealt_by_account(report) >= {tables.tasks_for(rows["transactions"])}
    again, finer = observed.write_observed(report, f"{tmp_path}/finer", own)
    assert finer == whole and any(r[3] > 0 for r in whole)
    assert sorted(map(str, again.collect())) == sorted(map(str, written.collect()))


def test_suite_over_a_finely_dealt_report(spark, tmp_path, monkeypatch):
    rows = banking_rows(spark, tmp_path)
    name = "customer_transactions_summary"
    own = [c for c in SUITE if c.model == name]
    whole = checks.check_suite_summary(own, {name: reporting.customer_transactions_summary(**rows)})
    before = sorted(map(str, whole.collect()))
    monkeypatch.setattr(tables, "TASK_BYTES", -(-tables.file_bytes(rows["transactions"]) // 20))
    finer = checks.check_suite_summary(own, {name: reporting.customer_transactions_summary(**rows)})
    assert dealt_by_account(finer) >= {tables.tasks_for(rows["transactions"])}
    assert sorted(map(str, finer.collect())) == before
