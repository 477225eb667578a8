"""Daily merges, checks observed while writing, and layers joined bucket by bucket."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

from clearledger.operators import observed
from clearledger.operators.checks import Check, CheckFailed
from clearledger.plans import incremental, reporting, storage
from clearledger.workload import queries as workload

TRANSACTIONS = (
    "transaction_id long, account_id long, transaction_date date, transaction_amount double, transaction_currency string"
)


@pytest.fixture(scope="module")
def dimensions(spark):
    return {
        "accounts": spark.createDataFrame([(i, i % 7) for i in range(20)], "account_id long, customer_id long"),
        "fx_rates": spark.createDataFrame([("USD", 0.5), ("GBP", 1.25)], "currency_iso_code string, fx_rate double"),
        "customers": spark.createDataFrame([(i, i % 3) for i in range(5)], "customer_id long, branch_id long"),
    }


def some(spark, days, offset=0, n=60):
    """Transactions of days (None: no date); a third of them on one account."""
    rows = [
        (offset + i, 3 if i % 3 == 0 else i % 25, day and dt.date(2024, 1, day), i / 4, ["EUR", "USD", "GBP", None][i % 4])
        for day in days
        for i in range(n)
    ]
    return spark.createDataFrame(rows, TRANSACTIONS)


def files(folder: Path) -> dict[str, set[str]]:
    """The data files of each partition of the report."""
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in folder.glob("report/period=*")}


def same(left, right) -> bool:
    return compare.spark_result(left.select(sorted(left.columns))) == compare.spark_result(right.select(sorted(right.columns)))


def test_daily_merges_equal_a_full_refresh_and_touch_only_their_days(spark, dimensions, tmp_path):
    table = incremental.DailySummary(str(tmp_path))
    loads = [some(spark, [1, 2]), some(spark, [3], 1_000), some(spark, [4, 2, None], 2_000, 31)]
    everything = None
    for i, load in enumerate(loads):
        before = files(tmp_path)
        touched = {r.period for r in table.add(load, f"day{i}", **dimensions).collect()}
        after = files(tmp_path)
        everything = load if everything is None else everything.union(load)
        full = reporting.customer_transactions_summary(everything, dimensions["accounts"], dimensions["fx_rates"], dimensions["customers"])
        assert same(table.report(spark), full)
        for name, held in before.items():
            assert (held == after[name]) == (name.removeprefix("period=") not in touched)
    assert touched == {"2024-01-04", "2024-01-02", incremental.NO_DATE}


def test_a_load_run_again_replaces_what_it_gave(spark, dimensions, tmp_path):
    table = incremental.DailySummary(str(tmp_path), grain="month")
    table.add(some(spark, [1, 2]), "a", **dimensions)
    table.add(some(spark, [2, None], 500), "b", **dimensions)
    first = compare.spark_result(table.report(spark))
    table.add(some(spark, [2, None], 500), "b", **dimensions)
    assert compare.spark_result(table.report(spark)) == first
    table.add(some(spark, [2], 500), "b", **dimensions)  # its rows without a date were a mistake
    kept = some(spark, [1, 2]).union(some(spark, [2], 500))
    assert same(table.report(spark), reporting.customer_transactions_summary(kept, **{k: dimensions[k] for k in ("accounts", "fx_rates", "customers")}))
    table.add(some(spark, []), "b", **dimensions)
    table.add(some(spark, []), "a", **dimensions)
    assert table.report(spark).count() == 0


def test_changed_rates_come_with_a_rebuild_from_the_sums(spark, dimensions, tmp_path):
    table = incremental.DailySummary(str(tmp_path))
    rows = some(spark, [1, 2])
    table.add(rows, "a", **dimensions)
    changed = dimensions | {"fx_rates": spark.createDataFrame([("USD", 2.0)], "currency_iso_code string, fx_rate double")}
    one = spark.createDataFrame([("2024-01-01",)], "period string")
    table.rebuild(spark, **changed, periods=one)
    of = lambda d, day: reporting.customer_transactions_summary(
        rows.where(F.dayofmonth("transaction_date") == day), d["accounts"], d["fx_rates"], d["customers"]
    )
    assert same(table.report(spark), of(changed, 1).union(of(dimensions, 2)))
    table.rebuild(spark, **changed)
    assert same(table.report(spark), of(changed, 1).union(of(changed, 2)))


def test_a_merge_reads_only_touched_periods(spark, dimensions, tmp_path):
    table = incremental.DailySummary(str(tmp_path))
    table.add(some(spark, [1, 2, 3]), "a", **dimensions)
    wanted = spark.createDataFrame([("2024-01-02",)], "period string")
    sums = table._of(table.partials(spark), wanted)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "2024-01-02" in plan
    assert {Path(f).parent.parent.name for f in sums.inputFiles()} <= {f"period=2024-01-0{i}" for i in (1, 2, 3)}
    assert sums.where("_transactions > 0").select("transaction_date").distinct().count() == 1


# --- observed checks ----------------------------------------------------------------------------

PEOPLE = "id long, age int, kind string, born date"
ROWS = [(1, 20, "a", dt.date(1999, 1, 1)), (2, None, "b", None), (2, 300, "c", dt.date(2090, 1, 1)), (None, -5, None, None)]
CHECKS = [
    Check("people", "not_null", ("id",)),
    Check("people", "unique", ("id",)),
    Check("people", "numeric_range", ("age",), {"min": 0, "max": 200}),
    Check("people", "accepted_values", ("kind",), {"values": ["a", "b"]}),
    Check("people", "date_is_past", ("born",)),
    Check("people", "is_bool", ("age",)),
    Check("others", "not_null", ("id",)),
]
FAILURES = {"not_null": 1, "unique": 1, "numeric_range": 2, "accepted_values": 1, "date_is_past": 1, "is_bool": 2}


def test_row_checks_are_counted_by_the_write(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    people = spark.createDataFrame(ROWS, PEOPLE).mapInArrow(seen, PEOPLE)
    rows, results = observed.write_observed(people, str(tmp_path / "t"), CHECKS[:6], as_of="2024-01-01")
    assert reads.value == len(ROWS)  # the checks cost no further scan
    assert rows.count() == len(ROWS)
    assert {r[2]: r[3] for r in results} == {k: n for k, n in FAILURES.items() if k != "unique"}
    assert compare.spark_result(observed.results_frame(spark, results).select("check", "passed"))[1] == sorted(
        (k, False) for k in FAILURES if k != "unique"
    )


def test_counts_of_an_empty_layer(spark, tmp_path):
    _, results = observed.write_observed(spark.createDataFrame([], PEOPLE), str(tmp_path / "t"), CHECKS[:6])
    assert len(results) == 5 and all(r[4] for r in results)


def test_a_failing_layer_is_not_published(spark):
    good = spark.createDataFrame(ROWS[:1], PEOPLE)
    bad = spark.createDataFrame(ROWS, PEOPLE)
    twice = spark.createDataFrame([ROWS[0], ROWS[0]], PEOPLE)
    spark.sql("DROP DATABASE IF EXISTS guarded CASCADE")
    kinds = lambda *names: (lambda c: c.kind in names)
    strict = [c for c in CHECKS if c.kind != "is_bool"]
    table, results = observed.publish_checked(good, "people", "guarded", strict, as_of="2024-01-01")
    assert table.count() == 1 and all(r[4] for r in results) and len(results) == 5
    for df, told in ((bad, "not_null(id): 1"), (twice, "unique(id): 1")):
        with pytest.raises(CheckFailed, match=told.replace("(", r"\(").replace(")", r"\)")):
            observed.publish_checked(df, "people", "guarded", strict, as_of="2024-01-01")
        assert [r.name for r in spark.catalog.listTables("guarded")] == ["people"]
        assert spark.table("guarded.people").count() == 1
    table, results = observed.publish_checked(bad, "people", "guarded", CHECKS, as_of="2024-01-01", blocking=kinds())
    assert table.count() == 4 and {r[2]: r[3] for r in results} == FAILURES
    with pytest.raises(CheckFailed):
        observed.publish_checked(twice, "people", "guarded", CHECKS, as_of="2024-01-01", blocking=kinds("unique"))
    assert spark.table("guarded.people").count() == 4


def test_relationships_block_too(spark):
    parents = spark.createDataFrame([(1,)], "k long")
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    check = [Check("child", "relationships", ("k",), {"to": "parents", "field": "k"})]
    with pytest.raises(CheckFailed, match="relationships"):
        observed.publish_checked(child, "child", "guarded", check, {"parents": parents})
    assert not spark.catalog.tableExists("guarded.child")


# --- buckets ------------------------------------------------------------------------------------


def test_bucketed_layers_are_joined_without_an_exchange(spark, dimensions, tmp_path):
    rows = some(spark, [1, 2, None])
    layers = storage.bucket_layers(rows, dimensions["accounts"], dimensions["customers"], "bucketed", 5, str(tmp_path))
    full = reporting.customer_transactions_summary(rows, dimensions["accounts"], dimensions["fx_rates"], dimensions["customers"])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = layers.summary(dimensions["fx_rates"])
        plan = report._jdf.queryExecution().executedPlan().toString()
        plan = plan[: plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert "Exchange hashpartitioning" in full._jdf.queryExecution().executedPlan().toString()
        assert same(report, full)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(list((tmp_path / "account_days").glob("*.parquet"))) <= 5
    # written again: the old rows are gone
    again = storage.bucket_layers(rows.limit(0), dimensions["accounts"], dimensions["customers"], "bucketed", 5, str(tmp_path))
    assert again.summary(dimensions["fx_rates"]).count() == 0


def test_queries_of_the_stored_forms_equal_the_plain_one(spark, small):
    plain = compare.spark_result(workload.customer_transactions_summary(spark, small))
    for name in ("summary_daily_merge", "summary_from_buckets"):
        assert compare.spark_result(workload.QUERIES[name](spark, small)) == plain


def test_periods_are_rebuilt_in_tasks_that_follow_their_sums(spark, tmp_path, monkeypatch):
    day, k = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")), F.col("id")
    rows = spark.range(2000).select(
        (k % 300).alias("account_id"),
        day.alias("transaction_date"),
        F.lit("EUR").alias("transaction_currency"),
        (k % 97).cast("double").alias("transaction_amount"),
    )
    inputs = {
        "accounts": spark.range(300).select(k.alias("account_id"), (k % 40).alias("customer_id")),
        "fx_rates": spark.createDataFrame([("USD", 0.5)], "currency_iso_code string, fx_rate double"),
        "customers": spark.range(40).select(k.alias("customer_id"), (k % 3).cast("int").alias("branch_id")),
    }
    asked, real = [], incremental.price_and_group

    def noted(*args, tasks=None):
        asked.append(tasks)
        return real(*args, tasks=tasks)

    monkeypatch.setattr(incremental, "price_and_group", noted)
    reports = []
    for share in (10_000, 10):
        monkeypatch.setattr(incremental, "TASK_SUMS", share)
        table = incremental.DailySummary(str(tmp_path / str(share)), grain="month")
        table.add(rows, "one", **inputs)
        reports.append(sorted(map(str, table.report(spark).collect())))
    assert reports[0] == reports[1]
    held = table.partials(spark).count()
    assert asked == [None, -(-held // 10)]
