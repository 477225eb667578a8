"""Operators against brute force on small fixtures with skewed, missing and planted values."""

from __future__ import annotations

import datetime as dt
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearledger.operators import (
    checks,
    extracts,
    ids,
    joins,
    outliers,
    profile,
    quality,
    quantiles,
    relationships,
    sampling,
)
from clearledger.plans import reporting


def column(df, name="value"):
    return [r[name] for r in df.collect()]


def by_key(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


PROBABILITIES = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "top": 1.0}


def skewed_values(kind: str, n: int) -> list[float | None]:
    rng = random.Random(7)
    if kind == "one value holds a third":
        return [5.0 if i % 3 == 0 else rng.gauss(0, 100) for i in range(n)]
    if kind == "heavy tail":
        return [rng.paretovariate(0.5) for _ in range(n)]
    if kind == "constant":
        return [4.0] * n
    return [None if i % 5 == 0 else (float("nan") if i % 7 == 0 else float(i)) for i in range(n)]


@pytest.mark.parametrize(
    "kind", ["one value holds a third", "heavy tail", "constant", "missing values"]
)
@pytest.mark.parametrize("n", [1, 2, 7, 60_000])
def test_exact_quantiles(spark, kind, n):
    values = skewed_values(kind, n)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    present = [v for v in values if v is not None and v == v]
    got = quantiles.exact_quantiles(df, ["v"], PROBABILITIES, accuracy=1000).collect()
    if not present:
        assert got == []
        return
    for name, p in PROBABILITIES.items():
        assert got[0][name] == pytest.approx(np.quantile(present, p), rel=1e-12), name


def test_exact_quantiles_of_unequal_groups(spark):
    rng = random.Random(3)
    rows = [("hot", rng.random()) for _ in range(40_000)]
    rows += [(f"g{i % 50}", rng.gauss(i % 50, 1)) for i in range(5_000)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = by_key(quantiles.exact_quantiles(df, ["v"], {"m": 0.5}, ["g"], accuracy=1000), "g")
    expected = pd.DataFrame(rows, columns=["g", "v"]).groupby("g").v.median()
    assert set(got) == set(expected.index)
    for g, m in expected.items():
        assert got[g]["m"] == pytest.approx(m)


def test_profile_of_known_series(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    (row,) = profile.profile_numeric(df).collect()
    assert (row.q1, row["median"], row.q3) == (2, 3, 4)
    assert row["std"] == pytest.approx(43.617657)
    assert row["skew"] == pytest.approx(2.232396, abs=1e-6)
    (fences,) = outliers.outliers_iqr(df).collect()
    assert (fences.lower_bound, fences.upper_bound, fences.outliers_count) == (-1, 7, 1)
    assert column(outliers.iqr_outlier_values(df)) == [100.0]


def test_profile_skips_columns_without_values_and_constant_skew(spark):
    df = spark.createDataFrame([(None, 2.0)] * 4, "empty double, same double")
    got = by_key(profile.profile_numeric(df))
    assert set(got) == {"same"} and got["same"]["skew"] == 0.0
    counts = by_key(profile.profile_counts(df))
    assert counts["empty"]["all_missing"] and counts["empty"]["missing_percentage"] == 100.0
    assert by_key(outliers.outliers_zscore(df))["same"]["z_score_outliers_count"] == 0


def test_counts_treat_nan_as_missing_and_approximate_agrees(spark):
    values = [1.0, float("nan"), None, 0.0, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = by_key(profile.profile_counts(df))["v"]
    assert (exact["count"], exact["missing"], exact["unique_values"]) == (5, 2, 2)
    assert by_key(profile.profile_counts(df, approx=True))["v"] == exact
    assert profile.total_missing(df).first().missing_cells == 2


def test_mad_outliers_and_zero_deviation(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(50)] + [dt.date(1950, 1, 1)]
    df = spark.createDataFrame([(d, dt.date(2020, 1, 1)) for d in days], "d date, same date")
    got = by_key(outliers.outliers_mad_dates(df))
    assert got["d"]["datetime_outliers_count"] == 1
    assert got["same"]["datetime_outliers_count"] is None
    assert column(outliers.mad_outlier_dates(df, "d"), "date") == [dt.date(1950, 1, 1)]
    assert outliers.mad_outlier_dates(df, "same").count() == 0


def test_rare_categories_need_more_than_one_category(spark):
    df = spark.createDataFrame([("a", "x")] * 199 + [("b", "x")], "c string, one string")
    got = [(r["column"], r.value, r.n) for r in outliers.rare_categories(df).collect()]
    assert got == [("c", "b", 1)]


def test_composite_duplicates_match_missing_parts(spark):
    rows = [(1, None, "p"), (1, None, "q"), (1, "a", "r"), (2, "a", "s"), (None, "a", "t")]
    df = spark.createDataFrame(rows, "x int, y string, tag string")
    assert sorted(column(ids.composite_key_duplicates(df, ["x", "y"]), "tag")) == ["p", "q"]
    assert ids.composite_key_summary(df, ["x", "y"]).first().duplicate_records_count == 2


def test_dedupe_keeps_last_of_a_hot_key(spark):
    rows = [("hot", i) for i in range(1000)] + [(f"k{i}", i) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(6)
    kept = {r.k: r.o for r in ids.dedupe_keep_last(df, ["k"], ["o"]).collect()}
    assert kept == {"hot": 999, **{f"k{i}": i for i in range(10)}}
    assert ids.repeat_count(df, ["k"]).first().repeats == 999


@pytest.mark.parametrize(
    ("values", "rising", "falling", "unique"),
    [
        (list(range(500)), True, False, True),
        (list(range(500, 0, -1)), False, True, True),
        ([1] * 500, True, True, False),
        ([1, 2, 3, 2, 5] * 100, False, False, False),
        (list(range(250)) + [100] + list(range(251, 500)), False, False, False),
        ([None, *range(499)], False, False, True),
    ],
)
def test_id_properties(spark, values, rising, falling, unique):
    rows = list(enumerate(values))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "o int, v int").repartition(4)
    row = ids.id_properties(df, "v", "o").first()
    assert (row.is_monotonic_inc, row.is_monotonic_dec) == (rising, falling)
    assert row.is_unique == unique and row.is_monotonic == (rising or falling)


def test_id_report_detects_columns_and_names_absent_ones(spark):
    rows = [(i // 2, f"n{i}", "x") for i in range(40)]
    df = spark.createDataFrame(rows, "customer_id int, name string, constant string")
    assert ids.detect_id_columns(df) == ["customer_id", "name"]
    got = by_key(ids.id_duplicates(df, ["customer_id", "nope"]))
    assert got["customer_id"]["records_with_duplicates"] == 40
    assert got["nope"]["error"] == "Column 'nope' not found"
    for limit, more in ((10, True), (40, False)):
        listed = ids.listed_duplicates(df, "customer_id", ["customer_id", "name"], limit).collect()
        assert len(listed) == limit and all(r.truncated == more for r in listed)
        assert [(r.customer_id, r.name) for r in listed] == sorted((r[0], r[1]) for r in rows)[:limit]


def test_foreign_keys_with_hot_missing_and_repeated_keys(spark):
    child = spark.createDataFrame([(1,)] * 300 + [(2,), (9,), (None,)], "k int").repartition(4)
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id int")
    r = relationships.Relationship("p", "id", "c", "k")
    row = relationships.fk_report(child, parent, r).first()
    assert (row.parent_record_count, row.child_record_count) == (4, 303)
    assert (row.non_null_foreign_keys, row.orphaned_records) == (302, 1)
    assert column(relationships.fk_orphans(child, "k", parent, "id"), "k") == [9]
    broken = relationships.Relationship("p", "nope", "c", "k")
    report = relationships.check_all_relationships({"p": parent, "c": child}, (r, broken))
    assert [x.error for x in report.collect()] == [None, "Column 'nope' does not exist in table 'p'"]


def test_currency_codes_are_compared_untrimmed_by_default(spark):
    tx = spark.createDataFrame([("EUR",), (" USD",), ("XXX",), (None,)], "transaction_currency string")
    fx = spark.createDataFrame([("EUR",), ("USD",)], "currency_iso_code string")
    assert relationships.currency_coverage(tx, fx).first().missing_currency_count == 2
    assert relationships.currency_coverage(tx, fx, trim=True).first().missing_currency_count == 1


def test_checks_at_their_bounds(spark):
    df = spark.createDataFrame(
        [(1, "a", dt.date(2020, 1, 1)), (18, "b", dt.date(2020, 1, 2)), (None, None, None)],
        "n int, c string, d date",
    )
    assert column(checks.numeric_range(df, "n", min=18), "n") == [1]
    assert column(checks.numeric_range(df, "n", min=1, max=18), "n") == []
    assert checks.numeric_range(df, "n").count() == 0
    assert column(checks.date_is_past(df, "d", as_of="2020-01-01"), "d") == [dt.date(2020, 1, 2)]
    assert column(checks.accepted_values(df, "c", ["a"])) == ["b"]
    assert checks.not_null(df, "c").count() == 1
    assert column(checks.is_bool(df.withColumn("n", F.col("n") - 1), "n"), "test_field") == [17]


def test_suite_can_stop_at_the_first_failure(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    suite = [checks.Check("m", checks.NOT_NULL, ("k",)), checks.Check("m", checks.UNIQUE, ("k",))]
    got = {r.check: r.failures for r in checks.run_checks(suite, {"m": df}).collect()}
    assert got == {"not_null": 0, "unique": 1}
    with pytest.raises(checks.CheckFailed, match="unique"):
        checks.run_checks(suite, {"m": df}, fail_fast=True)


def ledger(spark):
    """One account holding most transactions, repeated parents, a missing rate and branch."""
    rng = random.Random(5)
    tx = []
    for i in range(3000):
        account = 1 if i % 3 else rng.choice([2, 3, 4, 99])
        tx.append(
            (i, dt.date(2024, 1, 1 + i % 5), account, float(i % 50), rng.choice(["EUR", "USD", "ZZZ"]))
        )
    transactions = spark.createDataFrame(
        tx,
        "transaction_id int, transaction_date date, account_id int, transaction_amount double,"
        " transaction_currency string",
    ).repartition(5)
    accounts = spark.createDataFrame(
        [(1, 10), (2, 10), (2, 10), (3, 11), (4, None)], "account_id int, customer_id int"
    )
    rates = spark.createDataFrame(
        [("EUR", 5.0), ("USD", 0.5), ("USD", 0.25)], "currency_iso_code string, fx_rate double"
    )
    customers = spark.createDataFrame(
        [(10, 7), (10, 8), (11, None)], "customer_id int, branch_id int"
    )
    return transactions, accounts, rates, customers


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_summary_equals_joining_single_transactions(spark, broadcast_rows):
    transactions, accounts, rates, customers = ledger(spark)
    got = reporting.customer_transactions_summary(
        transactions, accounts, rates, customers, broadcast_rows
    )
    for name, df in (("t", transactions), ("a", accounts), ("f", rates), ("c", customers)):
        df.createOrReplaceTempView(f"ledger_{name}")
    expected = spark.sql(
        """SELECT transaction_date, a.customer_id, t.account_id,
        coalesce(cast(c.branch_id AS string), 'Unknown') AS branch_id,
        sum(CASE WHEN transaction_currency = 'EUR' THEN transaction_amount
            ELSE transaction_amount * coalesce(fx_rate, 1.0) END) AS total_amount_eur,
        count(*) AS total_transactions
        FROM ledger_t t JOIN ledger_a a ON t.account_id = a.account_id
        LEFT JOIN ledger_f f ON transaction_currency = currency_iso_code
        LEFT JOIN ledger_c c ON a.customer_id = c.customer_id GROUP BY 1, 2, 3, 4"""
    )
    key = lambda r: (r.transaction_date, r.customer_id, r.account_id, r.branch_id)
    want = {key(r): (r.total_amount_eur, r.total_transactions) for r in expected.collect()}
    have = {key(r): (r.total_amount_eur, r.total_transactions) for r in got.collect()}
    assert have.keys() == want.keys()
    for k in want:
        assert have[k][0] == pytest.approx(want[k][0]) and have[k][1] == want[k][1]


def test_salted_lookup_equals_broadcast_lookup(spark):
    transactions, _, rates, _ = ledger(spark)
    small = reporting.transactions_in_eur(transactions, rates)
    large = reporting.transactions_in_eur(transactions, rates, broadcast_rows=0)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    assert joins.has_at_most(rates, 3) and not joins.has_at_most(rates, 2)


def test_kde_matches_direct_evaluation(spark):
    rng = random.Random(2)
    rows = [("a", rng.gauss(0, 1)) for _ in range(400)] + [("a", 0.5)] * 200 + [("b", 1.0)]
    df = spark.createDataFrame(rows, "c string, v double")
    got = sorted((r.x, r.density) for r in extracts.kde_by_category(df, "v", "c").collect())
    values = np.array([v for c, v in rows if c == "a"])
    bw = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min() - 3 * bw, values.max() + 3 * bw, 200)
    z = (grid[:, None] - values[None, :]) / bw
    density = np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * bw * np.sqrt(2 * np.pi))
    assert [x for x, _ in got] == pytest.approx(list(grid))
    assert [d for _, d in got] == pytest.approx(list(density), abs=1e-12)
    assert extracts.kde_by_category(df, "v").count() == 200


def test_category_codes_beyond_one_task(spark):
    names = [f"c{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names * 3] + [(None,)], "c string").repartition(4)
    want = {n: i for i, n in enumerate(names)}
    for limit in (100_000, 10):
        got = {r.category: r.code for r in extracts.category_codes(df, "c", limit).collect()}
        assert got == want
    points = extracts.scatter_points(df.withColumn("y", F.lit(1)), "y", "y", "c")
    assert points.filter("category IS NULL").first().code == -1


def test_correlation_needs_two_columns_and_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, None), (4.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r.column_a, r.column_b): r.correlation for r in extracts.correlation_matrix(df).collect()}
    assert got[("a", "b")] == pytest.approx(pd.DataFrame(rows).corr().iloc[0, 1])
    assert got[("b", "a")] == got[("a", "b")]
    assert extracts.correlation_matrix(df, ["a", "nope"]).count() == 0


def test_histogram_of_constant_and_missing_columns(spark):
    df = spark.createDataFrame([(3.0, None)] * 4, "v double, e double")
    bins = extracts.histogram_numeric(df, "v", 4).orderBy("bin").collect()
    assert [b.n for b in bins] == [0, 0, 4, 0] and bins[0].low == 2.5
    assert extracts.histogram_numeric(df, "e").count() == 0


def test_shares_group_the_rest(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbcd"], "c string")
    got = {r.category: r.n for r in extracts.category_shares(df, "c", 2).collect()}
    assert got == {"a": 3, "b": 2, "Other": 2}
    assert "Other" not in column(extracts.category_shares(df, "c", 9), "category")


def test_cleaning_detects_converts_and_reports(spark):
    rows = [("1.234,5", "01.02.2020", " x ", "a"), ("7,5", "2020-02-03", "y", "b")] * 3
    df = spark.createDataFrame(rows, "n string, d string, w string, s string")
    cleaned = quality.clean_table(df)
    assert dict(cleaned.dtypes) == {"n": "double", "d": "date", "w": "string", "s": "string"}
    assert set(map(tuple, cleaned.collect())) == {
        (1234.5, dt.date(2020, 2, 1), "x", "a"),
        (7.5, dt.date(2020, 2, 3), "y", "b"),
    }
    summary = {(r["column"], r.kind): r.changed for r in quality.cleaning_summary(df).collect()}
    assert summary == {("n", "numeric"): 6, ("d", "date"): 3, ("w", "whitespace"): 3}


def test_samples_are_repeatable_and_complete_when_few(spark):
    df = spark.createDataFrame([(i % 3, str(i)) for i in range(90)], "few int, many string")
    first, again = (
        Counter((r["column"], r.value) for r in sampling.column_samples(df).collect())
        for _ in range(2)
    )
    assert first == again
    assert {v for c, v in first if c == "few"} == {"0", "1", "2"}
    assert sum(c == "many" for c, _ in first) == 5
    assert set(column(sampling.column_samples(df, dtype_filter="int"), "column")) == {"few"}


def test_date_and_group_statistics_of_empty_and_single_inputs(spark):
    empty = spark.createDataFrame([], "d date, g string")
    assert profile.date_distribution(empty, "d").first()["rows"] == 0
    assert profile.group_size_stats(empty, ["g"]).first().groups == 0
    one = spark.createDataFrame([(dt.date(1970, 1, 3), "a"), (None, None)], "d date, g string")
    row = profile.date_distribution(one, "d", as_of="1970-01-01").first()
    assert (row["rows"], row.missing, row.future_dates, row.mean_days) == (2, 1, 1, 2.0)
    assert row.std_days is None and row.median_days == 2.0
    assert profile.group_size_stats(one, ["g"]).first().groups == 1


# --- hot keys, quantile cells and number of scans -----------------------------------------------


@pytest.fixture
def skewed(spark):
    """A session that splits skewed joins early and does not broadcast."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000)
    return spark.range(0, n, 1, 8).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t"))


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_duplicates_are_split(skewed):
    found = ids.duplicate_records(hot_rows(skewed), "k")
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert "skew=true" in executed(found)
    assert max(sizes) <= 3 * sum(sizes) / 8


def test_rows_beside_many_groups_are_split(skewed, monkeypatch):
    from clearledger.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    rows = hot_rows(skewed)
    joined = joins.beside_groups(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"])
    assert joined.columns == ["k", "id", "t", "n"]
    grouped = joined.groupBy("k", "n").agg(F.count("*").alias("m"))
    assert "skew=true" in executed(grouped)
    assert grouped.filter("n <> m").count() == 0


def test_cells_are_even_by_rank(spark):
    from clearledger.operators import quantiles

    peaks = spark.range(4_000).select(
        F.lit("v").alias("c"), F.when(F.col("id") < 2_000, F.col("id") / 1e6).otherwise(1e9 + F.col("id")).alias("_value")
    )
    celled = quantiles.in_cells(peaks, ["c"], 100)
    sizes = [r["count"] for r in celled.groupBy("_cell").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 4_000
    order = celled.groupBy("_cell").agg(F.min("_value").alias("a"), F.max("_value").alias("b")).orderBy("_cell").collect()
    assert all(x.b < y.a for x, y in zip(order[:-1], order[1:]))


def test_exact_quantiles_through_many_cells(spark, monkeypatch):
    from clearledger.operators import quantiles

    monkeypatch.setattr(quantiles, "CELL_VALUES", 20)
    df = spark.range(3_001).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 1_500, F.col("id")).otherwise(F.col("id") * 1e6).alias("v"))
    rows = df.collect()
    names = {"q1": 0.25, "median": 0.5}
    for by in ([], ["g"]):
        for r in quantiles.exact_quantiles(df, ["v"], names, by).collect():
            own = sorted(x.v for x in rows if not by or x.g == r.g)
            for name, p in names.items():
                at = p * (len(own) - 1)
                low, high = own[int(at)], own[min(int(at) + 1, len(own) - 1)]
                assert abs(r[name] - (low + (at - int(at)) * (high - low))) < 1e-6


def test_reports_scan_their_input_seldom(spark, small):
    from clearledger.workload.queries import QUERIES

    sizes = {n: spark.read.parquet(f"{small}/{n}.parquet").count() for n in ("orders", "lineitem")}
    limits = {
        "profile_numeric": ("orders", 2), "grouped_stats": ("orders", 2), "boxplot_stats": ("orders", 3),
        "outliers_mad_dates": ("orders", 1), "histogram_dates": ("orders", 2),
        "check_suite_summary": ("lineitem", 3),
    }
    for name, (table, scans) in limits.items():
        seen = scanned(spark, lambda: QUERIES[name](spark, small).collect(), f"{table}.parquet")
        assert seen <= scans * sizes[table] * 1.05, (name, seen, sizes[table])


def scanned(spark, run, file):
    """Rows that the scans of a file put out while run() runs, by the plans' own counters."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    total, executions = 0, store.executionsList()
    for i in range(before, store.executionsCount()):
        e = executions.apply(i).executionId()
        values = store.executionMetrics(e)
        nodes = store.planGraph(e).allNodes()
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if node.name().startswith("Scan parquet") and file in node.desc():
                metrics = node.metrics()
                for k in range(metrics.size()):
                    if metrics.apply(k).name() == "number of output rows":
                        value = values.get(metrics.apply(k).accumulatorId())
                        total += int(value.get().replace(",", "")) if value.isDefined() else 0
    return total


@pytest.mark.parametrize("density", [extracts.kde_binned, extracts.kde_by_category])
def test_densities_make_each_value_once_a_pass(spark, density):
    calls = spark.sparkContext.accumulator(0)

    def parsed(text):
        calls.add(1)
        return float(text)

    n = 200
    texts = spark.range(n, numPartitions=2).select(
        F.when(F.col("id") % 10 != 0, F.lit("a")).alias("kind"), (F.col("id") % 7).cast("string").alias("text")
    )
    numbers = texts.select("kind", F.udf(parsed, "double")("text").alias("v"))
    assert density(numbers, "v", "kind", grid=20).count() == 20
    assert calls.value <= 2 * n  # spread first, then the densities


def test_densities_of_a_column_named_category(spark):
    df = spark.createDataFrame([(float(i % 9), "x") for i in range(40)], "category double, kind string")
    assert {r["category"] for r in extracts.kde_binned(df, "category", "kind", grid=20).collect()} == {"x"}
    assert extracts.kde_by_category(df, "category", grid=20).count() == 20


def test_date_report_strips_only_texts_with_a_date(spark):
    rows = [(" 2024-01-02\t", "x 1.2.2024"), (" 03/04/2024", " padded "), (None, "2024-1-1"), ("12345,67", "3.4.2024")]
    df = spark.createDataFrame(rows, "a string, b string")
    report = quality.date_format_report(df)
    assert sorted(map(tuple, report.collect())) == [
        ("a", "DD/MM/YYYY or MM/DD/YYYY", 1, 3),
        ("a", "YYYY-MM-DD", 1, 3),
        ("a", "unrecognized", 1, 3),
        ("b", "DD.MM.YYYY", 1, 4),
        ("b", "YYYY-MM-DD", 1, 4),
        ("b", "unrecognized", 2, 4),
    ]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"CASE WHEN _dated#\d+ THEN trim\(_raw", plan)
