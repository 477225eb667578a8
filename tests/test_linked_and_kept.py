"""Persons under several ids, kept sketches, correlations of many columns, binned densities."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearledger.operators import comoments, extracts, identity, profile, sketches


def plain_classes(links, nodes):
    of = {n: n for n in nodes}

    def top(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        of[high] = low
    return {n: top(n) for n in nodes}


def test_a_chain_of_a_thousand_links_and_a_star(spark):
    order = list(range(1_001))
    random.Random(2).shuffle(order)
    links = list(zip(order, order[1:])) + [(5_000, 5_000 + i) for i in range(1, 400)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in identity.components(df).collect()}
    assert got == plain_classes(links, {n for link in links for n in link})


def test_persons_linked_over_several_contacts(spark):
    rng = random.Random(3)
    rows = [(i, f"m{rng.randrange(90)}" if rng.random() < 0.6 else None, rng.randrange(200) if rng.random() < 0.5 else None) for i in range(240)]
    rows += [(i, "shared", None) for i in range(300, 420)]  # a value that a third of all rows hold
    rows += [(1, "m1", None), (1, "m1", None), (None, "m1", 5), (999, None, None)]
    df = spark.createDataFrame(rows, "id long, mail string, phone long").repartition(5)
    got = identity.linked_persons(df, "id", {"mail": F.col("mail"), "phone": F.col("phone")})
    by = {}
    for i, mail, phone in rows:
        for key in (("mail", mail), ("phone", phone)):
            if i is not None and key[1] is not None:
                by.setdefault(key, set()).add(i)
    links = [(a, min(held)) for held in by.values() for a in held]
    truth = plain_classes(links, {r[0] for r in rows} - {None})
    assert {r.person: r["class"] for r in got.collect()} == truth and got.count() == len(truth)
    report = identity.linked_person_report(got).first()
    sizes = [list(truth.values()).count(c) for c in set(truth.values())]
    assert tuple(report) == (len(truth), len(sizes), sum(n for n in sizes if n > 1), max(sizes))
    nothing = identity.linked_persons(df.limit(0), "id", {"mail": F.col("mail")})
    assert nothing.count() == 0 and identity.linked_person_report(nothing).first().classes == 0


# --- sketches -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(4)
    n = 30_000
    day, big, name = rng.integers(0, 9, n), rng.integers(0, 20_000, n), rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])
    rows = [(int(d), int(b) if b % 10 else None, str(s), float(x)) for d, b, s, x in zip(day, big, name, rng.normal(size=n), strict=True)]
    return spark.createDataFrame(rows, "day int, big long, name string, x double").repartition(6).cache()


def test_merged_sketches_are_within_their_errors(spark, lines, tmp_path):
    kept = sketches.KeptProfiles(str(tmp_path / "kept"))
    for d in range(9):
        kept.add(lines.where(F.col("day") == d), F.col("day"), ["big", "name", "x"])
    got = {r["column"]: r for r in kept.profile(spark).collect()}
    exact = {r["column"]: r for r in profile.profile_counts(lines, ["big", "name", "x"]).collect()}
    for c, r in got.items():
        assert (r["count"], r.missing) == (exact[c]["count"], exact[c].missing)
        assert abs(r.unique_values - exact[c].unique_values) <= 4 * sketches.DISTINCT_ERROR * exact[c].unique_values
    for c in ("big", "x"):
        values = np.sort([r[0] for r in lines.where(F.col(c).isNotNull()).select(c).collect()])
        for q, guess in zip(sketches.QUARTILES, (got[c].q1, got[c].median, got[c].q3), strict=True):
            assert abs(np.searchsorted(values, guess) / len(values) - q) <= 2 * sketches.QUANTILE_ERROR
    counts = {r.name: r["count"] for r in lines.groupBy("name").count().collect()}
    assert {e.value: e.n for e in got["name"].frequent} == counts
    assert [e.value for e in got["name"].frequent] == ["a", "b", "c"] and got["name"].median is None


def test_a_period_that_comes_again_is_replaced(spark, lines, tmp_path):
    kept = sketches.KeptProfiles(str(tmp_path / "kept"))
    kept.add(lines.where("day < 3"), F.col("day"), ["x"])
    kept.add(lines.where("day = 1").limit(10), F.col("day"), ["x"])
    by_day = {r.day: r["count"] for r in lines.where("day < 3").groupBy("day").count().collect()}
    assert kept.profile(spark).first()["count"] == by_day[0] + by_day[2] + 10
    assert kept.profile(spark, ["0", "1"]).first()["count"] == by_day[0] + 10


def test_sketches_of_missing_columns(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    got = {r["column"]: r for r in sketches.estimates(sketches.merge_sketches(sketches.profile_sketches(df, F.lit("all")))).collect()}
    assert {c: (r["count"], r.missing, r.unique_values, r.median, r.frequent) for c, r in got.items()} == {
        "x": (2, 2, 0, None, []), "s": (2, 2, 0, None, []),
    }


# --- correlations -------------------------------------------------------------------------------


def test_two_hundred_columns_in_one_scan(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 20))
    table = base @ rng.normal(size=(20, 200)) + rng.normal(size=(400, 200)) + 1e6
    table[rng.random(table.shape) < 0.1] = np.nan
    table[:, 7] = 3.25  # does not vary
    table[:, 8] = np.nan
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    names = [f"c{i}" for i in range(200)]
    schema = ", ".join(f"{n} double" for n in names)
    stored = spark.createDataFrame([tuple(map(float, r)) for r in table], schema).repartition(4).cache()
    stored.count()
    got = {(r.column_a, r.column_b): r.correlation for r in comoments.correlations(stored.mapInArrow(seen, schema), names).collect()}
    assert len(got) == 200 * 200
    assert reads.value <= len(table) + 4 * comoments.CENTRE_ROWS  # one scan, and the rows that centre it
    for i in range(0, 200, 7):
        for j in range(0, 200, 11):
            both = np.isfinite(table[:, i]) & np.isfinite(table[:, j])
            if both.sum() < 2 or 7 in (i, j):
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(table[both, i], table[both, j])[0, 1], abs=1e-9)
    stored.unpersist()


def test_correlations_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, 2, None), (2.0, 4, 1.0), (float("inf"), 5, None), (None, None, None)], "a double, b int, c double")
    got = {(r.column_a, r.column_b): (r.correlation, r.n) for r in comoments.correlations(df).collect()}
    assert got["a", "b"] == (pytest.approx(1.0), 2) and got["a", "c"] == (None, 1) and got["c", "c"] == (None, 1)
    assert comoments.correlations(df.select("a")).count() == 0
    assert {r.correlation for r in comoments.correlations(df.limit(0)).collect()} == {None}


# --- binned density -----------------------------------------------------------------------------


@pytest.mark.parametrize("bin_width", [0.02, 0.5])
def test_binned_density_is_within_its_bound(spark, bin_width):
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.normal(size=900)] + [("b", float(v)) for v in rng.exponential(2, 300)] + [("c", 1.0), (None, 2.0), ("a", None)]
    df = spark.createDataFrame(rows, "kind string, v double").repartition(3)
    exact = {(r.category, r.point): r for r in extracts.kde_by_category(df, "v", "kind", grid=50).collect()}
    got = {(r.category, r.point): r for r in extracts.kde_binned(df, "v", "kind", grid=50, bin_width=bin_width).collect()}
    assert set(got) == set(exact) and {k for k, _ in got} == {"a", "b"}
    worst = 0.0
    for key, r in got.items():
        assert r.x == pytest.approx(exact[key].x)
        apart = abs(r.density - exact[key].density)
        assert apart <= r.error_bound * (1 + 1e-9) + 1e-12
        worst = max(worst, apart / r.error_bound)
    assert worst > 0.01  # the bound is of the right size
    whole = extracts.kde_binned(df, "v", grid=20).collect()
    assert len(whole) == 20 and {r.category for r in whole} == {"all"}
