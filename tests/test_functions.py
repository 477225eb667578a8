"""Cleaners against literal edge tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clearledger import functions as C


def evaluate(spark, values, *functions):
    """Apply column functions to a literal text column; one tuple per value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").repartition(2)
    out = df.select("i", *[f(F.col("v")).alias(f"r{n}") for n, f in enumerate(functions)])
    return [tuple(r)[1:] for r in out.orderBy("i").collect()]


def day(text):
    return dt.date.fromisoformat(text) if text else None


WAREHOUSE_DATES = [
    ("1.2.2020", "2020-02-01"),
    ("01.02.2020", "2020-02-01"),
    ("3/4/2024", "2024-04-03"),
    ("12/25/2024", "2024-12-25"),
    ("31/12/2024", "2024-12-31"),
    ("45/13/2020", None),
    ("13/13/2020", None),
    ("00/05/2020", None),
    ("31/02/2020", None),
    ("31.02.2020", None),
    ("29.02.2019", None),
    ("29.02.2020", "2020-02-29"),
    ("2020-1-5", "2020-01-05"),
    ("2020/01/05", "2020-01-05"),
    ("2020-01/05", None),
    (" 2020-01-05 ", "2020-01-05"),
    ("2020-01-05 10:00:00", "2020-01-05"),
    ("2020-01-05T10:00:00.25", "2020-01-05"),
    ("2020-01-05 25:00:00", None),
    ("2020", None),
    ("2020-01", None),
    ("2020-01-05Tabc", None),
    ("20200105", None),
    ("01-02-2020", None),
    (" 01.02.2020 ", None),
    ("", None),
    (None, None),
]


def test_warehouse_dates_and_flag(spark):
    texts = [t for t, _ in WAREHOUSE_DATES]
    flag = lambda c: C.has_parsing_error(C.parse_date_warehouse(c), c)
    got = evaluate(spark, texts, C.parse_date_warehouse, flag)
    expected = [
        (day(e), e is None and t is not None) for t, e in WAREHOUSE_DATES
    ]
    assert dict(zip(texts, got)) == dict(zip(texts, expected))


MIXED_DATES = [
    ("03/04/2024", "2024-04-03", "%d/%m/%Y"),
    ("12/25/2024", "2024-12-25", "%m/%d/%Y"),
    ("45/13/2020", None, None),
    (" 01.02.2020\t", "2020-02-01", "%d.%m.%Y"),
    ("2020-1-5", "2020-01-05", "%Y-%m-%d"),
    ("5-1-2020", "2020-01-05", "%d-%m-%Y"),
    ("2020/01/05", "2020-01-05", "%Y/%m/%d"),
    ("5 Jan 2020", "2020-01-05", None),
    ("Jan 5, 2020", "2020-01-05", None),
    ("20200105", "2020-01-05", None),
    ("31.02.2020", None, None),
    ("n/a", None, None),
    ("", None, None),
    (None, None, None),
]


def test_mixed_dates_and_format(spark):
    texts = [t for t, _, _ in MIXED_DATES]
    got = evaluate(spark, texts, C.parse_date_mixed, C.detect_date_format)
    assert dict(zip(texts, got)) == {t: (day(d), f) for t, d, f in MIXED_DATES}


NUMBERS = [
    ("1.234", 1.234, 1.234),
    ("1.234,56", 1234.56, 1234.56),
    ("0,56", 0.56, 0.56),
    ("1,5", 1.5, 1.5),
    ("1.234.567", 1234567.0, 1234567.0),
    ("1.234.5", 12345.0, None),
    ("-1.234,5", -1234.5, -1234.5),
    ("1,234.56", 1.23456, 1.23456),
    (" 1.5 ", 1.5, 1.5),
    (" 1.234,5 ", 1234.5, 1234.5),
    ("+5", 5.0, 5.0),
    (".5", 0.5, 0.5),
    ("5.", 5.0, 5.0),
    ("1e5", 100000.0, 100000.0),
    ("1_000", None, None),
    ("1d", None, None),
    ("5f", None, None),
    ("0x1A", None, None),
    ("0x1p3", None, None),
    ("inf", None, None),
    ("NaN", None, None),
    ("n/a", None, None),
    ("1,2,3", None, None),
    ("", None, None),
    (None, None, None),
]


def test_numbers(spark):
    texts = [t for t, _, _ in NUMBERS]
    got = evaluate(spark, texts, C.parse_number_warehouse, C.parse_number_mixed)
    assert dict(zip(texts, got)) == {t: (w, m) for t, w, m in NUMBERS}


EMAILS = [
    ("a.b@c.de", None),
    (" a.b@c.de ", None),
    ("", "Email is empty"),
    ("   ", "Email is empty"),
    ("ab.de", "Email doesn't match basic pattern (user@domain.tld)"),
    ("a@b", "Email doesn't match basic pattern (user@domain.tld)"),
    ("a b@c.de", "Email doesn't match basic pattern (user@domain.tld)"),
    ("a@b@c.de", "Email doesn't match basic pattern (user@domain.tld)"),
    ("x" * 65 + "@c.de", "Username part is too long (>64 characters)"),
    ("x" * 260 + "@c.de", "Email is too long (>254 characters)"),
    ("jürgen@gmx.de", "Username contains invalid characters"),
    ('"jürgen"@gmx.de', None),
    ("a..b@c.de", "Username contains consecutive dots"),
    ("a@straße.de", "Domain format is invalid"),
    ("a@c.d1", "Domain format is invalid"),
    ("a@c..de", "Domain contains consecutive dots"),
    ("a@-c.de", "Domain part starts or ends with hyphen"),
    ("a@c-.de", "Domain part starts or ends with hyphen"),
    (None, None),
]


def test_emails(spark):
    texts = [t for t, _ in EMAILS]
    got = evaluate(spark, texts, C.email_error, C.email_is_valid)
    expected = {t: (e, None if t is None else e is None) for t, e in EMAILS}
    assert dict(zip(texts, got)) == expected


def test_whitespace(spark):
    values = ["USD", " USD", "USD ", " USD ", "\tUSD", "USD\n", " USD", "", " ", None]
    got = evaluate(spark, values, C.whitespace_issue, C.strip_whitespace, C.has_outer_whitespace)
    assert got == [
        (None, "USD", False),
        ("leading", "USD", True),
        ("trailing", "USD", True),
        ("both", "USD", True),
        ("leading", "USD", True),
        ("trailing", "USD", True),
        (None, "USD", True),
        (None, "", False),
        ("both", "", True),
        (None, None, None),
    ]


@pytest.mark.parametrize("code", [9, 10, 13, 28, 31, 133, 160, 5760, 8195, 8232, 12288])
def test_every_kind_of_whitespace_is_stripped(spark, code):
    assert evaluate(spark, [f"{chr(code)}a b{chr(code)}"], C.strip_whitespace) == [("a b",)]


def test_digits_and_contains(spark):
    values = ["a1b22", "", None, "USD1"]
    got = evaluate(spark, values, C.count_digits, lambda c: C.contains_ci(c, "usd"))
    assert got == [(3, False), (0, False), (0, None), (1, True)]


def test_placeholders(spark):
    values = ["savings", "", "-", " - ", " (none) ", None]
    exact = lambda c: C.present(c, ["", "-"])
    trimmed = lambda c: C.present(c, ["(none)", ""], trimmed=True)
    got = evaluate(spark, values, exact, trimmed)
    kept = [(bool(a), bool(b)) for a, b in got]
    assert kept == [
        (True, True), (False, False), (False, True), (True, True), (True, False), (False, False),
    ]


def test_date_shapes(spark):
    values = ["03/04/2024", "x 1.2.2020 y", "5 Jan 2020", "Jan 5 2020", "20200105", "abc", None]
    anchored = lambda c: C.date_shape(c, anchored=True)
    loose = lambda c: C.date_shape(c, anchored=False)
    assert evaluate(spark, values, anchored, loose) == [
        ("DD/MM/YYYY or MM/DD/YYYY",) * 2,
        (None, "DD.MM.YYYY"),
        ("DD Month YYYY",) * 2,
        ("Month DD, YYYY",) * 2,
        ("YYYYMMDD or DDMMYYYY",) * 2,
        (None, None),
        (None, None),
    ]


def test_surrogate_key_excludes_and_marks_nulls(spark):
    df = spark.createDataFrame([(1, "a", None)], "x int, y string, z string")
    row = df.select(C.surrogate_key(df, exclude=["y"]).alias("k")).first()
    import hashlib

    assert row.k == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_to_eur(spark):
    df = spark.createDataFrame(
        [(10.0, "EUR", 9.0), (10.0, "USD", 0.5), (10.0, "XXX", None), (None, "USD", 0.5)],
        "a double, c string, r double",
    )
    got = [r.v for r in df.select(C.to_eur(F.col("a"), F.col("c"), F.col("r")).alias("v")).collect()]
    assert got == [10.0, 5.0, 10.0, None]
