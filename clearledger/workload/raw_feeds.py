"""Dirty banking feeds derived from the given tables by integer arithmetic on their keys.

Every text is built from divisions, remainders, concat and lpad, so that another engine can
build the same feed. Planted defects repeat by key remainder and grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.sources.tables import read_table

# The currency codes of the feeds, by nation key.
CURRENCY_CODES = (
    "EUR", "USD", "GBP", "CHF", "JPY", "AUD", "CAD", "NZD", "SGD", "SEK", "NOK", "DKK", "PLN",
    "CZK", "HUF", "RON", "BGN", "TRY", "ZAR", "BRL", "MXN", "INR", "CNY", "KRW", "THB",
)
NATION_WITHOUT_RATE = 7
WIDE_COLUMNS = 28

# One e-mail defect per remainder of the customer key by 11.
EMAIL_FORMS = (
    "concat('c', k % 400, '@mail', k % 13, '.de')",
    "concat('first.last', k, '@example.com')",
    "concat(' padded', k, '@example.org ')",
    "''",
    "concat('nodomain', k, '.de')",
    "concat('two words', k, '@c.de')",
    "concat('jürgen', k, '@gmx.de')",
    "concat('a..b', k, '@c.de')",
    "concat('a', k, '@straße.de')",
    "concat('a', k, '@-c.de')",
    "NULL",
)


def currency_code(index: Column) -> Column:
    """Code of a nation key; element_at counts from one."""
    return F.element_at(F.array(*map(F.lit, CURRENCY_CODES)), (index + 1).cast("int"))


def _text(c: Column) -> Column:
    return c.cast("string")


def amount_text(value: Column, key: Column) -> Column:
    """An amount in one of four notations, with some unreadable and missing ones."""
    plain = value.cast("decimal(20,2)").cast("string")
    comma = F.translate(plain, ".", ",")
    grouped = F.regexp_replace(comma, r"^(\d+)(\d{3},)", "$1.$2")
    return (
        F.when(key % 503 == 0, F.lit("n/a"))
        .when(key % 509 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 0, plain)
        .when(key % 4 == 1, comma)
        .when((key % 4 == 2) & (value >= 1000), grouped)
        .otherwise(F.concat(F.lit(" "), comma, F.lit(" ")))
    )


def date_text(value: Column, key: Column, form: Column) -> Column:
    """A date in one of five notations, with some empty, missing and impossible ones."""
    written = lambda notation: F.date_format(value, notation)
    return (
        F.when(key % 211 == 0, F.lit(""))
        .when(key % 223 == 0, F.lit(None).cast("string"))
        .when(key % 227 == 0, F.lit("31.02.2020"))
        .when(form % 5 == 0, written("yyyy-MM-dd"))
        .when(form % 5 == 1, written("dd.MM.yyyy"))
        .when(form % 5 == 2, written("d/M/yyyy"))
        .when((form % 5 == 3) & (F.day(value) > 12), written("MM/dd/yyyy"))
        .when(form % 5 == 3, written("dd/MM/yyyy"))
        .otherwise(written("yyyy-M-d"))
    )


def written_date_text(value: Column, form: Column) -> Column:
    """A date with its month in letters or without separators, and a day that does not exist."""
    written = lambda notation: F.date_format(value, notation)
    return (
        F.when(form % 97 == 0, F.lit("31 Feb 2020"))
        .when(form % 5 == 0, written("d MMM yyyy"))
        .when(form % 5 == 1, written("MMM d, yyyy"))
        .when(form % 5 == 2, written("MMMM d, yyyy"))
        .when(form % 5 == 3, written("d MMMM yyyy"))
        .otherwise(written("yyyyMMdd"))
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    cases = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(EMAIL_FORMS))
    email = F.expr(f"CASE k % 11 {cases} END")
    copies = F.when(k % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        read_table(spark, folder, "customer")
        .withColumnRenamed("c_custkey", "k")
        .select(
            k.alias("customer_id"),
            F.when(k % 10 == 3, F.concat(F.lit(" "), F.col("c_name")))
            .otherwise(F.col("c_name"))
            .alias("firstname"),
            F.concat(F.lit("Family"), _text(k % 500)).alias("lastname"),
            F.when(k % 97 == 0, 17).otherwise((F.lit(18) + k % 60).cast("int")).alias("Age"),
            F.element_at(F.array(F.lit("f"), F.lit("m"), F.lit("d")), (k % 3 + 1).cast("int")).alias(
                "Gender"
            ),
            F.concat(F.lit("Street "), _text(k % 700)).alias("Address"),
            F.when(k % 8 == 5, F.concat(F.lit("\t"), F.col("c_mktsegment"), F.lit(" ")))
            .otherwise(F.col("c_mktsegment"))
            .alias("City"),
            (F.lit(49000000000) + k).alias("Contact Number"),
            email.alias("Email"),
            F.concat(
                F.lpad(_text(k % 28 + 1), 2, "0"),
                F.lit("."),
                F.lpad(_text(k % 12 + 1), 2, "0"),
                F.lit("."),
                _text(F.lit(2000) + k % 24),
            ).alias("creation_date"),
            F.when(k % 50 != 0, F.col("c_nationkey")).alias("branch_id"),
            F.explode(copies).alias("_copy"),
        )
        .drop("_copy")
    )


def raw_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Registrations: neighbouring ids share e-mail addresses and phone numbers in overlapping
    groups, some ids far apart share a name."""
    k = F.col("c_custkey")
    group = lambda key, size: _text(F.floor(key / size).cast("bigint"))
    return read_table(spark, folder, "customer").select(
        k.alias("customer_id"),
        F.when(k % 11 == 5, F.lit(None).cast("string"))
        .when(k % 2 == 0, F.concat(F.lit(" P"), group(k, 3), F.lit("@MAIL.de")))
        .otherwise(F.concat(F.lit("p"), group(k, 3), F.lit("@mail.de ")))
        .alias("Email"),
        F.when(k % 7 != 3, F.lit(49000000000) + F.floor((k + 1) / 4).cast("bigint")).alias("Contact Number"),
        F.when(k % 40 == 0, F.concat(F.lit("Name"), _text(F.floor(k / 40).cast("bigint") % 25)))
        .otherwise(F.col("c_name"))
        .alias("name"),
    )


def wide_lines(spark: SparkSession, folder: str, columns: int = WIDE_COLUMNS) -> DataFrame:
    """Order lines with many number columns, each with gaps of its own."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    return read_table(spark, folder, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        *[
            F.when(key % (31 + i) != 0, ((key * (i + 3) + line) % (17 + i)).cast("double")).alias(f"m{i}")
            for i in range(columns)
        ],
    )


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read_table(spark, folder, "orders").select(
        k.alias("account_id"),
        F.when(k % 1000 == 0, F.lit(-1).cast("bigint"))
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.when(k % 100 == 7, F.lit("-"))
        .when(k % 100 == 8, F.lit(None).cast("string"))
        .when(k % 100 == 9, F.lit(""))
        .when(k % 100 == 11, F.lit(" - "))
        .when(k % 2 == 0, F.lit("savings"))
        .otherwise(F.lit("current"))
        .alias("account_type"),
        date_text(F.col("o_orderdate"), k, k).alias("account_opening_date"),
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    code = currency_code(F.col("l_suppkey") % 25)
    kind = F.array(F.lit("transfer"), F.lit("deposit"), F.lit(" withdrawal"))
    return read_table(spark, folder, "lineitem").select(
        (k * 10 + line).alias("transaction_id"),
        date_text(F.col("l_shipdate"), k, k + line).alias("transaction_date"),
        k.alias("account_id"),
        F.element_at(kind, (line % 3 + 1).cast("int")).alias("transaction_type"),
        amount_text(F.col("l_extendedprice"), k).alias("transaction_amount"),
        F.when(k % 1009 == 0, F.lit("RON1"))
        .when(line == 3, F.concat(F.lit(" "), code, F.lit(" ")))
        .otherwise(code)
        .alias("transaction_currency"),
    )


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    pick = lambda words, by: F.element_at(F.array(*map(F.lit, words)), (by + 1).cast("int"))
    return read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        k.alias("loan_id"),
        amount_text(F.col("o_totalprice"), k).alias("loan_amount"),
        pick(["personal", "mortgage", "auto"], k % 3).alias("loant_type"),
        F.concat(
            _text(F.floor((k % 900 + 100) / 100).cast("bigint")),
            F.lit(","),
            F.lpad(_text(k % 100), 2, "0"),
        ).alias("interest_rate"),
        pick([12, 24, 36, 48, 60], k % 5).alias("loan_term"),
        date_text(F.col("o_orderdate"), k, k + 2).alias("approval_rejection_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("closed"))
        .when(F.col("o_orderstatus") == "O", F.lit("approved"))
        .otherwise(F.lit("rejected"))
        .alias("loan_status"),
    )


def raw_fx_rates(spark: SparkSession, folder: str) -> DataFrame:
    """One rate per nation the suppliers sit in, plus junk rows that staging must drop."""
    supplier = read_table(spark, folder, "supplier")
    n, s = F.col("s_nationkey"), F.col("s_suppkey")
    hundredths = F.lit(50) + n * 7
    whole = _text(F.floor(hundredths / 100).cast("bigint"))
    frac = F.lpad(_text(hundredths % 100), 2, "0")
    rates = (
        supplier.filter(n != NATION_WITHOUT_RATE)
        .groupBy("s_nationkey")
        .agg(F.count("*").alias("_suppliers"))
        .select(
            F.when(n % 4 == 1, F.concat(F.lit(" "), currency_code(n)))
            .otherwise(currency_code(n))
            .alias("currency_iso_code"),
            F.when(n % 3 == 1, F.concat(whole, F.lit("."), frac))
            .when(n % 3 == 2, F.concat(F.lit(" "), whole, F.lit(","), frac, F.lit(" ")))
            .otherwise(F.concat(whole, F.lit(","), frac))
            .alias("fx_rate"),
            F.lit("15.03.2024").alias("date"),
            F.lit(None).cast("string").alias("Column4"),
        )
    )
    junk = supplier.filter((s % 10).isin(1, 2, 3, 4)).select(
        F.when(s % 10 == 1, F.lit("(none)"))
        .when(s % 10 == 2, F.lit(" (none) "))
        .when(s % 10 == 3, F.lit(""))
        .alias("currency_iso_code"),
        F.lit("1,00").alias("fx_rate"),
        F.lit("15.03.2024").alias("date"),
        F.lit("x").alias("Column4"),
    )
    return rates.unionByName(junk)


def raw_currencies(spark: SparkSession, folder: str) -> DataFrame:
    """A reference list with repeats, placeholder codes and two names for USD."""
    n, s = F.col("s_nationkey"), F.col("s_suppkey")
    return read_table(spark, folder, "supplier").select(
        F.when(s % 10 == 1, F.lit("Historic unit"))
        .when((n == 1) & (s % 2 == 0), F.lit("United States dollar"))
        .otherwise(F.concat(F.lit("Unit "), currency_code(n)))
        .alias("currency"),
        F.when(s % 10 == 1, F.lit("(none)"))
        .when(s % 10 == 3, F.lit(""))
        .when(s % 10 == 4, F.lit(None).cast("string"))
        .when(s % 3 == 2, F.concat(F.lit(" "), currency_code(n)))
        .otherwise(currency_code(n))
        .alias("currency_iso_code"),
    )
