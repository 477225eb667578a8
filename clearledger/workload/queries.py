"""One query per operator, each over whole tables or feeds derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.functions import (
    contains_ci,
    detect_date_format,
    email_error,
    parse_date_mixed,
    parse_date_warehouse,
    parse_number_mixed,
    parse_number_warehouse,
    surrogate_key,
)
from clearledger.operators import (
    checks,
    comoments,
    extracts,
    identity,
    ids,
    observed,
    outliers,
    profile,
    quality,
    relationships,
    sampling,
    sketches,
)
from clearledger.plans import incremental, intermediate, reporting, staging, storage, warehouse
from clearledger.plans.suite import SUITE, SUMMARY_KEYS
from clearledger.sources import catalog
from clearledger.sources.tables import (
    read_delimited,
    read_table,
    shared_folder,
    stored,
    table_sample,
    write_delimited,
)
from clearledger.workload import raw_feeds

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
AS_OF = "2000-01-01"
DIGITS = 6
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles, whose last digits depend on the order of summation."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# --- models -----------------------------------------------------------------------------------


def _staged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    raw = getattr(raw_feeds, f"raw_{name}")(spark, folder)
    return getattr(staging, f"stg_{name}")(raw)


def _cleaned(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return intermediate.without_date_errors(_staged(spark, folder, name))


def _register_models() -> None:
    for name in ("accounts", "customers", "fx_rates", "loans", "transactions"):
        QUERIES[f"stg_{name}"] = lambda spark, folder, n=name: _staged(spark, folder, n)
    for name in ("accounts", "fx_rates", "loans", "transactions"):
        QUERIES[f"int_{name}"] = lambda spark, folder, n=name: _cleaned(spark, folder, n)


_register_models()


@query
def int_customers(spark, folder):
    return intermediate.int_customers(_staged(spark, folder, "customers"))


@query
def int_currencies(spark, folder):
    return intermediate.int_currencies(raw_feeds.raw_currencies(spark, folder))


@query
def customer_transactions_summary(spark, folder):
    """The flagship: transactions in EUR per date, customer, account and branch."""
    summary = reporting.customer_transactions_summary(
        _cleaned(spark, folder, "transactions"),
        _cleaned(spark, folder, "accounts"),
        _cleaned(spark, folder, "fx_rates"),
        int_customers(spark, folder),
    )
    return rounded(summary, 4)


def _inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Cleaned transactions, accounts, rates and customers, written once for several readers."""
    names = ("transactions", "accounts", "fx_rates")
    models = {n: stored(_cleaned(spark, folder, n), n) for n in names}
    return models | {"customers": stored(int_customers(spark, folder), "customers")}


@query
def summary_daily_merge(spark, folder):
    """The reporting table after four loads: three spans of years, then late rows of all of them."""
    inputs = _inputs(spark, folder)
    arrived = inputs.pop("transactions")
    date = F.col("transaction_date")
    load = (
        F.when(F.col("transaction_id") % 10 == 0, 3)
        .when(date < "1994-01-01", 0)
        .when(date < "1996-01-01", 1)
        .otherwise(2)
    )
    table = incremental.DailySummary(shared_folder(spark, "daily"), grain="year")
    for i in range(4):
        table.add(arrived.where(load == i), f"load{i}", **inputs)
    return rounded(table.report(spark), 4)


@query
def summary_from_buckets(spark, folder):
    """The reporting model over layers bucketed by account, joined without a shuffle."""
    inputs = _inputs(spark, folder)
    where = shared_folder(spark, "buckets")
    layers = storage.bucket_layers(
        inputs["transactions"],
        inputs["accounts"],
        inputs["customers"],
        database=f"buckets_{where[-32:]}",
        buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
        folder=where,
    )
    return rounded(layers.summary(inputs["fx_rates"]), 4)


@query
def transactions_in_eur(spark, folder):
    return rounded(
        reporting.transactions_in_eur(
            _cleaned(spark, folder, "transactions"), _cleaned(spark, folder, "fx_rates")
        ),
        4,
    )


@query
def transactions_with_account(spark, folder):
    return reporting.transactions_with_account(
        _cleaned(spark, folder, "transactions"), _cleaned(spark, folder, "accounts")
    )


# --- sources and catalogue --------------------------------------------------------------------


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in TABLES}


@query
def currency_reference(spark, folder):
    """Write the currency list as delimited text to the shared folder and read it back."""
    path = shared_folder(spark, "currencies")
    write_delimited(raw_feeds.raw_currencies(spark, folder), path)
    return read_delimited(spark, path, "currency string, currency_iso_code string")


@query
def catalog_tables(spark, folder):
    tables = _tables(spark, folder)
    widths = F.create_map(*[F.lit(x) for n, df in tables.items() for x in (n, len(df.columns))])
    counts = catalog.row_counts(tables)
    return counts.select("table_name", "row_count", widths[F.col("table_name")].alias("columns"))


@query
def catalog_columns(spark, folder):
    entries = catalog.present_counts(_tables(spark, folder))
    return entries.select("table_name", "column_name", "data_type", "ordinal", "row_count", "present")


@query
def naming_issues(spark, folder):
    """Columns of the raw feeds not in snake case, with the present values each holds."""
    feeds = {
        "customers": raw_feeds.raw_customers(spark, folder),
        "fx_rates": raw_feeds.raw_fx_rates(spark, folder),
    }
    issues = catalog.columns_with_capitals(catalog.present_counts(feeds))
    return issues.select("table_name", "column_name", "present")


@query
def row_counts(spark, folder):
    return catalog.row_counts(_tables(spark, folder))


@query
def sampled_table(spark, folder):
    orders = read_table(spark, folder, "orders")
    return table_sample(orders, limit=100, order_by=["o_orderkey"])


# --- filters and limits -----------------------------------------------------------------------


@query
def filter_lookup(spark, folder):
    customers = raw_feeds.raw_customers(spark, folder)
    return customers.filter(F.col("customer_id") == 77)


@query
def filter_in_list(spark, folder):
    rates = _cleaned(spark, folder, "transactions")
    every_second = raw_feeds.CURRENCY_CODES[::2]
    return rates.filter(F.col("transaction_currency").isin(*every_second))


@query
def filter_contains_ci(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    found = raw.filter(contains_ci(F.col("transaction_currency"), "ron"))
    return found.select("transaction_id", "transaction_currency")


@query
def topk_rates(spark, folder):
    loans = _cleaned(spark, folder, "loans")
    top = loans.orderBy(F.desc("interest_rate"), "loan_id").limit(10)
    return top.select("loan_id", "interest_rate")


@query
def rows_with_total(spark, folder):
    loans = _cleaned(spark, folder, "loans")
    return sampling.rows_with_total(
        loans, ["loan_amount", "interest_rate"], limit=100, order_by=["loan_id"]
    )


@query
def column_samples(spark, folder):
    return sampling.column_samples(raw_feeds.raw_customers(spark, folder))


# --- cleaners ---------------------------------------------------------------------------------


@query
def clean_dates_sql(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    text = F.col("transaction_date")
    return raw.select("transaction_id", text.alias("raw"), parse_date_warehouse(text).alias("parsed"))


@query
def clean_dates_written(spark, folder):
    """Shipping dates written out in letters or as eight digits, read by the profiling rule."""
    lines = read_table(spark, folder, "lineitem")
    form = F.col("l_orderkey") + F.col("l_linenumber")
    text = raw_feeds.written_date_text(F.col("l_shipdate"), form)
    return lines.select(
        "l_orderkey", "l_linenumber", text.alias("raw"), parse_date_mixed(text).alias("parsed")
    )


@query
def clean_dates_lib(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    text = F.concat(F.lit(" "), F.col("transaction_date"), F.lit("\t"))
    return raw.select("transaction_id", parse_date_mixed(text).alias("parsed"))


@query
def detect_date_formats(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    found = detect_date_format(F.col("transaction_date"))
    return raw.select("transaction_id", found.alias("format"))


@query
def clean_numbers_sql(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    text = F.col("transaction_amount")
    return raw.select("transaction_id", text.alias("raw"), parse_number_warehouse(text).alias("parsed"))


@query
def clean_numbers_lib(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    text = F.col("transaction_amount")
    return raw.select("transaction_id", text.alias("raw"), parse_number_mixed(text).alias("parsed"))


@query
def clean_whitespace(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder)
    return quality.clean_whitespace(raw).select("customer_id", "firstname", "City", "Email")


@query
def clean_table(spark, folder):
    return rounded(quality.clean_table(raw_feeds.raw_loans(spark, folder)))


@query
def surrogate_keys(spark, folder):
    accounts = raw_feeds.raw_accounts(spark, folder)
    key = surrogate_key(accounts, exclude=["account_opening_date"])
    return accounts.select("account_id", key.alias("surrogate_key"))


@query
def email_validation(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder).select("customer_id", "Email")
    verdict = quality.with_email_verdict(raw, "Email")
    return verdict.withColumn("email_error", email_error(F.col("Email")))


# --- checks -----------------------------------------------------------------------------------


@query
def check_not_null(spark, folder):
    return checks.not_null(_staged(spark, folder, "customers"), "branch_id")


@query
def check_unique(spark, folder):
    return checks.unique(_staged(spark, folder, "transactions"), "transaction_id")


@query
def check_accepted_values(spark, folder):
    accounts = _staged(spark, folder, "accounts")
    return checks.accepted_values(accounts, "account_type", ["savings", "current"])


@query
def check_relationships(spark, folder):
    return checks.relationships(
        _staged(spark, folder, "transactions"),
        "account_id",
        _staged(spark, folder, "accounts"),
        "account_id",
    )


@query
def check_numeric_range(spark, folder):
    return checks.numeric_range(_staged(spark, folder, "customers"), "age", min=18, max=200)


@query
def check_date_is_past(spark, folder):
    loans = _staged(spark, folder, "loans")
    return checks.date_is_past(loans, "approval_rejection_date", as_of=AS_OF)


@query
def check_is_bool(spark, folder):
    return checks.is_bool(read_table(spark, folder, "lineitem"), "l_linenumber")


@query
def check_unique_combination(spark, folder):
    lineitem = read_table(spark, folder, "lineitem")
    return checks.unique_combination(lineitem, ["l_orderkey", "l_linenumber"])


@query
def check_suite_summary(spark, folder):
    raw = {n: getattr(raw_feeds, f"raw_{n}")(spark, folder) for n in warehouse.RAW_TABLES}
    return checks.check_suite_summary(SUITE, warehouse.lazy_models(raw), as_of=AS_OF)


@query
def observed_checks(spark, folder):
    """Failing rows of all row checks of the stored layers, counted while they are written."""
    raw = {n: getattr(raw_feeds, f"raw_{n}")(spark, folder) for n in warehouse.RAW_TABLES}
    staged = warehouse.staging_models(raw)
    results, layers = [], {}

    def write(models: dict[str, DataFrame]) -> None:
        for name, df in models.items():
            own = [c for c in SUITE if c.model == name]
            path = shared_folder(spark, name)
            layers[name], found = observed.write_observed(df, path, own, AS_OF)
            results.extend(found)

    write(warehouse.intermediate_models(staged, raw["currencies"]))
    write(warehouse.reporting_models(layers))
    return observed.results_frame(spark, results)


@query
def check_summary_keys(spark, folder):
    """The key of the reporting table holds: no combination is returned."""
    return checks.unique_combination(
        customer_transactions_summary(spark, folder), list(SUMMARY_KEYS)
    )


# --- relationships ----------------------------------------------------------------------------


@query
def fk_orphans(spark, folder):
    return relationships.fk_orphans(
        raw_feeds.raw_accounts(spark, folder),
        "customer_id",
        raw_feeds.raw_customers(spark, folder),
        "customer_id",
    )


@query
def fk_orphan_examples(spark, folder):
    return relationships.orphan_examples(
        raw_feeds.raw_accounts(spark, folder),
        "customer_id",
        raw_feeds.raw_customers(spark, folder),
        "customer_id",
        order_by=["account_id"],
    )


@query
def fk_report(spark, folder):
    names = ("customers", "accounts", "loans", "transactions")
    tables = {n: getattr(raw_feeds, f"raw_{n}")(spark, folder) for n in names}
    return rounded(relationships.check_all_relationships(tables))


@query
def currency_coverage(spark, folder):
    return rounded(
        relationships.currency_coverage(
            raw_feeds.raw_transactions(spark, folder), raw_feeds.raw_fx_rates(spark, folder)
        )
    )


@query
def currency_counts(spark, folder):
    return relationships.missing_currencies(
        raw_feeds.raw_transactions(spark, folder), raw_feeds.raw_fx_rates(spark, folder)
    )


# --- identifiers ------------------------------------------------------------------------------


@query
def id_duplicates(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder)
    return rounded(ids.id_duplicates(raw).drop("error"))


@query
def id_duplicate_values(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder)
    return ids.duplicate_values(raw, ["customer_id", "Address"])


@query
def duplicate_records(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    return ids.duplicate_records(raw, "transaction_id")


@query
def listed_duplicates(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    keys = ["transaction_id", "transaction_amount", "transaction_currency"]
    return ids.listed_duplicates(raw, "transaction_id", keys)


@query
def composite_key_duplicates(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    keys = ["account_id", "transaction_date", "transaction_type"]
    return ids.composite_key_duplicates(raw, keys)


@query
def composite_key_summary(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    return ids.composite_key_summary(raw, ["transaction_id", "account_id"])


@query
def dedupe_keep_last(spark, folder):
    lineitem = read_table(spark, folder, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    kept = ids.dedupe_keep_last(lineitem, ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", *order)


@query
def repeat_count(spark, folder):
    return ids.repeat_count(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def id_properties(spark, folder):
    orders = read_table(spark, folder, "orders")
    falling = orders.withColumn("falling", -F.col("o_orderkey"))
    parts = [
        ids.id_properties(orders, "o_orderkey", "o_orderkey"),
        ids.id_properties(falling, "falling", "o_orderkey"),
        ids.id_properties(orders, "o_custkey", "o_orderkey"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def digit_counts(spark, folder):
    return ids.digit_counts(raw_feeds.raw_transactions(spark, folder), "transaction_id")


@query
def shared_contact_ids(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder)
    return ids.shared_contacts(raw, "Email", "customer_id")


@query
def shared_contact_records(spark, folder):
    raw = raw_feeds.raw_customers(spark, folder).select("customer_id", "Email")
    return ids.shared_contact_records(raw, "Email")


# --- profiles ---------------------------------------------------------------------------------


@query
def value_counts(spark, folder):
    return profile.value_counts(_cleaned(spark, folder, "transactions"), "transaction_currency")


@query
def top_value_counts(spark, folder):
    customers = raw_feeds.raw_customers(spark, folder)
    return profile.value_counts(customers, "City", top_n=10)


@query
def profile_counts(spark, folder):
    lineitem = read_table(spark, folder, "lineitem").withColumn(
        "l_empty", F.when(F.col("l_orderkey") < 0, F.lit("x"))
    )
    return rounded(profile.profile_counts(lineitem))


@query
def total_missing(spark, folder):
    return profile.total_missing(_cleaned(spark, folder, "transactions"))


@query
def profile_numeric(spark, folder):
    return rounded(profile.profile_numeric(_cleaned(spark, folder, "loans")), 4)


@query
def profile_categorical(spark, folder):
    return rounded(profile.profile_categorical(_cleaned(spark, folder, "transactions")))


@query
def profile_dates(spark, folder):
    return profile.profile_dates(_cleaned(spark, folder, "transactions"))


@query
def date_distribution(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    return rounded(profile.date_distribution(transactions, "transaction_date", as_of=AS_OF), 4)


@query
def future_date_examples(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    return profile.future_date_examples(transactions, "transaction_date", as_of=AS_OF)


@query
def date_year_month_counts(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    return profile.date_year_month_counts(transactions, "transaction_date")


@query
def grouped_stats(spark, folder):
    loans = _cleaned(spark, folder, "loans")
    return rounded(profile.grouped_stats(loans, ["loan_type"], "interest_rate"))


@query
def group_size_stats(spark, folder):
    customers = raw_feeds.raw_customers(spark, folder)
    return rounded(profile.group_size_stats(customers, ["Address", "City"]))


# --- outliers ---------------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events")


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a few dates moved thirty years back."""
    orders = read_table(spark, folder, "orders")
    date = F.col("o_orderdate").cast("date")
    moved = F.when(F.col("o_orderkey") % 97 == 0, F.add_months(date, -360)).otherwise(date)
    return orders.select("o_orderkey", moved.alias("order_date"))


@query
def outliers_iqr(spark, folder):
    return rounded(outliers.outliers_iqr(_events(spark, folder), ["value", "user_id"]), 4)


@query
def outliers_iqr_values(spark, folder):
    return outliers.iqr_outlier_values(_events(spark, folder), ["value", "user_id"])


@query
def outliers_zscore(spark, folder):
    return rounded(outliers.outliers_zscore(_events(spark, folder), ["value", "user_id"]))


@query
def rare_categories(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    return rounded(
        outliers.rare_categories(raw, ["transaction_currency", "transaction_type"])
    )


@query
def rare_category_summary(spark, folder):
    raw = raw_feeds.raw_transactions(spark, folder)
    return outliers.rare_category_summary(raw, ["transaction_currency", "transaction_type"])


@query
def outliers_mad_dates(spark, folder):
    return rounded(outliers.outliers_mad_dates(_dated_orders(spark, folder), ["order_date"]))


@query
def outliers_mad_date_examples(spark, folder):
    examples = outliers.mad_outlier_dates(_dated_orders(spark, folder), "order_date")
    return examples.select("date", "seconds_from_median")


# --- quality ----------------------------------------------------------------------------------


@query
def quality_recommendations(spark, folder):
    return rounded(quality.quality_recommendations(raw_feeds.raw_loans(spark, folder)))


@query
def date_format_report(spark, folder):
    return quality.date_format_report(raw_feeds.raw_transactions(spark, folder))


@query
def date_format_counts(spark, folder):
    return quality.date_format_counts(raw_feeds.raw_accounts(spark, folder))


@query
def whitespace_report(spark, folder):
    return rounded(quality.whitespace_report(raw_feeds.raw_customers(spark, folder)))


@query
def whitespace_examples(spark, folder):
    return quality.whitespace_examples(raw_feeds.raw_customers(spark, folder))


@query
def email_report(spark, folder):
    return rounded(quality.email_report(raw_feeds.raw_customers(spark, folder), "Email"))


@query
def email_domains(spark, folder):
    return quality.email_domains(raw_feeds.raw_customers(spark, folder), "Email")


@query
def email_errors(spark, folder):
    return quality.email_errors(raw_feeds.raw_customers(spark, folder), "Email")


@query
def email_examples(spark, folder):
    return quality.email_examples(raw_feeds.raw_customers(spark, folder), "Email")


@query
def cleaning_samples(spark, folder):
    return quality.cleaning_samples(raw_feeds.raw_loans(spark, folder))


@query
def cleaning_summary(spark, folder):
    return quality.cleaning_summary(raw_feeds.raw_loans(spark, folder))


@query
def cleaning_changes(spark, folder):
    changes = quality.cleaning_changes(
        raw_feeds.raw_loans(spark, folder),
        numeric_columns=["interest_rate"],
        date_columns=["approval_rejection_date"],
        whitespace_columns=["loan_amount"],
    )
    return changes


# --- chart extracts ---------------------------------------------------------------------------


@query
def time_series_counts(spark, folder):
    parts = [
        extracts.time_series(_events(spark, folder), "ts", freq).withColumn("freq", F.lit(freq))
        for freq in extracts.PERIODS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(
        parts[4]
    )


@query
def time_series_sums(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    series = extracts.time_series(transactions, "transaction_date", "M", "transaction_amount")
    return rounded(series, 2)


@query
def correlation_matrix(spark, folder):
    lineitem = read_table(spark, folder, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(extracts.correlation_matrix(lineitem, columns))


@query
def correlation_wide(spark, folder):
    """Correlations of thirty columns with gaps, from one scan."""
    return rounded(comoments.correlations(raw_feeds.wide_lines(spark, folder)))


@query
def histogram_numeric(spark, folder):
    return rounded(extracts.histogram_numeric(_cleaned(spark, folder, "loans"), "loan_amount", 20))


@query
def histogram_dates(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    return rounded(extracts.histogram_dates(transactions, "transaction_date"))


@query
def boxplot_stats(spark, folder):
    loans = _cleaned(spark, folder, "loans")
    return rounded(extracts.boxplot_stats(loans, "loan_amount", by="loan_term"), 4)


@query
def boxplot_whole(spark, folder):
    return rounded(extracts.boxplot_stats(_events(spark, folder), "value"), 4)


@query
def kde_by_category(spark, folder):
    loans = _cleaned(spark, folder, "loans")
    return rounded(extracts.kde_by_category(loans, "interest_rate", "loan_status"))


@query
def kde_binned(spark, folder):
    """Densities of a column with about as many values as rows."""
    transactions = _cleaned(spark, folder, "transactions")
    thousands = transactions.select("transaction_type", (F.col("transaction_amount") / 1000).alias("thousands"))
    return rounded(extracts.kde_binned(thousands, "thousands", "transaction_type"), 9)


@query
def category_shares(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    return rounded(extracts.category_shares(transactions, "transaction_currency", top_n=5))


@query
def category_codes(spark, folder):
    transactions = _cleaned(spark, folder, "transactions")
    points = extracts.scatter_points(
        transactions, "transaction_id", "transaction_amount", "transaction_currency"
    )
    return rounded(points)


# --- persons under several ids, kept sketches ---------------------------------------------------


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    contacts = raw_feeds.raw_contacts(spark, folder)
    kinds = {
        "email": F.lower(F.trim("Email")),
        "phone": F.col("`Contact Number`"),
        "name": F.col("name"),
    }
    return identity.linked_persons(contacts, "customer_id", kinds)


@query
def linked_persons(spark, folder):
    """Every customer id with the smallest that shared e-mails, phones and names lead to."""
    return _linked(spark, folder)


@query
def linked_person_report(spark, folder):
    return identity.linked_person_report(_linked(spark, folder))


SKETCHED = ("l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")


@query
def sketch_profile(spark, folder):
    """Profiles kept by year of shipping, merged over the years and held against exact numbers."""
    lines = read_table(spark, folder, "lineitem").select(*SKETCHED)
    kept = sketches.KeptProfiles(shared_folder(spark, "profiles"))
    kept.add(lines, F.year("l_shipdate"))
    merged = kept.profile(spark)
    exact = profile.profile_counts(lines).select("column", F.col("unique_values").alias("distinct"))
    measured = [c for c in SKETCHED if sketches.measure(lines, c) is not None]
    guessed = {r["column"]: r["median"] for r in merged.select("column", "median").collect()}  # one a column
    below = [
        F.struct(
            F.lit(c).alias("column"),
            F.avg((sketches.measure(lines, c) < guessed[c]).cast("double")).alias("less"),
            F.avg((sketches.measure(lines, c) <= guessed[c]).cast("double")).alias("upto"),
        )
        for c in measured
        if guessed[c] is not None
    ]
    ranks = lines.agg(F.array(*below).alias("r")).select(F.inline("r"))
    near = F.abs(F.col("unique_values") - F.col("distinct")) <= 4 * sketches.DISTINCT_ERROR * F.col("distinct")
    error = 2 * sketches.QUANTILE_ERROR
    middle = (F.col("less") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)
    return (
        merged.join(F.broadcast(exact), "column")
        .join(F.broadcast(ranks), "column", "left")
        .select(
            "column",
            "count",
            "missing",
            near.alias("distinct_within_error"),
            F.coalesce(middle, F.lit(True)).alias("median_within_error"),
            F.when(F.col("distinct") < 100, F.get("frequent", F.lit(0))["n"]).alias("highest_count"),
        )
    )
