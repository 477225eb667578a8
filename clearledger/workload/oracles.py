"""The same results written as ANSI-style SQL over the given tables."""

from __future__ import annotations

import re

from clearledger.workload.queries import AS_OF, TABLES
from clearledger.workload.raw_feeds import CURRENCY_CODES, EMAIL_FORMS, NATION_WITHOUT_RATE

DAY = f"DATE '{AS_OF}'"
SUMMARY_KEYS = ("transaction_date", "customer_id", "account_id", "branch_id")

# Fixed values, written out once more so that a fault in the engine's own lists shows.
WHITESPACE_CODES = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239,
    8287, 12288,
)
DATE_SHAPES = (
    (r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "DD/MM/YYYY or MM/DD/YYYY"),
    (r"[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}", "DD.MM.YYYY"),
    (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "YYYY-MM-DD"),
    (r"[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", "DD-MM-YYYY"),
    (r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "YYYY/MM/DD"),
    (r"[0-9]{1,2}\s+[A-Za-z]{3,}\s+[0-9]{4}", "DD Month YYYY"),
    (r"[A-Za-z]{3,}\s+[0-9]{1,2},?\s+[0-9]{4}", "Month DD, YYYY"),
    (r"[0-9]{8}", "YYYYMMDD or DDMMYYYY"),
)
# One line a model and column: the declared checks, with bounds, values or parent.
DECLARED = """
stg_accounts account_id: not_null; unique
stg_accounts customer_id: not_null; relationships stg_customers customer_id
stg_accounts account_type: not_null; accepted_values savings current
stg_accounts account_opening_date: date_is_past
stg_customers customer_id: not_null; unique
stg_customers age: not_null; numeric_range 18 200
stg_customers branch_id: not_null
stg_fx_rates currency_iso_code: not_null; unique
stg_fx_rates fx_rate: not_null; numeric_range 0
stg_fx_rates fx_rate_date: date_is_past
stg_fx_rates has_date_parsing_error: not_null
stg_loans loan_id: not_null; unique
stg_loans loan_amount: not_null; numeric_range 0
stg_loans loan_type: not_null; accepted_values personal mortgage auto
stg_loans interest_rate: not_null; numeric_range 0
stg_loans loan_term: not_null; accepted_values 12 24 36 48 60
stg_loans approval_rejection_date: not_null; date_is_past
stg_loans loan_status: not_null; accepted_values approved rejected closed
stg_transactions transaction_id: not_null; unique
stg_transactions account_id: not_null; relationships stg_accounts account_id
stg_transactions transaction_type: not_null; accepted_values transfer deposit withdrawal
int_accounts account_id: not_null; unique
int_accounts customer_id: not_null; relationships int_customers customer_id
int_accounts account_opening_date: not_null; date_is_past
int_customers customer_id: not_null; unique
int_customers branch_id: not_null
int_fx_rates currency_iso_code: not_null; unique
int_fx_rates fx_rate: not_null; numeric_range 0
int_fx_rates fx_rate_date: not_null; date_is_past
int_loans loan_id: not_null; unique
int_loans loan_amount: not_null; numeric_range 0
int_loans interest_rate: not_null; numeric_range 0
int_loans loan_term: not_null; accepted_values 12 24 36 48 60
int_loans approval_rejection_date: not_null; date_is_past
int_loans loan_status: not_null; accepted_values approved rejected closed
int_transactions transaction_id: not_null; unique
int_transactions transaction_amount: not_null; numeric_range 0
int_currencies currency_iso_code: not_null; unique
customer_transactions_summary transaction_date: not_null
customer_transactions_summary customer_id: not_null
customer_transactions_summary account_id: not_null
customer_transactions_summary branch_id: not_null
customer_transactions_summary total_amount_eur: not_null
customer_transactions_summary total_transactions: not_null
customer_transactions_summary transaction_date,customer_id,account_id,branch_id: unique_combination_of_columns
"""


def declared() -> list[tuple[str, str, str, list[str]]]:
    """(model, column, check, further words) of every declared check."""
    out = []
    for line in DECLARED.strip().splitlines():
        place, kinds = line.split(": ")
        model, column = place.split(" ")
        out += [(model, column, *[(k[0], k[1:]) for k in [kind.split(" ")]][0]) for kind in kinds.split("; ")]
    return out


def _codes(index: str) -> str:
    listed = ", ".join(f"'{c}'" for c in CURRENCY_CODES)
    return f"([{listed}])[CAST({index} + 1 AS BIGINT)]"


def _pick(words: list, by: str) -> str:
    listed = ", ".join(f"'{w}'" if isinstance(w, str) else str(w) for w in words)
    return f"([{listed}])[CAST({by} + 1 AS BIGINT)]"


def _amount_text(x: str, k: str) -> str:
    cents = f"CAST(round({x} * 100) AS BIGINT)"
    whole = f"({cents} // 100)"
    frac = f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    return f"""CASE WHEN {k} % 503 = 0 THEN 'n/a'
        WHEN {k} % 509 = 0 THEN NULL
        WHEN {k} % 4 = 0 THEN {whole} || '.' || {frac}
        WHEN {k} % 4 = 1 THEN {whole} || ',' || {frac}
        WHEN {k} % 4 = 2 AND {whole} >= 1000 THEN ({whole} // 1000) || '.'
            || lpad(CAST({whole} % 1000 AS VARCHAR), 3, '0') || ',' || {frac}
        ELSE ' ' || {whole} || ',' || {frac} || ' ' END"""


def _date_text(d: str, k: str, form: str) -> str:
    return f"""CASE WHEN {k} % 211 = 0 THEN ''
        WHEN {k} % 223 = 0 THEN NULL
        WHEN {k} % 227 = 0 THEN '31.02.2020'
        WHEN ({form}) % 5 = 0 THEN strftime({d}, '%Y-%m-%d')
        WHEN ({form}) % 5 = 1 THEN strftime({d}, '%d.%m.%Y')
        WHEN ({form}) % 5 = 2 THEN day({d}) || '/' || month({d}) || '/' || year({d})
        WHEN ({form}) % 5 = 3 AND day({d}) > 12 THEN strftime({d}, '%m/%d/%Y')
        WHEN ({form}) % 5 = 3 THEN strftime({d}, '%d/%m/%Y')
        ELSE year({d}) || '-' || month({d}) || '-' || day({d}) END"""


def _strptime(c: str, fmt: str) -> str:
    return f"CAST(try_strptime({c}, '{fmt}') AS DATE)"


SLASHED = r"^\d{1,2}/\d{1,2}/\d{4}$"


def _date(c: str) -> str:
    part = lambda n: f"TRY_CAST(split_part({c}, '/', {n}) AS INTEGER)"
    loose = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?$"
    return f"""CASE WHEN regexp_matches({c}, '^\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}$')
            THEN {_strptime(c, '%d.%m.%Y')}
        WHEN regexp_matches({c}, '{SLASHED}') AND {part(1)} <= 31 AND {part(2)} <= 12
            THEN {_strptime(c, '%d/%m/%Y')}
        WHEN regexp_matches({c}, '{SLASHED}') AND {part(1)} <= 12
            THEN {_strptime(c, '%m/%d/%Y')}
        WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$')
            THEN {_strptime(c, '%Y-%m-%d')}
        WHEN regexp_matches(trim({c}), '{loose}') THEN TRY_CAST(trim({c}) AS DATE) END"""


PLAIN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _plain(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{PLAIN}') THEN TRY_CAST({text} AS DOUBLE) END"


def _number(c: str) -> str:
    comma = f"replace(replace(trim({c}), '.', ''), ',', '.')"
    return f"""coalesce({_plain(c)},
        CASE WHEN contains({c}, ',') OR contains({c}, '.') THEN {_plain(comma)} END)"""


def _strip(c: str) -> str:
    characters = " || ".join(f"chr({code})" for code in WHITESPACE_CODES)
    return f"trim({c}, {characters})"


def _number_mixed(c: str) -> str:
    text = _strip(c)
    comma = f"replace(replace({text}, '.', ''), ',', '.')"
    dots = r"^[0-9]{1,3}(\.[0-9]{3})+$"
    return f"""coalesce({_plain(text)}, CASE WHEN contains({text}, ',')
        OR regexp_matches({text}, '{dots}') THEN {_plain(comma)} END)"""


FORMATS = (
    (SLASHED, "%d/%m/%Y"),
    (SLASHED, "%m/%d/%Y"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "%d.%m.%Y"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "%d-%m-%Y"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"),
)


def _format(c: str) -> str:
    tests = " ".join(
        f"WHEN regexp_matches({_strip(c)}, '{p}') AND try_strptime({_strip(c)}, '{f}') IS NOT NULL"
        f" THEN '{f}'"
        for p, f in FORMATS
    )
    return f"CASE {tests} END"


def _date_mixed(c: str) -> str:
    tests = " ".join(
        f"WHEN regexp_matches({_strip(c)}, '{p}') AND try_strptime({_strip(c)}, '{f}') IS NOT NULL"
        f" THEN {_strptime(_strip(c), f)}"
        for p, f in FORMATS
    )
    return f"CASE {tests} END"


def _shape(c: str, anchored: bool) -> str:
    text = _strip(c) if anchored else c
    tests = " ".join(
        f"WHEN regexp_matches({text}, '{'^' + p + '$' if anchored else p}') THEN '{name}'"
        for p, name in DATE_SHAPES
    )
    return f"CASE {tests} END"


def _issue(c: str) -> str:
    ends = "(' ', chr(9), chr(10))"
    leading, trailing = f"left({c}, 1) IN {ends}", f"right({c}, 1) IN {ends}"
    return f"""CASE WHEN {leading} AND {trailing} THEN 'both' WHEN {leading} THEN 'leading'
        WHEN {trailing} THEN 'trailing' END"""


def _email_error(c: str) -> str:
    text = _strip(c)
    local, domain = f"split_part({text}, '@', 1)", f"split_part({text}, '@', -1)"
    characters = r"^[a-zA-Z0-9!#$%&''*+\-/=?^_`{|}~.]+$"
    return f"""CASE WHEN {c} IS NULL THEN NULL
        WHEN {text} = '' THEN 'Email is empty'
        WHEN length({text}) > 254 THEN 'Email is too long (>254 characters)'
        WHEN NOT regexp_matches({text}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')
            THEN 'Email doesn''t match basic pattern (user@domain.tld)'
        WHEN length({local}) > 64 THEN 'Username part is too long (>64 characters)'
        WHEN NOT regexp_matches({local}, '{characters}')
            AND NOT (starts_with({local}, '"') AND ends_with({local}, '"'))
            THEN 'Username contains invalid characters'
        WHEN contains({local}, '..') THEN 'Username contains consecutive dots'
        WHEN NOT regexp_matches({domain}, '^[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')
            THEN 'Domain format is invalid'
        WHEN contains({domain}, '..') THEN 'Domain contains consecutive dots'
        WHEN regexp_matches({domain}, '(^|\\.)-|-(\\.|$)')
            THEN 'Domain part starts or ends with hyphen' END"""


def _flag(parsed: str, raw: str) -> str:
    return f"({parsed} IS NULL AND {raw} IS NOT NULL) AS has_date_parsing_error"


_EMAIL_CASES = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(EMAIL_FORMS))

CTES = {
    "raw_customers": f"""SELECT k AS customer_id,
        CASE WHEN k % 10 = 3 THEN ' ' || c_name ELSE c_name END AS firstname,
        'Family' || (k % 500) AS lastname,
        CAST(CASE WHEN k % 97 = 0 THEN 17 ELSE 18 + k % 60 END AS INTEGER) AS "Age",
        {_pick(['f', 'm', 'd'], 'k % 3')} AS "Gender",
        'Street ' || (k % 700) AS "Address",
        CASE WHEN k % 8 = 5 THEN chr(9) || c_mktsegment || ' ' ELSE c_mktsegment END AS "City",
        49000000000 + k AS "Contact Number",
        CASE k % 11 {_EMAIL_CASES} END AS "Email",
        lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || '.'
            || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '.' || (2000 + k % 24)
            AS creation_date,
        CASE WHEN k % 50 <> 0 THEN c_nationkey END AS branch_id
        FROM (SELECT c_custkey AS k, * FROM customer
              UNION ALL SELECT c_custkey AS k, * FROM customer WHERE c_custkey % 20 = 0)""",
    "raw_contacts": """SELECT k AS customer_id,
        CASE WHEN k % 11 = 5 THEN NULL WHEN k % 2 = 0 THEN ' P' || (k // 3) || '@MAIL.de'
             ELSE 'p' || (k // 3) || '@mail.de ' END AS "Email",
        CASE WHEN k % 7 <> 3 THEN 49000000000 + (k + 1) // 4 END AS "Contact Number",
        CASE WHEN k % 40 = 0 THEN 'Name' || (k // 40 % 25) ELSE c_name END AS name
        FROM (SELECT c_custkey AS k, * FROM customer)""",
    "wide_lines": "SELECT l_quantity, l_extendedprice, "
    + ", ".join(
        f"""CASE WHEN l_orderkey % {31 + i} <> 0
            THEN CAST((l_orderkey * {i + 3} + l_linenumber) % {17 + i} AS DOUBLE) END AS m{i}"""
        for i in range(28)
    )
    + " FROM lineitem",
    "raw_accounts": f"""SELECT o_orderkey AS account_id,
        CASE WHEN o_orderkey % 1000 = 0 THEN -1 ELSE o_custkey END AS customer_id,
        CASE WHEN o_orderkey % 100 = 7 THEN '-' WHEN o_orderkey % 100 = 8 THEN NULL
             WHEN o_orderkey % 100 = 9 THEN '' WHEN o_orderkey % 100 = 11 THEN ' - '
             WHEN o_orderkey % 2 = 0 THEN 'savings' ELSE 'current' END AS account_type,
        {_date_text('o_orderdate', 'o_orderkey', 'o_orderkey')} AS account_opening_date
        FROM orders""",
    "raw_transactions": f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
        {_date_text('l_shipdate', 'l_orderkey', 'l_orderkey + l_linenumber')} AS transaction_date,
        l_orderkey AS account_id,
        {_pick(['transfer', 'deposit', ' withdrawal'], 'l_linenumber % 3')} AS transaction_type,
        {_amount_text('l_extendedprice', 'l_orderkey')} AS transaction_amount,
        CASE WHEN l_orderkey % 1009 = 0 THEN 'RON1'
             WHEN l_linenumber = 3 THEN ' ' || {_codes('l_suppkey % 25')} || ' '
             ELSE {_codes('l_suppkey % 25')} END AS transaction_currency
        FROM lineitem""",
    "raw_loans": f"""SELECT o_custkey AS customer_id, o_orderkey AS loan_id,
        {_amount_text('o_totalprice', 'o_orderkey')} AS loan_amount,
        {_pick(['personal', 'mortgage', 'auto'], 'o_orderkey % 3')} AS loant_type,
        ((o_orderkey % 900 + 100) // 100) || ','
            || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS interest_rate,
        CAST({_pick([12, 24, 36, 48, 60], 'o_orderkey % 5')} AS INTEGER) AS loan_term,
        {_date_text('o_orderdate', 'o_orderkey', 'o_orderkey + 2')} AS approval_rejection_date,
        CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'approved'
             ELSE 'rejected' END AS loan_status
        FROM orders""",
    "raw_fx_rates": f"""SELECT
        CASE WHEN n % 4 = 1 THEN ' ' || {_codes('n')} ELSE {_codes('n')} END AS currency_iso_code,
        CASE WHEN n % 3 = 1 THEN ((50 + n * 7) // 100) || '.'
                || lpad(CAST((50 + n * 7) % 100 AS VARCHAR), 2, '0')
             WHEN n % 3 = 2 THEN ' ' || ((50 + n * 7) // 100) || ','
                || lpad(CAST((50 + n * 7) % 100 AS VARCHAR), 2, '0') || ' '
             ELSE ((50 + n * 7) // 100) || ','
                || lpad(CAST((50 + n * 7) % 100 AS VARCHAR), 2, '0') END AS fx_rate,
        '15.03.2024' AS date, CAST(NULL AS VARCHAR) AS "Column4"
        FROM (SELECT DISTINCT s_nationkey AS n FROM supplier
              WHERE s_nationkey <> {NATION_WITHOUT_RATE})
        UNION ALL SELECT CASE s_suppkey % 10 WHEN 1 THEN '(none)' WHEN 2 THEN ' (none) '
             WHEN 3 THEN '' END, '1,00', '15.03.2024', 'x'
        FROM supplier WHERE s_suppkey % 10 IN (1, 2, 3, 4)""",
    "raw_currencies": f"""SELECT
        CASE WHEN s_suppkey % 10 = 1 THEN 'Historic unit'
             WHEN s_nationkey = 1 AND s_suppkey % 2 = 0 THEN 'United States dollar'
             ELSE 'Unit ' || {_codes('s_nationkey')} END AS currency,
        CASE WHEN s_suppkey % 10 = 1 THEN '(none)' WHEN s_suppkey % 10 = 3 THEN ''
             WHEN s_suppkey % 10 = 4 THEN NULL
             WHEN s_suppkey % 3 = 2 THEN ' ' || {_codes('s_nationkey')}
             ELSE {_codes('s_nationkey')} END AS currency_iso_code
        FROM supplier""",
    "stg_accounts": f"""SELECT account_id, customer_id, account_type,
        parsed AS account_opening_date, {_flag('parsed', 'account_opening_date')}
        FROM (SELECT *, {_date('account_opening_date')} AS parsed FROM raw_accounts
              WHERE account_type IS NOT NULL AND account_type NOT IN ('', '-'))""",
    "stg_customers": """SELECT DISTINCT customer_id, trim(firstname) AS firstname,
        trim(lastname) AS lastname, "Age" AS age, branch_id FROM raw_customers""",
    "stg_fx_rates": f"""SELECT trim(currency_iso_code) AS currency_iso_code,
        {_number('fx_rate')} AS fx_rate, parsed AS fx_rate_date, {_flag('parsed', 'date')}
        FROM (SELECT *, {_date('date')} AS parsed FROM raw_fx_rates
              WHERE currency_iso_code IS NOT NULL
                AND trim(currency_iso_code) NOT IN ('(none)', ''))""",
    "stg_loans": f"""SELECT customer_id, loan_id, {_number('loan_amount')} AS loan_amount,
        loant_type AS loan_type, {_number('interest_rate')} AS interest_rate, loan_term,
        parsed AS approval_rejection_date, loan_status,
        {_flag('parsed', 'approval_rejection_date')}
        FROM (SELECT *, {_date('approval_rejection_date')} AS parsed FROM raw_loans)""",
    "stg_transactions": f"""SELECT transaction_id, parsed AS transaction_date, account_id,
        trim(transaction_type) AS transaction_type,
        {_number('transaction_amount')} AS transaction_amount,
        trim(transaction_currency) AS transaction_currency,
        {_flag('parsed', 'transaction_date')}
        FROM (SELECT *, {_date('transaction_date')} AS parsed FROM raw_transactions)""",
    **{
        f"int_{n}": f"""SELECT * EXCLUDE (has_date_parsing_error) FROM stg_{n}
        WHERE NOT has_date_parsing_error"""
        for n in ("accounts", "fx_rates", "loans", "transactions")
    },
    "int_customers": "SELECT * FROM stg_customers",
    "int_currencies": """SELECT DISTINCT trim(currency) AS currency,
        trim(currency_iso_code) AS currency_iso_code FROM raw_currencies
        WHERE currency_iso_code IS NOT NULL AND trim(currency_iso_code) <> '(none)'""",
    "priced": """SELECT t.transaction_id, t.account_id, t.transaction_date,
        t.transaction_amount, t.transaction_currency AS currency_iso_code,
        coalesce(f.fx_rate, 1.0) AS exchange_rate_to_eur,
        CASE WHEN t.transaction_currency = 'EUR' THEN t.transaction_amount
             ELSE t.transaction_amount * coalesce(f.fx_rate, 1.0) END AS amount_eur
        FROM int_transactions t
        LEFT JOIN int_fx_rates f ON t.transaction_currency = f.currency_iso_code""",
    "customer_transactions_summary": """SELECT p.transaction_date, a.customer_id, p.account_id,
        coalesce(CAST(c.branch_id AS VARCHAR), 'Unknown') AS branch_id,
        sum(p.amount_eur) AS total_amount_eur, count(*) AS total_transactions
        FROM priced p JOIN int_accounts a ON p.account_id = a.account_id
        LEFT JOIN int_customers c ON a.customer_id = c.customer_id GROUP BY ALL""",
    "dated_orders": """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 97 = 0
        THEN o_orderdate - INTERVAL 30 YEAR ELSE o_orderdate END AS DATE) AS order_date
        FROM orders""",
    "density_spread": """SELECT transaction_type AS category, count(transaction_amount) AS total,
        stddev_samp(transaction_amount / 1000) AS std, min(transaction_amount / 1000) AS low,
        max(transaction_amount / 1000) AS high FROM int_transactions
        WHERE transaction_type IS NOT NULL GROUP BY 1""",
}


def _with(body: str) -> str:
    """Prefix a query with the named feeds and models it uses, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    listed = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {listed}\n{body}" if listed else body


def _value_counts(table: str, columns: list[str], texts: dict[str, str] | None = None) -> str:
    texts = texts or {}
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({texts.get(c, f'"{c}"')} AS VARCHAR) AS value,
        count(*) AS n FROM {table} GROUP BY 2"""
        for c in columns
    )


LOAN_TEXTS = ("loan_amount", "loant_type", "interest_rate", "approval_rejection_date", "loan_status")
CUSTOMER_TEXTS = (
    "firstname", "lastname", "Gender", "Address", "City", "Email", "creation_date",
)
CUSTOMER_COLUMNS = (
    "customer_id", "firstname", "lastname", "Age", "Gender", "Address", "City",
    "Contact Number", "Email", "creation_date", "branch_id",
)
LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def _recommendations(table: str, columns: tuple[str, ...], date_test) -> str:
    german = r"^[0-9]+(\.[0-9]{3})*(,[0-9]+)?$"
    parts = []
    for c in columns:
        for kind, test in (
            ("numeric", f"regexp_matches(\"{c}\", '{german}')"),
            ("date", date_test(f'"{c}"')),
            ("whitespace", f'"{c}" <> {_strip(chr(34) + c + chr(34))}'),
        ):
            ratio = f'count(*) FILTER (WHERE {test}) * 1.0 / count("{c}")'
            limit = "> 0" if kind == "whitespace" else "> 0.5"
            parts.append(
                f"""SELECT '{c}' AS "column", '{kind}' AS kind,
                count(*) FILTER (WHERE {test}) AS matching, count("{c}") AS non_null,
                round({ratio}, 6) AS ratio, {ratio} {limit} AS recommended
                FROM {table} HAVING count("{c}") > 0"""
            )
    return " UNION ALL ".join(parts)


def _iqr(table: str, c: str, digits: int = 4) -> str:
    return f"""SELECT '{c}' AS "column", round(q1, {digits}) AS q1, round(q3, {digits}) AS q3,
        round(q3 - q1, {digits}) AS iqr, round(q1 - 1.5 * (q3 - q1), {digits}) AS lower_bound,
        round(q3 + 1.5 * (q3 - q1), {digits}) AS upper_bound,
        count(*) FILTER (WHERE "{c}" < q1 - 1.5 * (q3 - q1) OR "{c}" > q3 + 1.5 * (q3 - q1))
            AS outliers_count,
        round(100.0 * count(*) FILTER (WHERE "{c}" < q1 - 1.5 * (q3 - q1)
            OR "{c}" > q3 + 1.5 * (q3 - q1)) / count(*), {digits}) AS outliers_percentage
        FROM {table}, (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.75) AS q3
                       FROM {table}) GROUP BY q1, q3"""


def _iqr_values(table: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(row_number() OVER (ORDER BY count(*) DESC,
            CAST(CAST("{c}" AS DOUBLE) AS VARCHAR)) AS INTEGER) AS rank,
        CAST("{c}" AS DOUBLE) AS value, count(*) AS n
        FROM {table}, (SELECT quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.75) AS q3
                       FROM {table})
        WHERE "{c}" < q1 - 1.5 * (q3 - q1) OR "{c}" > q3 + 1.5 * (q3 - q1)
        GROUP BY "{c}" QUALIFY rank <= 10"""


def _boxplot(table: str, c: str, by: str | None, digits: int = 4) -> str:
    group = f"{by}, " if by else ""
    join = f"JOIN q USING ({by})" if by else ", q"
    return f"""SELECT {group}round(q1, {digits}) AS q1, round(median, {digits}) AS median,
        round(q3, {digits}) AS q3, count({c}) AS n,
        round(min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1)), {digits}) AS whisker_low,
        round(max({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1)), {digits}) AS whisker_high,
        count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS fliers
        FROM {table} {join} GROUP BY {group}q.q1, q.median, q.q3"""


def _quartiles(table: str, c: str, by: str | None) -> str:
    group = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""SELECT {group}quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
        quantile_cont({c}, 0.75) AS q3 FROM {table} {tail}"""


def _numeric_profile(table: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, round(CAST(min({c}) AS DOUBLE), 4) AS min,
        round(CAST(max({c}) AS DOUBLE), 4) AS max, round(avg({c}), 4) AS mean,
        round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std,
        round(skewness({c}), 4) AS skew, round(quantile_cont({c}, 0.25), 4) AS q1,
        round(quantile_cont({c}, 0.75), 4) AS q3 FROM {table}"""


def _check_failures(model: str, column: str, kind: str, words: list[str]) -> str:
    rows = lambda condition: f"SELECT count(*) FROM {model} WHERE {condition}"
    if kind == "not_null":
        return rows(f"{column} IS NULL")
    if kind == "date_is_past":
        return rows(f"{column} > {DAY}")
    if kind == "numeric_range":
        upper = f" OR {column} > {words[1]}" if len(words) > 1 else ""
        return rows(f"{column} < {words[0]}{upper}")
    if kind == "accepted_values":
        listed = ", ".join(w if w.isdigit() else f"'{w}'" for w in words)
        return f"SELECT count(DISTINCT {column}) FROM {model} WHERE {column} NOT IN ({listed})"
    if kind == "relationships":
        to, key = words
        return rows(
            f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {to} WHERE {key} IS NOT NULL)"
        )
    present = f"WHERE {column} IS NOT NULL" if kind == "unique" else ""
    return f"SELECT count(*) FROM (SELECT 1 FROM {model} {present} GROUP BY {column} HAVING count(*) > 1)"


def _suite() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c[0]}' AS model, '{c[1]}' AS "column", '{c[2]}' AS "check",
        ({_check_failures(*c)}) AS failures, ({_check_failures(*c)}) = 0 AS passed"""
        for c in declared()
    )


def _observed() -> str:
    """Failing rows of the checks that look at single rows, for the layers that are stored."""
    kinds = ("not_null", "date_is_past", "numeric_range", "accepted_values")
    stored = [c for c in declared() if c[2] in kinds and not c[0].startswith("stg_")]
    failures = lambda c: _check_failures(*c).replace(f"count(DISTINCT {c[1]})", "count(*)")
    return " UNION ALL ".join(
        f"""SELECT '{c[0]}' AS model, '{c[1]}' AS "column", '{c[2]}' AS "check",
        ({failures(c)}) AS failures, ({failures(c)}) = 0 AS passed"""
        for c in stored
    )


def _fk(parent: str, pk: str, child: str, fk: str) -> str:
    orphan = f"{fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM raw_{parent})"
    return f"""SELECT '{parent}_{child}' AS relationship, '{parent}' AS parent_table,
        '{pk}' AS parent_key, (SELECT count(*) FROM raw_{parent}) AS parent_record_count,
        '{child}' AS child_table, '{fk}' AS foreign_key, count(*) AS child_record_count,
        count({fk}) AS non_null_foreign_keys, count(*) - count({fk}) AS null_foreign_keys,
        round(100.0 * (count(*) - count({fk})) / count(*), 6) AS null_percentage,
        count(*) FILTER (WHERE {orphan}) AS orphaned_records,
        round(100.0 * count(*) FILTER (WHERE {orphan}) / count({fk}), 6) AS orphaned_percentage,
        count(*) FILTER (WHERE {orphan}) = 0 AS relationship_valid,
        CAST(NULL AS VARCHAR) AS error FROM raw_{child}"""


def _type_name(t: str) -> str:
    """One set of type names for both engines."""
    names = {
        "INTEGER": "int", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>",
        "TIMESTAMP WITH TIME ZONE": "timestamp",
    }
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items())
    return f"CASE {t} {cases} ELSE lower({t}) END"


def _catalog_columns() -> str:
    # COLUMNS(*) counts every column of a table, whatever its name.
    parts = []
    for t in TABLES:
        parts.append(
            f"""SELECT '{t}' AS table_name, c.column_name, {_type_name("d.column_type")} AS data_type,
            ordinal, (SELECT count(*) FROM {t}) AS row_count, present
            FROM (SELECT *, CAST(row_number() OVER () AS INTEGER) AS ordinal
                  FROM (UNPIVOT (SELECT count(COLUMNS(*)) AS '\\0' FROM {t})
                        ON COLUMNS(*) INTO NAME column_name VALUE present)) c
            JOIN (DESCRIBE SELECT * FROM {t}) d ON d.column_name = c.column_name"""
        )
    return " UNION ALL ".join(parts)


def _email_valid(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN ({_email_error(c)}) IS NULL END"


def _whitespace(c: str) -> str:
    count = lambda kind: f"count(*) FILTER (WHERE issue = '{kind}')"
    return f"""SELECT '{c}' AS "column", count(*) AS total_values, count(v) AS non_null_values,
        {count('leading')} AS leading_whitespace_count,
        {count('trailing')} AS trailing_whitespace_count,
        {count('both')} AS both_sides_whitespace_count,
        count(issue) AS total_whitespace_issues,
        round(100.0 * count(issue) / count(v), 6) AS whitespace_percentage
        FROM (SELECT "{c}" AS v, {_issue(f'"{c}"')} AS issue FROM raw_customers)
        HAVING count(issue) > 0"""


def _changes() -> str:
    entries = (
        ("loan_amount", "whitespace", _strip("loan_amount")),
        ("interest_rate", "numeric", _number_mixed("interest_rate")),
        ("approval_rejection_date", "date", _date_mixed("approval_rejection_date")),
    )
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS kind, {c} AS original,
        CAST({cleaned} AS VARCHAR) AS cleaned FROM raw_loans"""
        for c, kind, cleaned in entries
    )


def _monotonic(column: str, expression: str) -> str:
    return f"""SELECT '{column}' AS "column", count(DISTINCT v) = count(*) AS is_unique,
        bool_and(coalesce(v >= p, true)) AS is_monotonic_inc,
        bool_and(coalesce(v <= p, true)) AS is_monotonic_dec,
        bool_and(coalesce(v >= p, true)) OR bool_and(coalesce(v <= p, true)) AS is_monotonic
        FROM (SELECT {expression} AS v, lag({expression}) OVER (ORDER BY o_orderkey) AS p
              FROM orders)"""


def _sampled(counts: str, n: int) -> str:
    return f"""SELECT "column", value FROM ({counts}) WHERE value IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY md5('42:' || value), value) <= {n}"""


def _histogram(table: str, expression: str, bins: str) -> str:
    return f"""SELECT CAST(bin AS INTEGER) AS bin,
        round(low + bin * ((high - low) / bins), 6) AS low,
        round(low + (bin + 1) * ((high - low) / bins), 6) AS high,
        (SELECT count(*) FROM {table}
         WHERE {expression} IS NOT NULL AND least(floor(({expression} - low) / ((high - low) / bins)), bins - 1) = bin) AS n
        FROM (SELECT low, high, bins, unnest(range(bins)) AS bin FROM
            (SELECT min({expression}) AS low, max({expression}) AS high, {bins} AS bins
             FROM {table}))"""


_T = "int_transactions"
_DAYS = "CAST(transaction_date - DATE '1970-01-01' AS DOUBLE)"

WIDE = ["l_quantity", "l_extendedprice", *(f"m{i}" for i in range(28))]
# Reached ids by recursion; Spark finds the classes in rounds.
_LINKED = """WITH RECURSIVE entry AS (
        SELECT customer_id, 'email' AS kind, lower(trim("Email")) AS value FROM raw_contacts
        UNION ALL SELECT customer_id, 'phone', CAST("Contact Number" AS VARCHAR) FROM raw_contacts
        UNION ALL SELECT customer_id, 'name', name FROM raw_contacts),
    link AS (SELECT DISTINCT x.customer_id AS a, y.customer_id AS b FROM entry x
        JOIN entry y USING (kind, value)),
    reach AS (SELECT customer_id AS person, customer_id AS seen FROM raw_contacts
        UNION SELECT person, b FROM reach JOIN link ON a = seen)
    SELECT person, min(seen) AS class FROM reach GROUP BY person"""

BODIES = {
    **{n: f"SELECT * FROM {n}" for n in CTES if n.startswith(("stg_", "int_"))},
    # Loaded day by day, or joined bucket by bucket, the reporting table is the same.
    **{
        n: """SELECT * REPLACE (round(total_amount_eur, 4)
        AS total_amount_eur, CAST(total_transactions AS BIGINT) AS total_transactions)
        FROM customer_transactions_summary"""
        for n in ("customer_transactions_summary", "summary_daily_merge", "summary_from_buckets")
    },
    "transactions_in_eur": """SELECT * REPLACE (round(transaction_amount, 4)
        AS transaction_amount, round(exchange_rate_to_eur, 4) AS exchange_rate_to_eur,
        round(amount_eur, 4) AS amount_eur) FROM priced""",
    "transactions_with_account": """SELECT t.transaction_id, t.account_id, a.customer_id,
        t.transaction_date, t.transaction_amount, t.transaction_currency AS currency_iso_code,
        t.transaction_type FROM int_transactions t
        JOIN int_accounts a ON t.account_id = a.account_id""",
    # An empty text and a missing one are the same in delimited text.
    "currency_reference": """SELECT currency, nullif(currency_iso_code, '')
        AS currency_iso_code FROM raw_currencies""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "catalog_tables": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count,
        CAST((SELECT count(*) FROM (UNPIVOT (SELECT count(COLUMNS(*)) AS '\\0' FROM {t})
        ON COLUMNS(*) INTO NAME c VALUE v)) AS INTEGER) AS columns FROM {t}"""
        for t in TABLES
    ),
    "catalog_columns": _catalog_columns(),
    "naming_issues": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count("{c}") AS present
        FROM raw_{t}"""
        for t, c in (
            ("customers", "Age"), ("customers", "Gender"), ("customers", "Address"),
            ("customers", "City"), ("customers", "Contact Number"), ("customers", "Email"),
            ("fx_rates", "Column4"),
        )
    ),
    "sampled_table": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "filter_lookup": "SELECT * FROM raw_customers WHERE customer_id = 77",
    "filter_in_list": """SELECT * FROM int_transactions WHERE transaction_currency IN
        ('EUR', 'GBP', 'JPY', 'CAD', 'SGD', 'NOK', 'PLN', 'HUF', 'BGN', 'ZAR', 'MXN', 'CNY', 'THB')""",
    "filter_contains_ci": """SELECT transaction_id, transaction_currency FROM raw_transactions
        WHERE contains(lower(transaction_currency), 'ron')""",
    "topk_rates": """SELECT loan_id, interest_rate FROM int_loans
        ORDER BY interest_rate DESC NULLS LAST, loan_id LIMIT 10""",
    "rows_with_total": """SELECT loan_amount, interest_rate, total_rows FROM
        (SELECT *, count(*) OVER () AS total_rows FROM int_loans) ORDER BY loan_id LIMIT 100""",
    "column_samples": _sampled(_value_counts("raw_customers", list(CUSTOMER_COLUMNS)), 5),
    "clean_dates_sql": f"""SELECT transaction_id, transaction_date AS raw,
        {_date('transaction_date')} AS parsed FROM raw_transactions""",
    "clean_dates_written": """SELECT l_orderkey, l_linenumber, CASE
        WHEN form % 97 = 0 THEN '31 Feb 2020'
        WHEN form % 5 = 0 THEN strftime(l_shipdate, '%-d %b %Y')
        WHEN form % 5 = 1 THEN strftime(l_shipdate, '%b %-d, %Y')
        WHEN form % 5 = 2 THEN strftime(l_shipdate, '%B %-d, %Y')
        WHEN form % 5 = 3 THEN strftime(l_shipdate, '%-d %B %Y')
        ELSE strftime(l_shipdate, '%Y%m%d') END AS raw,
        CASE WHEN form % 97 <> 0 THEN CAST(l_shipdate AS DATE) END AS parsed
        FROM (SELECT *, l_orderkey + l_linenumber AS form FROM lineitem)""",
    "clean_dates_lib": f"""SELECT transaction_id, {_date_mixed('transaction_date')} AS parsed
        FROM raw_transactions""",
    "detect_date_formats": f"""SELECT transaction_id, {_format('transaction_date')} AS format
        FROM raw_transactions""",
    "clean_numbers_sql": f"""SELECT transaction_id, transaction_amount AS raw,
        {_number('transaction_amount')} AS parsed FROM raw_transactions""",
    "clean_numbers_lib": f"""SELECT transaction_id, transaction_amount AS raw,
        {_number_mixed('transaction_amount')} AS parsed FROM raw_transactions""",
    "clean_whitespace": f"""SELECT customer_id, {_strip('firstname')} AS firstname,
        {_strip('"City"')} AS "City", {_strip('"Email"')} AS "Email" FROM raw_customers""",
    "clean_table": f"""SELECT customer_id, loan_id,
        {_strip('loan_amount')} AS loan_amount, loant_type,
        round({_number_mixed('interest_rate')}, 6) AS interest_rate, loan_term,
        {_date_mixed('approval_rejection_date')} AS approval_rejection_date, loan_status
        FROM raw_loans""",
    "surrogate_keys": """SELECT account_id, md5(concat_ws('-',
        coalesce(CAST(account_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(CAST(customer_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
        coalesce(account_type, '_dbt_utils_surrogate_key_null_'))) AS surrogate_key
        FROM raw_accounts""",
    "email_validation": f"""SELECT customer_id, "Email",
        {_email_valid('"Email"')} AS "Email_is_valid",
        {_email_error('"Email"')} AS email_error FROM raw_customers""",
    "check_not_null": "SELECT * FROM stg_customers WHERE branch_id IS NULL",
    "check_unique": """SELECT transaction_id AS value, count(*) AS n FROM stg_transactions
        WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "check_accepted_values": """SELECT account_type AS value, count(*) AS n FROM stg_accounts
        WHERE account_type NOT IN ('savings', 'current') GROUP BY 1""",
    "check_relationships": """SELECT account_id FROM stg_transactions WHERE account_id IS NOT NULL
        AND account_id NOT IN (SELECT account_id FROM stg_accounts)""",
    "check_numeric_range": "SELECT * FROM stg_customers WHERE age < 18 OR age > 200",
    "check_date_is_past": f"SELECT * FROM stg_loans WHERE approval_rejection_date > {DAY}",
    "check_is_bool": """SELECT CAST(l_linenumber AS INTEGER) AS test_field FROM lineitem
        WHERE l_linenumber > 1""",
    "check_unique_combination": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_suite_summary": _suite(),
    "observed_checks": _observed(),
    "check_summary_keys": f"""SELECT {', '.join(SUMMARY_KEYS)}, count(*) AS n
        FROM customer_transactions_summary GROUP BY ALL HAVING count(*) > 1""",
    "fk_orphans": """SELECT * FROM raw_accounts WHERE customer_id IS NOT NULL
        AND customer_id NOT IN (SELECT customer_id FROM raw_customers)""",
    "fk_orphan_examples": """SELECT * FROM raw_accounts WHERE customer_id IS NOT NULL
        AND customer_id NOT IN (SELECT customer_id FROM raw_customers)
        ORDER BY account_id LIMIT 5""",
    "fk_report": " UNION ALL ".join(
        (
            _fk("customers", "customer_id", "accounts", "customer_id"),
            _fk("customers", "customer_id", "loans", "customer_id"),
            _fk("accounts", "account_id", "transactions", "account_id"),
        )
    ),
    "currency_counts": """SELECT transaction_currency AS currency, count(*) AS n,
        transaction_currency IN (SELECT currency_iso_code FROM raw_fx_rates
            WHERE currency_iso_code IS NOT NULL) AS has_rate
        FROM raw_transactions WHERE transaction_currency IS NOT NULL GROUP BY 1""",
    "currency_coverage": """SELECT count(DISTINCT c) AS distinct_transaction_currencies,
        (SELECT count(*) FROM (SELECT DISTINCT currency_iso_code FROM raw_fx_rates))
            AS distinct_fx_currencies,
        count(DISTINCT c) FILTER (WHERE NOT known) AS missing_currency_count,
        count(*) AS total_transactions,
        count(c) FILTER (WHERE NOT known) AS transactions_with_missing_fx,
        round(100.0 * count(c) FILTER (WHERE NOT known) / count(*), 6) AS missing_fx_percentage,
        count(c) FILTER (WHERE NOT known) = 0 AS currency_coverage_valid
        FROM (SELECT transaction_currency AS c, transaction_currency IN
              (SELECT currency_iso_code FROM raw_fx_rates WHERE currency_iso_code IS NOT NULL)
              AS known FROM raw_transactions)""",
    "id_duplicates": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
        CAST(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS BIGINT) AS missing_count,
        round(100.0 * coalesce(sum(n) FILTER (WHERE v IS NULL), 0) / sum(n), 6)
            AS missing_percentage,
        count(*) FILTER (WHERE v IS NOT NULL AND n > 1) > 0 AS has_duplicates,
        count(*) FILTER (WHERE v IS NOT NULL AND n > 1) AS duplicate_values_count,
        CAST(coalesce(sum(n) FILTER (WHERE v IS NOT NULL AND n > 1), 0) AS BIGINT)
            AS records_with_duplicates,
        coalesce(sum(n) FILTER (WHERE v IS NOT NULL AND n > 1), 0) > 100 AS too_many_to_list
        FROM (SELECT "{c}" AS v, count(*) AS n FROM raw_customers GROUP BY 1)"""
        for c in ("customer_id", "Contact Number", "branch_id")
    )
    # first names only count as identifiers where they are nearly unique
    + """ UNION ALL SELECT 'firstname', 0, 0.0, true, count(*) FILTER (WHERE n > 1),
        CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT), sum(n) FILTER (WHERE n > 1) > 100
        FROM (SELECT firstname AS v, count(*) AS n FROM raw_customers GROUP BY 1)
        HAVING count(v) > 0.95 * sum(n)""",
    "id_duplicate_values": f"""SELECT * FROM
        ({_value_counts('raw_customers', ['customer_id', 'Address'])})
        WHERE value IS NOT NULL AND n > 1""",
    "duplicate_records": """SELECT * FROM raw_transactions WHERE transaction_id IN
        (SELECT transaction_id FROM raw_transactions GROUP BY 1 HAVING count(*) > 1)""",
    "listed_duplicates": """SELECT transaction_id, transaction_amount, transaction_currency,
        (SELECT sum(n) > 100 FROM (SELECT count(*) AS n FROM raw_transactions
         GROUP BY transaction_id HAVING count(*) > 1)) AS truncated
        FROM raw_transactions WHERE transaction_id IN
        (SELECT transaction_id FROM raw_transactions GROUP BY 1 HAVING count(*) > 1)
        ORDER BY transaction_id, transaction_amount NULLS FIRST, transaction_currency LIMIT 100""",
    "composite_key_duplicates": """SELECT * FROM raw_transactions QUALIFY count(*) OVER
        (PARTITION BY account_id, transaction_date, transaction_type) > 1""",
    "composite_key_summary": """SELECT 'transaction_id,account_id' AS columns,
        count(*) > 0 AS has_duplicates, CAST(coalesce(sum(n), 0) AS BIGINT)
        AS duplicate_records_count FROM (SELECT count(*) AS n FROM raw_transactions
        GROUP BY transaction_id, account_id HAVING count(*) > 1)""",
    "dedupe_keep_last": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
        l_extendedprice, l_quantity FROM lineitem QUALIFY row_number() OVER
        (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
         l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1""",
    "repeat_count": """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
        CAST(sum(n - 1) AS BIGINT) AS repeats FROM (SELECT count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber)""",
    "id_properties": " UNION ALL ".join(
        (
            _monotonic("o_orderkey", "o_orderkey"),
            _monotonic("falling", "-o_orderkey"),
            _monotonic("o_custkey", "o_custkey"),
        )
    ),
    "digit_counts": """SELECT CAST(length(CAST(transaction_id AS VARCHAR)) AS INTEGER) AS digits,
        count(*) AS n FROM raw_transactions GROUP BY 1""",
    "shared_contact_ids": """SELECT "Email", count(*) AS records,
        count(DISTINCT customer_id) AS persons FROM raw_customers WHERE "Email" IS NOT NULL
        GROUP BY 1 HAVING count(DISTINCT customer_id) > 1""",
    "shared_contact_records": """SELECT customer_id, "Email" FROM raw_customers
        WHERE "Email" IS NOT NULL QUALIFY count(*) OVER (PARTITION BY "Email") > 1""",
    "value_counts": """SELECT transaction_currency AS value, count(*) AS n FROM int_transactions
        WHERE transaction_currency IS NOT NULL GROUP BY 1""",
    "top_value_counts": """SELECT "City" AS value, count(*) AS n FROM raw_customers
        WHERE "City" IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
    "profile_counts": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_type_name(f"any_value(typeof({e}))")} AS data_type, count(*) AS count, count(*) - count({e}) AS missing,
        round(100.0 * (count(*) - count({e})) / count(*), 6) AS missing_percentage,
        count(DISTINCT {e}) AS unique_values,
        round(100.0 * count(DISTINCT {e}) / count(*), 6) AS unique_percentage,
        count({e}) = 0 AS all_missing FROM lineitem"""
        for c, e in [(c, c) for c in LINEITEM_COLUMNS] + [("l_empty", "CAST(NULL AS VARCHAR)")]
    ),
    "total_missing": """SELECT 6 * count(*) - count(transaction_id) - count(transaction_date)
        - count(account_id) - count(transaction_type) - count(transaction_amount)
        - count(transaction_currency) AS missing_cells FROM int_transactions""",
    "profile_numeric": " UNION ALL ".join(
        _numeric_profile("int_loans", c)
        for c in ("customer_id", "loan_id", "loan_amount", "interest_rate", "loan_term")
    ),
    "profile_categorical": f"""SELECT "column", CAST(row_number() OVER (PARTITION BY "column"
            ORDER BY n DESC, value) AS INTEGER) AS rank, value, n,
        round(100.0 * n / (SELECT count(*) FROM {_T}), 6) AS percentage FROM
        ({_value_counts(_T, ['transaction_type', 'transaction_currency'])})
        WHERE value IS NOT NULL QUALIFY rank <= 5""",
    "profile_dates": """SELECT 'transaction_date' AS "column",
        CAST(min(transaction_date) AS TIMESTAMP) AS min_date,
        CAST(max(transaction_date) AS TIMESTAMP) AS max_date,
        CAST(max(transaction_date) - min(transaction_date) AS BIGINT) AS range_days
        FROM int_transactions""",
    "date_distribution": f"""SELECT count(*) AS rows,
        count(*) - count(transaction_date) AS missing,
        count(*) FILTER (WHERE transaction_date > {DAY}) AS future_dates,
        min(transaction_date) AS min_date, max(transaction_date) AS max_date,
        CAST(max(transaction_date) - min(transaction_date) AS INTEGER) AS range_days,
        round(avg({_DAYS}), 4) AS mean_days, round(stddev_samp({_DAYS}), 4) AS std_days,
        quantile_cont({_DAYS}, 0.25) AS q1_days, quantile_cont({_DAYS}, 0.5) AS median_days,
        quantile_cont({_DAYS}, 0.75) AS q3_days,
        quantile_cont({_DAYS}, 0.75) - quantile_cont({_DAYS}, 0.25) AS iqr_days
        FROM int_transactions""",
    "future_date_examples": f"""SELECT transaction_date AS date FROM int_transactions
        WHERE transaction_date > {DAY} ORDER BY 1 DESC LIMIT 5""",
    "date_year_month_counts": """SELECT 'year' AS part, CAST(year(transaction_date) AS INTEGER)
        AS value, count(*) AS n FROM int_transactions WHERE transaction_date IS NOT NULL
        GROUP BY 2 UNION ALL SELECT 'month', CAST(month(transaction_date) AS INTEGER), count(*)
        FROM int_transactions WHERE transaction_date IS NOT NULL GROUP BY 2""",
    "grouped_stats": """SELECT loan_type, count(interest_rate) AS count,
        round(avg(interest_rate), 6) AS mean, round(quantile_cont(interest_rate, 0.5), 6)
        AS median, round(stddev_samp(interest_rate), 6) AS std FROM int_loans GROUP BY 1""",
    "group_size_stats": """SELECT count(*) AS groups, round(avg(n), 6) AS mean,
        round(stddev_samp(n), 6) AS std, min(n) AS min, max(n) AS max,
        round(quantile_cont(n, 0.25), 6) AS q1, round(quantile_cont(n, 0.5), 6) AS median,
        round(quantile_cont(n, 0.75), 6) AS q3 FROM (SELECT count(*) AS n FROM raw_customers
        WHERE "Address" IS NOT NULL AND "City" IS NOT NULL GROUP BY "Address", "City")""",
    "outliers_iqr": " UNION ALL ".join(_iqr("events", c) for c in ("value", "user_id")),
    "outliers_iqr_values": " UNION ALL ".join(
        f"SELECT * FROM ({_iqr_values('events', c)})" for c in ("value", "user_id")
    ),
    "outliers_zscore": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
        count(*) FILTER (WHERE abs({c} - m) > 3 * s) AS z_score_outliers_count,
        round(100.0 * count(*) FILTER (WHERE abs({c} - m) > 3 * s) / count(*), 6)
            AS z_score_outliers_percentage
        FROM events, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM events)"""
        for c in ("value", "user_id")
    ),
    "rare_categories": f"""SELECT "column", value, n, round(100.0 * n / present, 6) AS percentage
        FROM (SELECT *, sum(n) OVER (PARTITION BY "column") AS present,
              count(*) OVER (PARTITION BY "column") AS categories FROM
              ({_value_counts('raw_transactions', ['transaction_currency', 'transaction_type'])})
              WHERE value IS NOT NULL)
        WHERE categories > 1 AND n * 1.0 / present < greatest(0.01, 1.0 / categories)""",
    "rare_category_summary": f"""SELECT "column", count(*) AS rare_categories_count,
        count(*) <= 10 AS listed FROM (SELECT *, sum(n) OVER (PARTITION BY "column") AS present,
              count(*) OVER (PARTITION BY "column") AS categories FROM
              ({_value_counts('raw_transactions', ['transaction_currency', 'transaction_type'])})
              WHERE value IS NOT NULL)
        WHERE categories > 1 AND n * 1.0 / present < greatest(0.01, 1.0 / categories)
        GROUP BY 1""",
    "outliers_mad_dates": """SELECT 'order_date' AS "column", count(*) AS non_null,
        m AS median_seconds, d AS mad_seconds,
        count(*) FILTER (WHERE 0.6745 * abs(s - m) > 3.5 * d) AS datetime_outliers_count,
        round(100.0 * count(*) FILTER (WHERE 0.6745 * abs(s - m) > 3.5 * d) / count(*), 6)
            AS datetime_outliers_percentage
        FROM (SELECT CAST(epoch(order_date) AS DOUBLE) AS s FROM dated_orders),
        (SELECT m, quantile_cont(abs(CAST(epoch(order_date) AS DOUBLE) - m), 0.5) AS d
         FROM dated_orders, (SELECT quantile_cont(CAST(epoch(order_date) AS DOUBLE), 0.5) AS m
                             FROM dated_orders) GROUP BY m)
        GROUP BY m, d""",
    "outliers_mad_date_examples": """SELECT date, seconds_from_median FROM
        (SELECT order_date AS date, abs(CAST(epoch(order_date) AS DOUBLE) - m)
            AS seconds_from_median, d FROM dated_orders,
        (SELECT m, quantile_cont(abs(CAST(epoch(order_date) AS DOUBLE) - m), 0.5) AS d
         FROM dated_orders, (SELECT quantile_cont(CAST(epoch(order_date) AS DOUBLE), 0.5) AS m
                             FROM dated_orders) GROUP BY m))
        WHERE 0.6745 * seconds_from_median > 3.5 * d
        ORDER BY seconds_from_median DESC, date LIMIT 5""",
    "quality_recommendations": _recommendations(
        "raw_loans", LOAN_TEXTS, lambda c: f"({_shape(c, False)}) IS NOT NULL"
    ),
    "date_format_report": f"""SELECT 'transaction_date' AS "column",
        coalesce({_shape('transaction_date', True)}, 'unrecognized') AS format, count(*) AS n,
        CAST(sum(count(*)) OVER () AS BIGINT) AS total_non_null FROM raw_transactions
        WHERE transaction_date IS NOT NULL GROUP BY 2""",
    "date_format_counts": f"""SELECT 'account_opening_date' AS "column",
        {_shape('account_opening_date', False)} AS format, count(*) AS n FROM raw_accounts
        GROUP BY 2 HAVING format IS NOT NULL""",
    "whitespace_report": " UNION ALL ".join(_whitespace(c) for c in CUSTOMER_TEXTS),
    "whitespace_examples": f"""SELECT "column", original, {_strip('original')} AS stripped, issue
        FROM (SELECT DISTINCT "column", value AS original, {_issue('value')} AS issue FROM
              ({_value_counts('raw_customers', list(CUSTOMER_TEXTS))}))
        WHERE issue IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY original) <= 5""",
    "email_report": f"""SELECT count(*) AS total_emails, count(*) - count("Email") AS null_emails,
        count(*) FILTER (WHERE ok) AS valid_emails, count(*) FILTER (WHERE NOT ok)
        AS invalid_emails, round(100.0 * count(*) FILTER (WHERE ok) / count("Email"), 6)
        AS valid_percentage, count(DISTINCT split_part({_strip('"Email"')}, '@', -1))
        FILTER (WHERE ok) AS unique_domain_count
        FROM (SELECT "Email", {_email_valid('"Email"')} AS ok FROM raw_customers)""",
    "email_domains": f"""SELECT split_part({_strip('"Email"')}, '@', -1) AS domain, count(*) AS n
        FROM raw_customers WHERE {_email_valid('"Email"')} GROUP BY 1
        ORDER BY n DESC, domain LIMIT 10""",
    "email_errors": f"""SELECT {_email_error('"Email"')} AS error, count(*) AS n
        FROM raw_customers GROUP BY 1 HAVING error IS NOT NULL""",
    "email_examples": f"""SELECT DISTINCT "Email" AS email, {_email_error('"Email"')} AS error
        FROM raw_customers WHERE ({_email_error('"Email"')}) IS NOT NULL
        ORDER BY email LIMIT 10""",
    "cleaning_samples": f"""SELECT "column", value,
        CASE WHEN "column" = 'interest_rate' THEN {_number_mixed('value')} END AS cleaned_number,
        CASE WHEN "column" = 'approval_rejection_date' THEN {_date_mixed('value')} END
            AS cleaned_date,
        CASE WHEN "column" = 'approval_rejection_date' THEN {_format('value')} END AS date_format,
        CASE WHEN "column" = 'loan_amount' AND value <> {_strip('value')}
             THEN {_strip('value')} END AS cleaned_text
        FROM ({_sampled(_value_counts('raw_loans', ['customer_id', 'loan_id', 'loan_amount',
              'loant_type', 'interest_rate', 'loan_term', 'approval_rejection_date',
              'loan_status']), 5)})""",
    "cleaning_summary": f"""SELECT "column", kind,
        count(*) FILTER (WHERE cleaned IS NOT NULL AND original <> cleaned) AS changed,
        count(*) FILTER (WHERE original IS NOT NULL AND cleaned IS NULL) AS unreadable
        FROM ({_changes()}) GROUP BY 1, 2""",
    "cleaning_changes": f"""SELECT * FROM (SELECT DISTINCT * FROM ({_changes()})
        WHERE cleaned IS NOT NULL AND original <> cleaned)
        QUALIFY row_number() OVER (PARTITION BY "column", kind ORDER BY original) <= 3""",
    "time_series_counts": " UNION ALL ".join(
        f"""SELECT CAST(date_trunc('{unit}', ts) AS DATE) AS period, count(*) AS n,
        '{freq}' AS freq FROM events GROUP BY 1"""
        for freq, unit in (
            ("D", "day"), ("W", "week"), ("M", "month"), ("Q", "quarter"), ("Y", "year"),
        )
    ),
    "time_series_sums": """SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS period,
        round(coalesce(sum(transaction_amount), 0.0), 2) AS total FROM int_transactions
        WHERE transaction_date IS NOT NULL GROUP BY 1""",
    "correlation_matrix": " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation
        FROM lineitem"""
        for a in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        for b in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "correlation_wide": "SELECT unnest(pairs, recursive := true) FROM (SELECT ["
    + ", ".join(
        f"{{'column_a': '{a}', 'column_b': '{b}', 'correlation': round(corr({a}, {b}), 6), 'n': regr_count({a}, {b})}}"
        for a in WIDE
        for b in WIDE
    )
    + "] AS pairs FROM wide_lines)",
    "histogram_numeric": _histogram("int_loans", "loan_amount", "20"),
    "histogram_dates": _histogram(
        _T,
        _DAYS,
        f"least(50, CAST(max({_DAYS}) - min({_DAYS}) AS BIGINT) // 30 + 1)",
    ),
    "boxplot_stats": f"""SELECT * FROM (WITH q AS
        ({_quartiles('int_loans', 'loan_amount', 'loan_term')})
        {_boxplot('int_loans', 'loan_amount', 'loan_term')})""",
    "boxplot_whole": f"""SELECT * FROM (WITH q AS ({_quartiles('events', 'value', None)})
        {_boxplot('events', 'value', None)})""",
    "kde_by_category": """SELECT category, point, round(start + point * step, 6) AS x,
        round(sum(n * exp(-0.5 * pow((start + point * step - v) / bw, 2)))
            / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 6) AS density
        FROM (SELECT category, total, bw, low - 3 * bw AS start,
                     (high - low + 6 * bw) / 199 AS step, unnest(range(200)) AS point FROM
              (SELECT *, std * pow(total, -0.2) AS bw FROM
               (SELECT loan_status AS category, count(interest_rate) AS total,
                       stddev_samp(interest_rate) AS std, min(interest_rate) AS low,
                       max(interest_rate) AS high FROM int_loans GROUP BY 1)))
        JOIN (SELECT loan_status AS category, interest_rate AS v, count(*) AS n FROM int_loans
              WHERE interest_rate IS NOT NULL GROUP BY 1, 2) USING (category)
        GROUP BY category, point, start, step""",
    "kde_binned": """SELECT category, point, round(start + point * step, 9) AS x,
        round(sum(weight * exp(-0.5 * pow((start + point * step - low - border * bw * 0.02) / bw, 2)))
            / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 9) AS density,
        round(0.0004 / 8 / (any_value(bw) * sqrt(2 * pi())), 9) AS error_bound
        FROM (SELECT *, low - 3 * bw AS start, (high - low + 6 * bw) / 199 AS step,
                     unnest(range(200)) AS point FROM
              (SELECT *, std * pow(total, -0.2) AS bw FROM density_spread))
        JOIN (SELECT category, CAST(floor(place) AS BIGINT) + side AS border,
                     sum(CASE side WHEN 0 THEN 1 - place + floor(place) ELSE place - floor(place) END) AS weight
              FROM (SELECT category, (v - low) / (std * pow(total, -0.2) * 0.02) AS place, unnest([0, 1]) AS side
                    FROM (SELECT transaction_type AS category, transaction_amount / 1000 AS v FROM int_transactions
                          WHERE transaction_type IS NOT NULL AND transaction_amount IS NOT NULL)
                    JOIN density_spread USING (category)) GROUP BY ALL) USING (category)
        GROUP BY category, point, start, step""",
    "linked_persons": f"SELECT person, class FROM ({_LINKED})",
    "linked_person_report": f"""SELECT CAST(sum(n) AS BIGINT) AS persons, count(*) AS classes,
        CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS linked_persons, max(n) AS largest_class
        FROM (SELECT class, count(*) AS n FROM ({_LINKED}) GROUP BY 1)""",
    "sketch_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS count, count(*) - count({c}) AS missing,
        true AS distinct_within_error, true AS median_within_error,
        CASE WHEN count(DISTINCT {c}) < 100 THEN (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem
            WHERE {c} IS NOT NULL GROUP BY {c})) END AS highest_count FROM lineitem"""
        for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")
    ),
    "category_shares": """SELECT category, CAST(sum(n) AS BIGINT) AS n,
        round(100.0 * sum(n) / (SELECT count(transaction_currency) FROM int_transactions), 6)
            AS share
        FROM (SELECT CASE WHEN row_number() OVER (ORDER BY count(*) DESC, transaction_currency)
                     <= 5 THEN transaction_currency ELSE 'Other' END AS category, count(*) AS n
              FROM int_transactions WHERE transaction_currency IS NOT NULL
              GROUP BY transaction_currency) GROUP BY 1""",
    "category_codes": """SELECT transaction_id AS x, round(transaction_amount, 6) AS y,
        transaction_currency AS category, coalesce(code, -1) AS code FROM int_transactions
        LEFT JOIN (SELECT transaction_currency, row_number() OVER (ORDER BY transaction_currency)
                   - 1 AS code FROM (SELECT DISTINCT transaction_currency FROM int_transactions
                   WHERE transaction_currency IS NOT NULL)) USING (transaction_currency)""",
}

ORACLES = {name: _with(body) for name, body in BODIES.items()}
