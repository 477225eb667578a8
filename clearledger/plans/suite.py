"""The declared checks of the banking models, as data."""

from __future__ import annotations

from clearledger.operators.checks import (
    ACCEPTED_VALUES,
    DATE_IS_PAST,
    NOT_NULL,
    NUMERIC_RANGE,
    RELATIONSHIPS,
    UNIQUE,
    UNIQUE_COMBINATION,
    Check,
)

# What the business accepts.
ACCOUNT_TYPES = ["savings", "current"]
LOAN_TYPES = ["personal", "mortgage", "auto"]
LOAN_TERMS = [12, 24, 36, 48, 60]
LOAN_STATUSES = ["approved", "rejected", "closed"]
TRANSACTION_TYPES = ["transfer", "deposit", "withdrawal"]
AGE_RANGE = {"min": 18, "max": 200}
NOT_NEGATIVE = {"min": 0}
SUMMARY_KEYS = ("transaction_date", "customer_id", "account_id", "branch_id")


def _checks(model: str, declared: dict[str, list]) -> list[Check]:
    """Expand ``column: [kind or (kind, options)]``."""
    checks = []
    for column, kinds in declared.items():
        for kind in kinds:
            name, options = kind if isinstance(kind, tuple) else (kind, {})
            checks.append(Check(model, name, (column,), options))
    return checks


def _accepted(values: list) -> tuple:
    return (ACCEPTED_VALUES, {"values": values})


def _parent(model: str, field: str) -> tuple:
    return (RELATIONSHIPS, {"to": model, "field": field})


KEY = [NOT_NULL, UNIQUE]
AMOUNT = [NOT_NULL, (NUMERIC_RANGE, NOT_NEGATIVE)]
PAST_DATE = [NOT_NULL, DATE_IS_PAST]

SUITE = (
    _checks(
        "stg_accounts",
        {
            "account_id": KEY,
            "customer_id": [NOT_NULL, _parent("stg_customers", "customer_id")],
            "account_type": [NOT_NULL, _accepted(ACCOUNT_TYPES)],
            "account_opening_date": [DATE_IS_PAST],
        },
    )
    + _checks(
        "stg_customers",
        {
            "customer_id": KEY,
            "age": [NOT_NULL, (NUMERIC_RANGE, AGE_RANGE)],
            "branch_id": [NOT_NULL],
        },
    )
    + _checks(
        "stg_fx_rates",
        {
            "currency_iso_code": KEY,
            "fx_rate": AMOUNT,
            "fx_rate_date": [DATE_IS_PAST],
            "has_date_parsing_error": [NOT_NULL],
        },
    )
    + _checks(
        "stg_loans",
        {
            "loan_id": KEY,
            "loan_amount": AMOUNT,
            "loan_type": [NOT_NULL, _accepted(LOAN_TYPES)],
            "interest_rate": AMOUNT,
            "loan_term": [NOT_NULL, _accepted(LOAN_TERMS)],
            "approval_rejection_date": PAST_DATE,
            "loan_status": [NOT_NULL, _accepted(LOAN_STATUSES)],
        },
    )
    + _checks(
        "stg_transactions",
        {
            "transaction_id": KEY,
            "account_id": [NOT_NULL, _parent("stg_accounts", "account_id")],
            "transaction_type": [NOT_NULL, _accepted(TRANSACTION_TYPES)],
        },
    )
    + _checks(
        "int_accounts",
        {
            "account_id": KEY,
            "customer_id": [NOT_NULL, _parent("int_customers", "customer_id")],
            "account_opening_date": PAST_DATE,
        },
    )
    + _checks("int_customers", {"customer_id": KEY, "branch_id": [NOT_NULL]})
    + _checks(
        "int_fx_rates",
        {"currency_iso_code": KEY, "fx_rate": AMOUNT, "fx_rate_date": PAST_DATE},
    )
    + _checks(
        "int_loans",
        {
            "loan_id": KEY,
            "loan_amount": AMOUNT,
            "interest_rate": AMOUNT,
            "loan_term": [NOT_NULL, _accepted(LOAN_TERMS)],
            "approval_rejection_date": PAST_DATE,
            "loan_status": [NOT_NULL, _accepted(LOAN_STATUSES)],
        },
    )
    + _checks("int_transactions", {"transaction_id": KEY, "transaction_amount": AMOUNT})
    + _checks("int_currencies", {"currency_iso_code": KEY})
    + _checks(
        "customer_transactions_summary",
        {
            column: [NOT_NULL]
            for column in (*SUMMARY_KEYS, "total_amount_eur", "total_transactions")
        },
    )
    + [Check("customer_transactions_summary", UNIQUE_COMBINATION, SUMMARY_KEYS)]
)
