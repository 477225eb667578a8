"""Column -> Column cleaners and classifiers, all evaluated inside the JVM."""

from clearledger.functions.dates import (
    date_shape,
    detect_date_format,
    has_date_shape,
    has_parsing_error,
    looks_like_date,
    parse_date_mixed,
    parse_date_warehouse,
)
from clearledger.functions.email import email_domain, email_error, email_is_valid
from clearledger.functions.keys import surrogate_key
from clearledger.functions.money import to_eur
from clearledger.functions.numbers import (
    looks_like_german_number,
    parse_number_mixed,
    parse_number_warehouse,
)
from clearledger.functions.text import (
    contains_ci,
    count_digits,
    has_outer_whitespace,
    present,
    strip_whitespace,
    whitespace_issue,
)

__all__ = [
    "contains_ci",
    "count_digits",
    "date_shape",
    "detect_date_format",
    "email_domain",
    "email_error",
    "email_is_valid",
    "has_date_shape",
    "has_outer_whitespace",
    "has_parsing_error",
    "looks_like_date",
    "looks_like_german_number",
    "parse_date_mixed",
    "parse_date_warehouse",
    "parse_number_mixed",
    "parse_number_warehouse",
    "present",
    "strip_whitespace",
    "surrogate_key",
    "to_eur",
    "whitespace_issue",
]
