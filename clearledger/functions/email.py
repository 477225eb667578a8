"""E-mail verdict as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearledger.functions.text import strip_whitespace

# Patterns, limits and error texts.
BASIC_SHAPE = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+\z"
LOCAL_CHARACTERS = r"^[a-zA-Z0-9!#$%&'*+\-/=?^_`{|}~.]+\z"
DOMAIN_SHAPE = r"^[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
HYPHEN_AT_LABEL_END = r"(^|\.)-|-(\.|\z)"
MAX_EMAIL = 254
MAX_LOCAL = 64
EMPTY = "Email is empty"
TOO_LONG = "Email is too long (>254 characters)"
NOT_BASIC = "Email doesn't match basic pattern (user@domain.tld)"
LOCAL_TOO_LONG = "Username part is too long (>64 characters)"
LOCAL_INVALID = "Username contains invalid characters"
LOCAL_DOTS = "Username contains consecutive dots"
DOMAIN_INVALID = "Domain format is invalid"
DOMAIN_DOTS = "Domain contains consecutive dots"
DOMAIN_HYPHEN = "Domain part starts or ends with hyphen"


def email_domain(c: Column) -> Column:
    """Text after the last @ of the stripped address."""
    return F.substring_index(strip_whitespace(c), "@", -1)


def email_error(c: Column) -> Column:
    """First rule an address breaks; null when it is valid or missing."""
    text = strip_whitespace(c)
    local = F.substring_index(text, "@", 1)
    domain = F.substring_index(text, "@", -1)
    quoted = local.startswith('"') & local.endswith('"')
    rules = [
        (text == "", EMPTY),
        (F.length(text) > MAX_EMAIL, TOO_LONG),
        (~text.rlike(BASIC_SHAPE), NOT_BASIC),
        (F.length(local) > MAX_LOCAL, LOCAL_TOO_LONG),
        (~local.rlike(LOCAL_CHARACTERS) & ~quoted, LOCAL_INVALID),
        (local.contains(".."), LOCAL_DOTS),
        (~domain.rlike(DOMAIN_SHAPE), DOMAIN_INVALID),
        (domain.contains(".."), DOMAIN_DOTS),
        (domain.rlike(HYPHEN_AT_LABEL_END), DOMAIN_HYPHEN),
    ]
    verdict = F.when(c.isNull(), F.lit(None).cast("string"))
    for broken, message in rules:
        verdict = verdict.when(broken, F.lit(message))
    return verdict


def email_is_valid(c: Column) -> Column:
    """True or false for a given address, null for a missing one."""
    return F.when(c.isNotNull(), email_error(c).isNull())
